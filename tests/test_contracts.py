import pytest

from tidemark import contracts as c


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert c.require(df, ["a"]) is df
    with pytest.raises(c.ContractError, match=r"\['p', 'q'\].*\['a', 'b'\]"):
        c.require(df, ["q", "a", "p"], "events")
    assert c.present(df, ["z", "b", "a"]) == ["b", "a"]


def test_namespace_does_not_swallow_base_columns(spark):
    df = spark.createDataFrame([(True, 1, 2)], "card_present boolean, card_x int, m_y int")
    assert c.in_namespace(df, "card_", ["card_present"]) == ["card_x"]


def test_model_inputs_by_type(spark):
    df = spark.createDataFrame([], "a int, b boolean, c string, d decimal(18,2), t timestamp")
    assert c.split_by_type(df, ["t"]) == (["a", "b", "d"], ["c"])
    with pytest.raises(c.ContractError, match="timestamp"):
        c.split_by_type(df)


def test_run_ids():
    assert c.clean_run_id(" manual__2026-01-07T00:00:00+00:00/x ") == "manual__2026-01-07T00_00_00_00_00_x"
    with pytest.raises(c.ContractError):
        c.clean_run_id("  ")

