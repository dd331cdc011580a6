import hashlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.contracts import ContractError
from tidemark.operators import prepare
from tidemark.operators.model import TrainConfig, build_pipeline, limit_rows, optimum_gap, score, train
from tidemark.operators.ordered import TilePolicy
from tidemark.plans import bronze, silver, training
from tidemark.sources.jsonl import write_jsonl
from tidemark.sources.lake import Lake, NotPublished


def separable(spark, n=400):
    h = F.pmod(F.xxhash64("id"), F.lit(100))
    return spark.range(n).select(
        F.col("id").alias("t_id"),
        F.when(h != 7, h.cast("double")).alias("amount"),
        F.when(h < 50, "FR").when(h < 95, "SE").alias("country"),
        (h % 2 == 0).alias("card_present"),
        ((h + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10))) > 85).cast("int").alias("label_is_fraud"),
    )


def test_stratified_split_is_exact(spark):
    df = separable(spark)
    for policy in (TilePolicy(), TilePolicy(10, 20)):
        parts = prepare.stratified_split(df, "t_id", "label_is_fraud", policy=policy)
        counts = {r.label_is_fraud: (r.n, r.t) for r in parts.groupBy("label_is_fraud").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
        assert all(t == int(n * 0.2 + 0.5) for n, t in counts.values())
    one_class = prepare.stratified_split(df.filter("label_is_fraud = 0"), "t_id", "label_is_fraud")
    assert 0 < one_class.filter("is_test").count() < one_class.count()
    assert rows(prepare.hash_split(df, "t_id").select("t_id", "is_test")) == rows(prepare.hash_split(df.repartition(3), "t_id").select("t_id", "is_test"))


def test_statistics_of_preparation(spark):
    df = spark.createDataFrame([(1, 4.0, "b"), (2, None, "a"), (3, 8.0, None), (4, 9.0, "a"), (5, 9.0, "b")], "i int, x double, c string")
    assert prepare.medians(df, ["x", "i"]) == {"x": 8.5, "i": 3.0}
    assert prepare.medians(df.filter("i < 0"), ["x"]) == {"x": None}
    assert prepare.most_frequent(df, ["c"]) == {"c": "a"}
    assert [r.c for r in prepare.impute_mode(df, ["c"]).orderBy("i").collect()] == ["b", "a", "a", "a", "b"]
    z = [r.i_z for r in prepare.standardise(df, ["i"]).orderBy("i").collect()]
    assert z[0] == pytest.approx(-(2**0.5)) and sum(z) == pytest.approx(0)
    assert {r.k_z for r in prepare.standardise(df.withColumn("k", F.lit(3)), ["k"]).collect()} == {0.0}
    hot = prepare.one_hot(df, "c", ["a"]).orderBy("i").collect()
    assert [r.c_a for r in hot] == [0, 1, 0, 1, 0]
    weights = {r.c: r.weight for r in prepare.with_class_weight(df.filter("c is not null and i < 5"), "c").collect()}
    assert weights == {"a": 0.75, "b": 1.5}


def test_model_learns_saves_and_ignores_unknown_categories(spark, tmp_path):
    df = separable(spark)
    trained = train(df, TrainConfig(max_iter=50))
    assert trained.inputs == ("amount", "card_present", "country")
    assert trained.scored.count() == 80 and set(trained.scored.columns) == {"t_id", "label", "score"}
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.save_model(trained.model, "m", "2026-01-01", "r:1")
    lake.set_alias("m", "candidate", "2026-01-01", "r:1")
    path = lake.resolve("models/m@candidate", kinds=["alias"])
    assert path == lake.resolve("models/m", kinds=["model"])
    again = PipelineModel.load(f"{lake.root}/{path}")
    new = df.limit(5).withColumn("country", F.lit("??"))
    assert rows(score(again, new, "t_id")) == rows(score(trained.model, new, "t_id"))
    assert all(0 <= r.score <= 1 for r in score(again, new).collect())
    hot = again.transform(new).first()["hot_country"]
    assert hot.size == 2 and hot.numNonzeros() == 0


def test_guards(spark):
    df = separable(spark, 50)
    assert limit_rows(df, TrainConfig()) is df
    rare = spark.range(2000).selectExpr("id as t_id", "cast(id >= 1995 as int) as label_is_fraud", "id % 7 as x")
    few = limit_rows(rare, TrainConfig(fit_rows=100)).groupBy("label_is_fraud").count()
    assert {r[0]: r[1] for r in few.collect()} == {0: 99, 1: 1}
    assert limit_rows(rare, TrainConfig(fit_rows=2000)).count() == 2000
    bound = train(rare, TrainConfig(fit_rows=100, max_iter=5))
    assert bound.scored.count() == 400 and bound.n_fit == 100
    tiny = prepare.hash_split(spark.range(50_000), "id", 0.4, fine=True)
    assert 100 < tiny.filter("is_test").count() < 300
    wide = df.withColumn("who", F.col("t_id").cast("string")).withColumn("weight", F.lit(1.0))
    hashed = build_pipeline(wide, TrainConfig(max_categories=5, hash_buckets=8, max_iter=5))[0].fit(wide)
    unseen = hashed.transform(wide.limit(3).withColumn("who", F.lit(None).cast("string")))
    assert unseen.first()["hot_who"].size <= 8 and score(hashed, wide, "t_id").count() == 50
    with pytest.raises(ContractError, match="label_is_fraud"):
        train(df.drop("label_is_fraud"))


def test_landing_to_model(spark, tmp_path):
    t0 = datetime(2026, 1, 5)
    iso = lambda s: (t0 + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ")
    tx = spark.createDataFrame(
        [
            (f"t{i:03d}", f"c{i % 7}", f"a{i % 7}", f"m{i % 5}", Decimal(i % 50), "USD", "SE", "10.0.0.1", i % 3 == 0,
             "pos" if i % 3 == 0 else "online", "travel", 1.0, 1.0, iso(i * 60))
            for i in range(200)
        ],
        "t_id string, cc_num string, account_id string, merchant_id string, amount decimal(18,2), currency string, "
        "country string, ip_address string, card_present boolean, channel string, category string, lat double, lon double, ts string",
    )
    labels = tx.filter("amount > 44").selectExpr("t_id", "cc_num", "'chain_attack' explanation", "ts")
    land = {name: str(tmp_path / name) for name in ("tx", "labels", "cards", "accounts", "merchants")}
    write_jsonl(tx, land["tx"])
    write_jsonl(labels, land["labels"])
    write_jsonl(tx.select("cc_num", "account_id").distinct(), land["cards"])
    write_jsonl(tx.select("account_id").distinct(), land["accounts"])
    write_jsonl(tx.select("merchant_id").distinct(), land["merchants"])
    lake = Lake(spark, str(tmp_path / "lake"))
    landing = bronze.Landing(**land)
    bronze.ingest(lake, landing, "2026-01-05", "run:1")
    assert lake.verify("bronze/transactions", "2026-01-05", "run:1") == 200
    silver.build(lake, "2026-01-05", "run:1")
    assert lake.read_current("silver/online/card_features").count() == 7
    training.build(lake, "2026-01-05", "run:1")
    full = lake.read("silver/training_set")
    assert full.columns == [*training.BASE_COLUMNS, *(f"card_{c}" for c in silver.CARD_SNAPSHOT_FEATURES), *silver.MERCHANT_SNAPSHOT_FEATURES]
    assert full.filter("card_cc_cnt_10m is null").count() == 0 and full.count() == 200
    training.build(lake, "2026-01-05", "run:2", snapshots=True)
    assert lake.read("silver/training_set", run_id="run:2").filter("card_cc_cnt_10m is not null").count() == 7
    model = training.train_run(lake, "2026-01-05", "run:3", TrainConfig(max_iter=20, provenance={"ds": "2026-01-05"}))
    assert model == "models/baseline/dt=2026-01-05/run_id=run_3"
    record = lake.read("runs").first()
    assert (record.n_rows, record.n_pos) == (200, 20) and record.params["ds"] == "2026-01-05"
    # The gate stops a bad delivery before anything is published.
    write_jsonl(tx.select("merchant_id").distinct().filter("merchant_id <> 'm1'"), land["merchants"])
    with pytest.raises(Exception, match="tx_merchant: 40"):
        bronze.ingest(lake, landing, "2026-01-06", "run:1")
    assert lake.manifest().filter("dt = '2026-01-06'").count() == 0


def test_gate_reads_text_once(spark, tmp_path):
    """Text amounts are rejects, and every line is parsed once, whatever follows."""
    lines = ['{"t_id": "1", "amount": "5.00"}', '{"t_id": "2", "amount": 5}', '{"t_id": "3", "amount": null, "note": "\\"amount\\": \\"7\\""}', "{", ""]
    (tmp_path / "tx").write_text("\n".join(lines))
    (tmp_path / "labels").write_text('{"t_id": "2"}')
    (tmp_path / "none").write_text("")
    lake = Lake(spark, str(tmp_path / "lake"))
    landing = bronze.Landing(*(str(tmp_path / n) for n in ("tx", "labels", "none", "none", "none")))
    with pytest.raises(bronze.GateError, match="transactions: 2 unreadable"):
        bronze.ingest(lake, landing, "2026-01-01", "r1")
    bronze.ingest(lake, landing, "2026-01-01", "r2", gate=False)
    assert {r.t_id for r in lake.read("bronze/transactions").collect()} == {"2", "3"}
    assert {r.line for r in lake.read("rejects/transactions").collect()} == {lines[0], "{"}
    part = bronze._judge(lake, "transactions", landing.tx, bronze.TRANSACTIONS_RAW, "2026-01-01", "r3")[0]
    for df in part.rows, part.rejects:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "parquet" in plan.lower()
    with pytest.raises(NotPublished):
        bronze.ingest(lake, bronze.Landing(landing.tx, *[str(tmp_path / "none")] * 4), "2026-01-02", "r1", gate=False)
    assert lake.manifest().filter("dt = '2026-01-02'").count() == 0


def test_hashed_features_cancel(spark):
    df = spark.createDataFrame([(1, "a", "b", None), (2, None, None, None), (3, "a", "a", "c")], "i int, x string, y string, z string")
    for buckets in (1, 2, 1000):
        want = {}
        for i, *values in df.collect():
            for c, v in zip("xyz", values):
                if v is not None:
                    h = int(hashlib.md5(f"{c}={v}".encode()).hexdigest()[:15], 16)
                    want[i, (h >> 1) % buckets] = want.get((i, (h >> 1) % buckets), 0) + (1 if h % 2 == 0 else -1)
        got = {(r.i, r.bucket): r.value for r in prepare.hashed_features(df, ["i"], ["x", "y", "z"], buckets).collect()}
        assert got == {k: v for k, v in want.items() if v}
    with pytest.raises(ContractError, match="bucket"):
        prepare.hashed_features(df, ["i"], ["x"], 0)


def test_optimum_gap_sees_a_fit_that_is_not_one(spark):
    df = prepare.with_class_weight(separable(spark), "label_is_fraud")
    gaps = {}
    for steps in (1, 200):
        cfg = TrainConfig(max_iter=steps, tol=1e-12, c=0.1)
        model = build_pipeline(df, cfg)[0].fit(df)
        found = optimum_gap(model, df, cfg).collect()
        assert sorted(r.position for r in found) == list(range(5))
        gaps[steps] = max(abs(r.gradient) for r in found)
    assert gaps[200] < 1e-5 < 1e-3 < gaps[1]
