"""Table schemas and the column checks made while a plan is built."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TEXT, _REAL, _FLAG, _MONEY = T.StringType(), T.DoubleType(), T.BooleanType(), T.DecimalType(18, 2)


def _schema(*texts: str, **others: T.DataType) -> T.StructType:
    fields = dict.fromkeys(texts, _TEXT) | others
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Landed JSON lines keep `ts` as text: whether an offset was written can only be seen there.
TRANSACTIONS_RAW = _schema(
    "t_id", "cc_num", "account_id", "merchant_id", "currency", "country", "ip_address", "channel", "category",
    "ts", amount=_MONEY, card_present=_FLAG, lat=_REAL, lon=_REAL,
)
LABELS_RAW = _schema("t_id", "cc_num", "explanation", "ts")
MERCHANTS = _schema("merchant_id", "merchant_name", "country", "category")
ACCOUNTS = _schema("account_id", "bank_id", "home_country")
CARDS = _schema("cc_num", "account_id")


def with_times(schema: T.StructType, columns: Iterable[str] = ("ts",)) -> T.StructType:
    """The schema after ingest: the named text columns have become timestamps."""
    wanted = set(columns)
    return T.StructType(
        [T.StructField(f.name, T.TimestampType() if f.name in wanted else f.dataType, True) for f in schema]
    )


TRANSACTIONS = with_times(TRANSACTIONS_RAW)
LABELS = with_times(LABELS_RAW)


class ContractError(ValueError):
    """A DataFrame does not have the columns an operator needs."""


def require(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Return ``df`` or raise with every missing column and what is there instead."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what} lacks columns {missing}; it has {sorted(df.columns)}")
    return df


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of ``columns`` that ``df`` has, in the order asked for."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def in_namespace(df: DataFrame, namespace: str, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of one feature namespace.

    ``exclude`` names base columns that only look like members (``card_present`` in ``card_``).
    """
    return [c for c in df.columns if c.startswith(namespace) and c not in set(exclude)]


def split_by_type(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) model inputs. Booleans count as numbers, text as categories."""
    skip = set(exclude)
    numeric, categorical = [], []
    for field in df.schema:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.StringType):
            categorical.append(field.name)
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(field.name)
        else:
            raise ContractError(f"{field.name} of type {field.dataType.simpleString()} is not a model input")
    return numeric, categorical


def clean_run_id(run_id: str) -> str:
    """A run id that is safe as one path segment."""
    cleaned = re.sub(r"[:/+]", "_", run_id.strip())
    if not cleaned:
        raise ContractError("empty run id")
    return cleaned
