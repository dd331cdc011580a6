"""Latest rows per entity, feature views, materialization and keyed lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ContractError, require

DAY = 86_400


def latest(df: DataFrame, keys: Sequence[str], ts: str, order_id: Sequence[str] = ()) -> DataFrame:
    """The newest row per key, ties broken by the largest ``order_id``.

    Spark keeps one row per key and task *before* the exchange (``WindowGroupLimit``), so a heavy key
    costs one row per map task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(ts).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in order_id)
    )
    return df.withColumn("__rank", F.row_number().over(newest_first)).filter("__rank = 1").drop("__rank")


@dataclass(frozen=True)
class FeatureView:
    """Declared features of one entity: join keys, typed fields, event time, how long a row is valid."""

    name: str
    keys: tuple[str, ...]
    fields: dict[str, T.DataType] = field(hash=False)
    ttl_seconds: int
    ts: str = "event_ts"

    def check(self, df: DataFrame) -> DataFrame:
        require(df, [*self.keys, self.ts, *self.fields], f"source of view {self.name}")
        types = {f.name: f.dataType for f in df.schema}
        for name, wanted in self.fields.items():
            if isinstance(wanted, T.NumericType) and not isinstance(types[name], T.NumericType):
                raise ContractError(
                    f"view {self.name}: {name} is {types[name].simpleString()}, not {wanted.simpleString()}"
                )
        return df

    def project(self, df: DataFrame, *extra: str) -> DataFrame:
        """Keys, event time and fields in their declared types (a double may narrow to float)."""
        return self.check(df).select(
            *self.keys, self.ts, *(F.col(n).cast(t).alias(n) for n, t in self.fields.items()), *extra
        )


def card_view(name: str = "card_txn_features") -> FeatureView:
    fields: dict[str, T.DataType] = {}
    for span in ("10m", "1h", "1d", "7d"):
        fields[f"cc_sum_amt_{span}"] = T.FloatType()
        fields[f"cc_cnt_{span}"] = T.LongType()
    fields["cc_time_since_last_s"] = T.LongType()
    return FeatureView(name, ("cc_num",), fields, 30 * DAY)


def merchant_view(name: str = "merchant_risk_features") -> FeatureView:
    fields: dict[str, T.DataType] = {f"m_fraud_cnt_{span}": T.LongType() for span in ("1d", "7d", "30d")}
    return FeatureView(name, ("merchant_id",), fields, 90 * DAY)


def materialize(
    source: DataFrame, view: FeatureView, start: Column, end: Column, order_id: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key with ``start <= event time <= end``, in view types."""
    inside = view.check(source).filter(F.col(view.ts).between(start, end))
    return view.project(latest(inside, view.keys, view.ts, order_id))


def materialize_increment(
    online: DataFrame,
    source: DataFrame,
    view: FeatureView,
    watermark: Column,
    end: Column,
    order_id: Sequence[str] = (),
) -> DataFrame:
    """The online table moved from ``watermark`` to ``end``; rows after ``end`` wait for a later run.

    The new part is reduced to one row per key before it meets the online table.
    """
    new = view.check(source).filter((F.col(view.ts) > watermark) & (F.col(view.ts) <= end))
    new = view.project(latest(new, view.keys, view.ts, order_id))
    return latest(view.project(online).unionByName(new), view.keys, view.ts)


def lookup(
    requests: DataFrame,
    online: dict[str, tuple[FeatureView, DataFrame]],
    references: Sequence[str],
    as_of: Column,
    key_ttl_seconds: int | None = None,
) -> DataFrame:
    """Request rows with the values of ``view:field`` references; NULL where a key is missing or expired."""
    wanted: dict[str, list[str]] = {}
    for reference in references:
        view_name, _, field_name = reference.partition(":")
        if view_name not in online or field_name not in online[view_name][0].fields:
            raise ContractError(f"unknown feature reference {reference!r}")
        wanted.setdefault(view_name, []).append(field_name)
    out = requests.withColumn("__as_of", as_of)
    for view_name, fields in wanted.items():
        view, table = online[view_name]
        ttl = min(view.ttl_seconds, key_ttl_seconds or view.ttl_seconds)
        values = table.select(*view.keys, F.struct(F.col(view.ts).alias("__ts"), *fields).alias("__v"))
        alive = F.col("__v.__ts") >= F.col("__as_of") - F.make_dt_interval(secs=F.lit(ttl))
        out = (
            out.join(values, list(view.keys), "left")
            .withColumns({f: F.when(alive, F.col(f"__v.{f}")) for f in fields})
            .drop("__v")
        )
    return out.select(*requests.columns, *(r.partition(":")[2] for r in references))


def missing_values(found: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, feature) for each looked-up value that is NULL."""
    absent = F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in fields)))
    return found.select(*keys, F.explode(absent).alias("feature"))
