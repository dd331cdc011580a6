"""An online table that is kept in buckets and moved forward run by run.

``online/<view>`` holds the newest row of every key. Keys are hashed into buckets; a run reads the rows that came after the
last run's watermark, and reads and rewrites only the buckets that these rows touch. Layout below the dataset::

    new/run_id=<run>                  the run's newest row per key, written once, read for the merge
    data/run_id=<run>/bucket=<b>      the buckets this run rewrote
    map/run_id=<run>                  which run holds the current version of each bucket

The manifest row comes last and holds the map and the watermark, so a reader sees a whole run or nothing of it, and a run that
fails is simply run again. Its length is the number of runs, the map's the number of buckets; neither grows with the keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ContractError, clean_run_id
from tidemark.operators.entities import FeatureView, latest
from tidemark.sources.lake import Lake, NotPublished

KIND = "online"


@dataclass(frozen=True)
class Head:
    """The newest state of a table: the runs of its buckets and the time up to which it has read."""

    run_id: str | None = None
    watermark: datetime | None = None
    runs: dict[int, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class OnlineTable:
    lake: Lake
    view: FeatureView
    order_id: tuple[str, ...] = ()
    buckets: int = 256

    @property
    def dataset(self) -> str:
        return f"online/{self.view.name}"

    @property
    def _root(self) -> str:
        return self.lake.dataset_path(self.dataset)

    # -- reading ---------------------------------------------------------------------------------

    def head(self) -> Head:
        try:
            entries = self.lake.manifest().filter((F.col("dataset") == self.dataset) & (F.col("kind") == KIND))
        except NotPublished:
            return Head()
        # The watermark only moves forward, so it also orders the runs.
        row = entries.orderBy(F.col("watermark").desc(), F.col("published_at").desc()).first()
        if row is None:
            return Head()
        runs = self.lake.read_prefix(row["prefix"]).collect()
        return Head(row["run_id"], row["watermark"].astimezone(timezone.utc), {r["bucket"]: r["run_id"] for r in runs})

    def read(self, buckets: Iterable[int] | None = None, head: Head | None = None) -> DataFrame:
        """The current rows: key columns, event time and features, of all buckets or of some."""
        head = head or self.head()
        held = sorted(set(head.runs) & set(head.runs if buckets is None else buckets))
        paths = [f"{self._root}/data/run_id={head.runs[b]}/bucket={b}" for b in held]
        spark = self.lake.spark
        if not paths:
            if head.run_id is None:
                raise NotPublished(f"{self.dataset} has not been materialized")
            return spark.read.parquet(f"{self._root}/new/run_id={head.run_id}").drop("bucket").limit(0)
        return spark.read.option("basePath", f"{self._root}/data").parquet(*paths).drop("run_id", "bucket")

    def read_keys(self, requests: DataFrame) -> DataFrame:
        """The rows of the buckets that ``requests`` ask for: a lookup of few keys opens few files."""
        asked = requests.select(self._bucket().alias("bucket")).distinct()
        return self.read([r["bucket"] for r in asked.collect()])

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.view.keys), F.lit(self.buckets)).cast("int")

    # -- writing ---------------------------------------------------------------------------------

    def advance(self, source: DataFrame, end: datetime, run_id: str, start: datetime | None = None) -> Head:
        """Take in the rows of ``source`` after the watermark and up to ``end``; returns the new head.

        The first run begins at ``start`` (inclusive) or with the oldest row. Rows that arrive behind the watermark are left
        out, as in :func:`tidemark.operators.entities.materialize_increment`.
        """
        if end.tzinfo is None or (start is not None and start.tzinfo is None):
            raise ContractError("materialization bounds need a time zone")
        run, head, view = clean_run_id(run_id), self.head(), self.view
        if head.watermark is not None and end <= head.watermark:
            raise ContractError(f"{self.dataset} is at {head.watermark} already")
        if run in {head.run_id, *head.runs.values()}:
            raise ContractError(f"run {run} of {self.dataset} is published already; use another run id")
        inside = F.col(view.ts) <= F.lit(end)
        if head.watermark is not None:
            inside = inside & (F.col(view.ts) > F.lit(head.watermark))
        elif start is not None:
            inside = inside & (F.col(view.ts) >= F.lit(start))
        fresh = view.project(latest(view.check(source).filter(inside), view.keys, view.ts, self.order_id))
        staged = f"{self._root}/new/run_id={run}"
        fresh.withColumn("bucket", self._bucket()).write.mode("overwrite").parquet(staged)
        fresh = self.lake.spark.read.parquet(staged)
        # At most as many rows as there are buckets.
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
        if touched:
            data = self.merged(fresh, head, touched).write.mode("overwrite").partitionBy("bucket")
            data.parquet(f"{self._root}/data/run_id={run}")
        return self._publish(head, {**head.runs, **dict.fromkeys(touched, run)}, run, end)

    def merged(self, fresh: DataFrame, head: Head, touched: Sequence[int]) -> DataFrame:
        """The touched buckets with the fresh rows in them. One exchange, by bucket: a task writes whole buckets."""
        both = fresh
        if set(touched) & set(head.runs):
            both = self.read(touched, head).withColumn("bucket", self._bucket()).unionByName(fresh)
        return latest(both.repartition(len(touched), "bucket"), ["bucket", *self.view.keys], self.view.ts)

    def _publish(self, before: Head, runs: dict[int, str], run: str, end: datetime) -> Head:
        prefix = f"{self.dataset}/map/run_id={run}"
        schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("run_id", T.StringType())])
        pointers = self.lake.spark.createDataFrame(sorted(runs.items()), schema)
        pointers.coalesce(1).write.mode("overwrite").parquet(f"{self.lake.root}/{prefix}")
        if self.head().run_id != before.run_id:
            raise ContractError(f"another run has moved {self.dataset} meanwhile")
        self.lake.enter(self.dataset, end.astimezone(timezone.utc).strftime("%Y-%m-%d"), run, KIND, prefix, end)
        return Head(run, end, runs)
