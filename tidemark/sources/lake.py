"""Versioned datasets: ``<root>/<layer>/<dataset>/dt=<dt>/run_id=<run>`` and a manifest of what is published.

Data is written first, its manifest row last, so a reader that goes through the manifest never sees a
half-written version. Appends to the manifest are single files; concurrent publishers of one dataset and
date are resolved by (published_at, run_id).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ContractError, clean_run_id
from tidemark.sources.paths import hadoop_uri

MANIFEST = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("prefix", T.StringType()),
        T.StructField("watermark", T.TimestampType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)


class NotPublished(LookupError):
    """No version, or an empty one, where one was asked for."""


def latest_versions(manifest: DataFrame, by: Sequence[str] = ("dataset", "dt")) -> DataFrame:
    """The newest manifest entry per dataset and date, or per dataset alone; empty prefixes are no entry."""
    newest = F.struct("published_at", "run_id")
    rest = [c for c in manifest.columns if c not in by]
    real = manifest.filter(F.col("prefix").rlike(r"\S"))
    return (
        real.groupBy(*by).agg(F.max_by(F.struct(*rest), newest).alias("v")).select(*by, *(f"v.{c}" for c in rest))
    )


def versions_of_run(manifest: DataFrame, run_id: str) -> DataFrame:
    """The entries of one named run, whatever is newest."""
    return manifest.filter(F.col("run_id") == clean_run_id(run_id))


def check_published(manifest: DataFrame, data: DataFrame, by: Sequence[str] = ("dt", "run_id")) -> DataFrame:
    """Manifest entries with the number of rows found for them and whether there are any."""
    found = data.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = manifest.join(found, list(by), "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return joined.withColumn("holds_data", F.col("n_rows") > 0)


class Lake:
    """Datasets below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, hadoop_uri(root).rstrip("/")

    # -- locations -------------------------------------------------------------------------------

    def dataset_path(self, dataset: str) -> str:
        """``dataset`` includes its layer, as in ``silver/tx_features``."""
        return f"{self.root}/{dataset}"

    def version_prefix(self, dataset: str, dt: str, run_id: str) -> str:
        return f"{dataset}/dt={dt}/run_id={clean_run_id(run_id)}"

    # -- writing ---------------------------------------------------------------------------------

    def publish(
        self, df: DataFrame, dataset: str, dt: str, run_id: str, watermark: datetime | None = None,
        partition_by: Sequence[str] = (),
    ) -> str:
        """Write one version and enter it in the manifest; returns its prefix.

        A listed version is never written over: readers may be at it. Another run id makes another version.
        """
        prefix = self.version_prefix(dataset, dt, run_id)
        self._refuse_listed(F.col("prefix") == prefix)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{prefix}")
        self._enter([(dataset, dt, clean_run_id(run_id), "run", prefix, watermark)])
        return prefix

    def publish_by_day(self, df: DataFrame, dataset: str, run_id: str, day: str = "dt") -> None:
        """Write all days of ``df`` in one job, a version each. The manifest rows come from the written
        partitions and are appended by Spark, not through the driver. A run publishes a dataset once, so that all
        its days are of one write; rows without a day are an error, and then no day is entered."""
        run = clean_run_id(run_id)
        self._refuse_listed((F.col("dataset") == dataset) & (F.col("run_id") == run) & (F.col("kind") == "run"))
        target = self.dataset_path(dataset)
        # One task per day and file-size share: AQE splits the heavy days of this rebalance.
        versioned = df.withColumn("run_id", F.lit(run)).hint("rebalance", day)
        writer = versioned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(day, "run_id").parquet(target)
        days = self.read_all(dataset).filter(F.col("run_id") == run).select(F.col(day).cast("string").alias("dt"))
        if not days.filter(F.col("dt").isNull()).isEmpty():
            raise ContractError(f"{dataset} has rows without {day}")
        rows = days.distinct().select(
            F.lit(dataset).alias("dataset"),
            "dt",
            F.lit(run).alias("run_id"),
            F.lit("run").alias("kind"),
            F.concat(F.lit(f"{dataset}/{day}="), "dt", F.lit(f"/run_id={run}")).alias("prefix"),
            F.lit(None).cast("timestamp").alias("watermark"),
            F.current_timestamp().alias("published_at"),
        )
        rows.coalesce(1).write.mode("append").parquet(self._manifest_path)

    def publish_current(self, dataset: str, dt: str, run_id: str) -> str:
        """Copy a published version to ``current/<dataset>`` for readers with a fixed path, and leave a
        manifest row that says which one it is."""
        prefix = self.version_prefix(dataset, dt, run_id)
        target = f"current/{dataset}"
        self.read_prefix(prefix).write.mode("overwrite").parquet(f"{self.root}/{target}")
        self._enter([(dataset, dt, clean_run_id(run_id), "current", target, None)])
        return target

    def save_model(self, model, name: str, dt: str, run_id: str) -> str:
        """Save a fitted pipeline as a version; an alias is one more manifest row (:meth:`set_alias`)."""
        prefix = self.version_prefix(f"models/{name}", dt, run_id)
        model.write().overwrite().save(f"{self.root}/{prefix}")
        self._enter([(f"models/{name}", dt, clean_run_id(run_id), "model", prefix, None)])
        return prefix

    def set_alias(self, name: str, alias: str, dt: str, run_id: str) -> None:
        prefix = self.version_prefix(f"models/{name}", dt, run_id)
        self._enter([(f"models/{name}@{alias}", dt, clean_run_id(run_id), "alias", prefix, None)])

    def enter(self, dataset: str, dt: str, run_id: str, kind: str, prefix: str, watermark: datetime | None = None) -> None:
        """List what a job has written by itself. Comes last: from here on readers find it."""
        self._enter([(dataset, dt, clean_run_id(run_id), kind, prefix, watermark)])

    def _refuse_listed(self, which: Column) -> None:
        try:
            listed = self.manifest().filter(which & F.col("kind").isin("run", "model"))
        except NotPublished:
            return
        if not listed.isEmpty():
            raise ContractError("this version is published already; use another run id")

    def _enter(self, entries: list[tuple]) -> None:
        now = datetime.now(timezone.utc)
        rows = self.spark.createDataFrame([(*e, now) for e in entries], MANIFEST)
        rows.coalesce(1).write.mode("append").parquet(self._manifest_path)

    # -- reading ---------------------------------------------------------------------------------

    @property
    def _manifest_path(self) -> str:
        return f"{self.root}/manifest"

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(self._manifest_path)
        except AnalysisException as error:
            raise NotPublished(f"nothing is published below {self.root}") from error

    def resolve(
        self, dataset: str, dt: str | None = None, run_id: str | None = None, kinds: Sequence[str] = ("run",)
    ) -> str:
        """Prefix of the newest version of a dataset (of one date, of one run), or raise."""
        found = self.manifest().filter((F.col("dataset") == dataset) & F.col("kind").isin(list(kinds)))
        if dt is not None:
            found = found.filter(F.col("dt") == dt)
        if run_id is not None:
            found = versions_of_run(found, run_id)
        row = latest_versions(found, ["dataset"]).first()
        if row is None:
            raise NotPublished(f"no published version of {dataset} (dt={dt}, run_id={run_id})")
        return row["prefix"].strip()

    def watermark(self, dataset: str) -> datetime | None:
        found = self.manifest().filter(F.col("dataset") == dataset)
        return found.agg(F.max("watermark")).first()[0]

    def read_prefix(self, prefix: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{prefix}")

    def read(self, dataset: str, dt: str | None = None, run_id: str | None = None) -> DataFrame:
        return self.read_prefix(self.resolve(dataset, dt, run_id))

    def read_all(self, dataset: str) -> DataFrame:
        """All versions, with ``dt`` and ``run_id`` as partition columns to filter on."""
        return self.spark.read.option("pathGlobFilter", "*.parquet").parquet(self.dataset_path(dataset))

    def read_days(self, dataset: str, schema: T.StructType, first: str, before: str) -> DataFrame:
        """The newest version of each date from ``first`` on and before ``before``, with ``dt`` and the columns of
        ``schema``; no rows where there is none. One path per date."""
        try:
            entries = self.manifest().filter((F.col("dataset") == dataset) & (F.col("kind") == "run"))
        except NotPublished:
            return self.spark.createDataFrame([], schema)
        dated = entries.filter((F.col("dt") >= first) & (F.col("dt") < before))
        paths = [f"{self.root}/{r['prefix'].strip()}" for r in latest_versions(dated).collect()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", self.dataset_path(dataset))
        return read.parquet(*paths).select(*schema.names)

    def newest_before(self, dataset: str, before: str) -> str | None:
        """Prefix of the newest version of the last date before ``before``."""
        try:
            entries = self.manifest().filter((F.col("dataset") == dataset) & (F.col("kind") == "run"))
        except NotPublished:
            return None
        row = latest_versions(entries.filter(F.col("dt") < before)).orderBy(F.col("dt").desc()).first()
        return None if row is None else row["prefix"].strip()

    def read_current(self, dataset: str) -> DataFrame:
        return self.read_prefix(f"current/{dataset}")

    def verify(self, dataset: str, dt: str, run_id: str, schema: T.StructType | None = None) -> int:
        """Row count of a published version; raises when it is empty or has other columns."""
        df = self.read_prefix(self.resolve(dataset, dt, run_id))
        if schema is not None and [(f.name, f.dataType) for f in df.schema] != [
            (f.name, f.dataType) for f in schema
        ]:
            raise NotPublished(f"{dataset} dt={dt} run_id={run_id} has schema {df.schema.simpleString()}")
        n = df.count()
        if not n:
            raise NotPublished(f"{dataset} dt={dt} run_id={run_id} holds no rows")
        return n
