"""JSON-lines landing files."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import parse_ts
from tidemark.sources.paths import hadoop_uri

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Landed:
    """Rows that fit the schema, and the text of the lines that do not."""

    rows: DataFrame
    rejects: DataFrame


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> Landed:
    """Scan with an explicit schema: no inference pass, no types that depend on the day's data.

    Blank lines are skipped. A line that is no JSON object, or has a value of the wrong type, goes to
    ``rejects``; a decimal written as text is of the wrong type.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return parse_lines(spark.read.text([hadoop_uri(p) for p in paths]), schema)


def parse_lines(lines: DataFrame, schema: T.StructType) -> Landed:
    """The same for a text scan, batch or streaming."""
    return landed(judged(lines, schema))


def judged(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per line that is not blank: ``row`` (of ``schema``), and for rejects ``line`` and ``file`` instead.

    Lines are parsed once. Whoever needs rows and rejects, or passes over them several times, writes this and reads it back.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    # Parsed as an expression: the JSON source would parse only the columns a query asks for, and which
    # lines count as broken would depend on the query.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    filled = lines.filter(F.col("value").rlike(r"\S"))
    parsed = filled.select("value", "_metadata.file_path", F.from_json("value", full, options).alias("r"))
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    for field in schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            broken = broken | _written_as_text(field.name)
    row = F.struct(*(F.col("r").getField(f.name).alias(f.name) for f in schema.fields))
    return parsed.select(broken.alias("broken"), "value", "file_path", row.alias("row")).select(
        F.when(~F.col("broken"), F.col("row")).alias("row"),
        F.when(F.col("broken"), F.col("value")).alias("line"),
        F.when(F.col("broken"), F.col("file_path")).alias("file"),
    )


def _written_as_text(name: str) -> Column:
    """Whether a top-level member of the JSON line ``value`` is a string. The type is looked up only where a quote follows the name."""
    quoted = F.col("value").rlike(f'"{re.escape(name)}"\\s*:\\s*"')
    member = F.try_variant_get(F.try_parse_json("value"), f'$["{name}"]', "variant")
    return F.when(quoted, F.coalesce(F.schema_of_variant(member) == "STRING", F.lit(False))).otherwise(False)


def landed(lines: DataFrame) -> Landed:
    """Rows and rejects of judged lines."""
    return Landed(lines.filter(F.col("row").isNotNull()).select("row.*"), lines.filter(F.col("row").isNull()).select("line", "file"))


def typed(rows: DataFrame, time_columns: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Text times to timestamps, for the time columns that exist."""
    return rows.withColumns({c: parse_ts(F.col(c)) for c in time_columns if c in rows.columns})


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8 as is, NULL fields left out."""
    df.write.mode("overwrite").json(hadoop_uri(path))
