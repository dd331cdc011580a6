"""Benchmark decontamination: find the windows of test items inside training documents.

The windows of the benchmark are a hash set that is broadcast. A document is not cut into all its
windows: of every window of ``L`` words, one aligned gram of ``(L + 1) // 2`` words lies at a position
that is a multiple of ``L - g + 1``, so only those grams are looked up, and only where one is known are
the windows around it compared word by word. Everything runs in Spark's own functions. The arrays are
exploded with the outer forms: for the others Spark infers a filter that would tokenise the text again.

Defined results: a null text has no words; an item without words has no window; an item shorter than
the window is one window; repeated rows each keep their row; a null ``doc_id`` is a value like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A set of at most so many grams or windows is broadcast (8 or about 100 bytes each); a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Lower-case the letters A-Z and take the words."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def gram_of(length: int) -> tuple[int, int]:
    """Words of a gram, and the stride at which every window of ``length`` words holds one whole."""
    size = (length + 1) // 2
    return size, length - size + 1


def _gram(tokens: Column, at: Column, length: int) -> Column:
    size, _ = gram_of(length)
    return F.xxhash64(F.lit(length), *[F.get(tokens, at + k) for k in range(size)])


def _gram_at(length: int):
    return lambda at: _gram(F.col("w"), at, length)


def _placed_gram(length: int):
    return lambda at: F.struct(F.lit(length).alias("length"), at.alias("at"), _gram(F.col("w"), at, length).alias("gram"))


def item_windows(bench: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per different window text: ``length``, ``window``, ``items`` (ids as sorted text), ``grams``."""
    tokens = bench.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.lit(window), F.size("w"))
    placed = tokens.select("item", "w", length.alias("length"), F.explode_outer(F.sequence(F.lit(0), F.size("w") - length)).alias("at"))
    texts = placed.select("item", "length", F.slice("w", F.col("at") + 1, F.col("length")).alias("w"))
    return texts.groupBy("length", F.array_join("w", " ").alias("window")).agg(F.sort_array(F.collect_set("item")).alias("items"), F.first("w").alias("w"))


def _held(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def scan(docs: DataFrame, bench: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``n_words``, ``n_hit``, ``items``, ``spans``.

    ``n_hit`` counts the words inside any occurring window; ``spans`` lists (start, length) of the
    windows in words; ``items`` lists the ids of the items they come from, as sorted text.
    """
    known = stored(item_windows(bench, window), "bench-windows")
    lengths = [r[0] for r in known.select("length").distinct().orderBy("length").collect()]  # at most `window` values
    first_grams = None
    for length in lengths:
        size, stride = gram_of(length)
        own = known.where(F.col("length") == length).select(
            F.explode_outer(F.transform(F.sequence(F.lit(0), F.lit(length - size)), _gram_at(length))).alias("gram")
        )
        first_grams = own if first_grams is None else first_grams.unionAll(own)
    # Gram 0 at position -1 stands for the document itself, so that one pass serves all documents.
    row = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), words(F.col(text)).alias("w"))
    entry = "array<struct<length:int,at:int,gram:bigint>>"
    looked_up = [F.array(F.struct(F.lit(0).alias("length"), F.lit(-1).alias("at"), F.lit(0).cast("bigint").alias("gram"))).cast(entry)]
    for length in lengths:
        size, stride = gram_of(length)
        places = F.sequence(F.lit(0), F.size("w") - size, F.lit(stride))
        grams = F.transform(places, _placed_gram(length))
        looked_up.append(F.when(F.size("w") >= length, grams).otherwise(F.array().cast(entry)).cast(entry))
    grams = row.select("doc_id", "text_hash", "w", F.size("w").alias("n_words"), F.concat(*looked_up).alias("grams"))
    grams = grams.select("doc_id", "text_hash", "w", "n_words", F.inline_outer("grams"))
    spark = docs.sparkSession
    gram_set = spark.range(1).select(F.lit(0).cast("bigint").alias("gram"))
    gram_set = gram_set if first_grams is None else stored(gram_set.unionAll(first_grams).distinct(), "bench-grams")
    near = grams.join(_held(gram_set), "gram", "left_semi")
    starts = F.lit(None).cast("array<int>")
    for length in lengths:
        size, _ = gram_of(length)
        around = F.sequence(F.greatest(F.lit(0), F.col("at") - (length - size)), F.least(F.col("at"), F.col("n_words") - length))
        starts = F.when(F.col("length") == length, around).otherwise(starts)
    around = near.select("doc_id", "text_hash", "n_words", "length", "w", F.explode_outer(F.when(F.col("at") < 0, F.array(F.lit(-1))).otherwise(starts)).alias("start"))
    texts = around.select(
        "doc_id", "text_hash", "n_words", "length", "start",
        F.when(F.col("start") >= 0, F.array_join(F.slice("w", F.col("start") + 1, F.col("length")), " ")).alias("window"),
    )
    found = texts.join(_held(known.select("length", "window", "items")), ["length", "window"], "left").where("start < 0 or items is not null")
    inside = F.col("start") >= 0
    per_doc = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count_if(~inside).alias("copies"),
        F.sort_array(F.collect_set(F.when(inside, F.struct("start", "length")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["total"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("total"),
        ),
        lambda a: a["total"],
    )
    return per_doc.select("doc_id", "text_hash", F.col("n_words").cast("bigint").alias("n_words"), covered.alias("n_hit"), "items", "spans", F.explode_outer(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def report(docs: DataFrame, bench: DataFrame, window: int = 10) -> DataFrame:
    """The digest of :func:`scan`, one row per document."""
    found = scan(docs, bench, window)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, bench: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns.

    The contaminated documents' keys are written first; by the size of those files Spark broadcasts
    them or shuffles both sides.
    """
    bad = stored(scan(docs, bench, window, doc_id, text).where("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), "contaminated")
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__hash")), "left_anti")
