"""Mixing of sources to target weights, as fixed-length blocks of tokens dealt to output shards.

The documents of a source stand one after another in a pseudorandom order and are cut into blocks of ``BLOCK`` words (a source's
last block may be shorter). Every output shard draws how many of its slots go to which source from a multinomial distribution
with the targets as chances. The draws of a source over all shards do not add up to its target by themselves: what a source
drew too much is given, spread over its shards, to sources that drew too little, so that every source gets exactly its number of
slots. The slots of a source are numbered; number ``j`` is the block at ``j mod blocks`` of the source's permutation for
the pass ``j div blocks``: a keyed Feistel network on the block indexes, so that no permutation is ever stored. Blocks and
documents meet in a join on (source, block index).

Since no target is above three times its source, no block is taken more than three times, and so no document.

All running numbers (documents of a source, slots of a source over the shards) are totals within buckets plus totals of the
buckets before, both about the root of the rows, so a source of any size is spread over many tasks.

Defined results: a null or blank text has size 0, takes part with nothing and is returned. A null source is a source of its own,
after all others. Repeated rows are documents of their own. Any id may be null. A word is never cut; a text of any length spans
as many blocks as it needs. Without any words all targets are 0. The result hangs on the rows and ``seed`` alone, not on
files or partitions: documents are ordered by a hash of id and text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

#: Weights of the sources in order, repeating; how often a source may be taken at most.
WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 32
#: Slots of an output shard.
SHARD = 1024
SEED = 20_240_501
#: Sources whose chances one draw holds at a time. More sources are drawn by groups of so many first.
GROUP = 4096
_WORD = "[^\\x20\\x09-\\x0D]+"


def running(rows: DataFrame, by: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of ``by``. ``rows`` has a column ``bucket``; buckets go first."""
    within = Window.partitionBy(*by, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy(*by, "bucket").agg(F.sum(value).alias("__sum"))
    buckets = buckets.select(*by, "bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    own = rows.withColumn("__own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(buckets, [*by, "bucket"]).withColumn(name, (F.col("__own") + F.col("__before")).cast("bigint")).drop("__own", "__before")


def _root(n: int) -> int:
    return max(1, math.isqrt(n))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each index in a pseudorandom permutation of ``range(size)`` chosen by its key.

    Four Feistel rounds on the smallest even number of bits that holds ``size``; results beyond it go round again, which keeps
    the map one to one.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64) + 1)).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        h, m, x, k = half[open_], mask[open_], out[open_], key[open_].astype(np.uint64)
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (_mixed(right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1)) & m)
        out[open_] = (left << h) | right
        open_ = open_[out[open_] >= size[open_].astype(np.uint64)]
    return out.astype(np.int64)


def _permutation(seed: int):
    """As a column function of (index, size, key)."""

    @F.pandas_udf("long")
    def place(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(np.int64), size.to_numpy(np.int64), key.to_numpy(np.int64) ^ seed))

    return place


def sized(docs: DataFrame, doc_id: str, text: str, source: str, keep_text: bool) -> DataFrame:
    """doc_id, source, size, order key ``h``; the text too if asked for."""
    size = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")
    # Texts of one hash and one id keep one order whichever task meets them first, since they are taken alike.
    h = F.xxhash64(F.col(doc_id), F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), h.alias("h"), *([F.col(text).alias("text")] if keep_text else []))


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, rank (from 0, by code point, null last) and target, one row per source.

    The level at which uncapped sources share by weight is raised until no source is above its cap; every turn is one aggregate
    over the sources and caps at least one more of them.
    """
    sums = stored(rows.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")), "mix-sources")
    n = sums.count()
    # Ranks by range: sources are dealt into ordered partitions, and the partitions before are added up.
    parts = max(1, _root(n // 1000))
    dealt = stored(sums.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("bucket", F.spark_partition_id()), "mix-sources")
    ranked = running(dealt.withColumn("one", F.lit(1)), [], [F.col("source").asc_nulls_last()], "one", "rank").drop("one", "bucket")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", weight.cast("bigint")), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    wide = "decimal(38,0)"
    level = Fraction(0)
    capped = F.lit(False)
    while total:
        at_cap, free = ranked.agg(F.sum(F.when(capped, F.col("source_size") * REPEATS)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not free:
            break
        higher = Fraction(total - (at_cap or 0), free)
        if higher == level:
            break
        level = higher
        cap = F.col("source_size").cast(wide) * F.lit(REPEATS * level.denominator).cast(wide)
        capped = cap <= F.col("weight").cast(wide) * F.lit(level.numerator).cast(wide)
    share = F.col("weight") * F.lit(level.numerator).cast("double") / F.lit(level.denominator).cast("double")
    return ranked.withColumn("target", F.when(capped, F.col("source_size") * F.lit(float(REPEATS))).otherwise(share))


def drawn(chances: DataFrame, slots: int, shard: int, seed: int, group: int = GROUP) -> DataFrame:
    """shard, rank, n: how many of each output shard's slots fall to each source, drawn anew for each shard.

    Up to ``group`` sources are drawn at once, and so are groups of sources beyond: first how many slots go to a group, then
    how these are divided in it, which is the same distribution.
    """
    spark = chances.sparkSession
    shards = spark.range(-(-slots // shard)).select(F.col("id").alias("shard"), F.least(F.lit(shard), F.lit(slots) - F.col("id") * shard).alias("slots"))
    grouped = chances.withColumn("group", F.floor(F.col("rank") / group))
    # A number per group of sources.
    sums = grouped.groupBy("group").agg(F.sum("target").alias("p")).orderBy("group").toPandas()

    def draw(batches: Iterator[pa.RecordBatch], p: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"shard": [], "rank": [], "n": []}
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                own = np.array(row["p"]) if p is None else p
                counts = np.random.default_rng([seed, row["shard"], row.get("group", -1) + 1]).multinomial(row["slots"], own / own.sum())
                some = np.flatnonzero(counts)
                first = row.get("group", 0) * group
                out["shard"] += [row["shard"]] * len(some)
                out["rank"] += (first + some).tolist()
                out["n"] += counts[some].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))

    schema = "shard long, rank long, n long"
    if len(sums) <= 1:
        p = np.array([r[0] for r in chances.orderBy("rank").select("target").toLocalIterator()])
        return shards.mapInArrow(lambda batches: draw(batches, p), schema)
    p = sums["p"].to_numpy(np.float64)
    by_group = shards.mapInArrow(lambda batches: draw(batches, p), schema).select("shard", F.col("rank").alias("group"), F.col("n").alias("slots"))
    lists = grouped.groupBy("group").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "target"))), lambda x: x["target"]).alias("p"))
    return by_group.join(lists, "group").select("shard", "slots", "group", "p").mapInArrow(lambda batches: draw(batches, None), schema)


def settled(draws: DataFrame, chances: DataFrame, shard_count: int, seed: int) -> DataFrame:
    """``draws`` with every source at exactly its number of slots (``slots`` of ``chances``).

    A source above it gives slots away in shards spread evenly over all it has; a slot given goes to a source below, through a
    permutation of all slots given. Few slots move: about the root of all.
    """
    place = _permutation(seed)
    got = draws.groupBy("rank").agg(F.sum("n").alias("got"))
    off = stored(chances.join(got, "rank", "left").select("rank", "slots", F.coalesce("got", F.lit(0)).alias("got"), F.lit(0).alias("bucket")), "mix-off")
    over = draws.join(off.where("got > slots").drop("bucket"), "rank").withColumn("bucket", F.floor(F.col("shard") / _root(shard_count)))
    over = running(over, ["rank"], [F.col("shard")], "n", "base")
    spread = [F.floor((F.col("base") + x).cast("decimal(38,0)") * (F.col("got") - F.col("slots")) / F.col("got")) for x in (F.col("n"), F.lit(0))]
    given = stored(over.select("shard", "rank", (spread[0] - spread[1]).cast("bigint").alias("n")).where("n > 0"), "mix-given")
    moved = given.agg(F.sum("n")).first()[0] or 0
    if not moved:
        return draws
    numbered = running(given.withColumn("bucket", F.floor(F.col("shard") / _root(shard_count))), [], [F.col("shard"), F.col("rank")], "n", "base")
    freed = numbered.select("shard", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("at"))
    freed = freed.select("shard", place("at", F.lit(moved).cast("bigint"), F.lit(0).cast("bigint")).alias("at"))
    short = off.where("got < slots").withColumn("n", F.col("slots") - F.col("got"))
    short = running(short.withColumn("bucket", F.floor(F.col("rank") / GROUP)), [], [F.col("rank")], "n", "base")
    wanted = short.select("rank", F.explode(F.sequence(F.col("base"), F.col("base") + F.col("n") - 1)).alias("at"))
    taken = freed.join(wanted, "at").select("shard", "rank", F.lit(1).cast("bigint").alias("n"))
    every = draws.unionByName(given.withColumn("n", -F.col("n"))).unionByName(taken)
    return every.groupBy("shard", "rank").agg(F.sum("n").alias("n")).where("n > 0")


class Mix:
    """A mix of ``docs``: its targets, its slots, and what it takes of each document."""

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        block: int = BLOCK, shard: int = SHARD, seed: int = SEED, group: int = GROUP, keep_text: bool = False,
    ):
        self.block, self.shard, self.seed = block, shard, seed
        self.documents = stored(sized(docs, doc_id, text, source, keep_text), "mix-documents")
        self.sources = stored(targets(self.documents), "mix-targets")
        blocks = F.ceil(F.col("source_size") / block)
        # As many blocks as come nearest to the target; three passes at a cap are three times all blocks.
        slots = F.least(F.round(F.col("target") * blocks / F.col("source_size")), blocks * REPEATS).cast("bigint")
        chances = self.sources.where("source_size > 0").select("rank", "target", blocks.cast("bigint").alias("blocks"), slots.alias("slots"))
        self._chances = stored(chances, "mix-chances")
        self._count = self._chances.agg(F.sum("slots")).first()[0] or 0
        self._group = group

    def slots(self) -> DataFrame:
        """shard, slot, rank of the source, block: what stands where in the mix."""
        spark = self.documents.sparkSession
        if not self._count:
            return spark.createDataFrame([], "shard long, slot long, rank long, block long")
        shard_count = -(-self._count // self.shard)
        # Sources with a target near 0 may have no slot; all slots are drawn from all sources all the same.
        draws = stored(drawn(self._all_ranks(), self._count, self.shard, self.seed, self._group), "mix-draws")
        counts = stored(settled(draws, self._chances, shard_count, self.seed), "mix-counts")
        counts = running(counts.withColumn("bucket", F.floor(F.col("shard") / _root(shard_count))), ["rank"], [F.col("shard")], "n", "base")
        in_shard = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("from", F.coalesce(F.sum("n").over(in_shard), F.lit(0))).join(self._chances.select("rank", "blocks"), "rank")
        # A row becomes up to a shard of slots: dealt out before that, about 200,000 slots to a task.
        counts = counts.repartition(-(-self._count // 200_000), "shard")
        one = counts.select("shard", "rank", "blocks", "base", "from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"))
        place = _permutation(self.seed)
        number, turn = F.col("base") + F.col("i"), F.expr("(base + i) div blocks")
        held = F.least(F.lit(self.shard), F.lit(self._count) - F.col("shard") * self.shard).cast("bigint")
        return one.select(
            "shard",
            place((F.col("from") + F.col("i")).cast("bigint"), held, F.xxhash64(F.lit("slot"), "shard")).alias("slot"),
            "rank",
            place(number % F.col("blocks"), "blocks", F.xxhash64(F.lit("block"), "rank", turn)).alias("block"),
        )

    def _all_ranks(self) -> DataFrame:
        return self.sources.select("rank", F.when(F.col("source_size") > 0, F.col("target")).otherwise(0.0).alias("target"))

    def _placed(self) -> DataFrame:
        """Documents with words: their columns, rank, target, start (place of the first word in the source), first and last block."""
        n = self.documents.count()
        of = self.sources.select(F.col("source").alias("of"), "rank", "source_size", "target")
        ranked = self.documents.where("size > 0").join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        ranked = ranked.withColumn("bucket", F.pmod("h", F.lit(_root(n))))
        placed = running(ranked, ["rank"], [F.col("h"), F.col("doc_id")], "size", "start").drop("bucket", "h")
        ends = {"first": F.floor(F.col("start") / self.block), "last": F.floor((F.col("start") + F.col("size") - 1) / self.block)}
        return placed.withColumns(ends)

    def _within(self, block: Column) -> tuple[Column, Column]:
        """(first word of a document in a block, words of it there)."""
        begin = F.greatest(F.col("start"), block * self.block) - F.col("start")
        return begin, F.least(F.col("start") + F.col("size"), (block + 1) * self.block) - F.col("start") - begin

    def report(self) -> DataFrame:
        """One row per document: doc_id, size, source_size, target, taken."""
        uses = self.slots().groupBy("rank", "block").agg(F.count("*").alias("uses"))
        # By (source, place in it) each document with words is known, whatever its id.
        _, length = self._within(F.col("block"))
        pieces = self._placed().withColumn("block", F.explode(F.sequence("first", "last"))).withColumn("length", length)
        met = pieces.select("rank", "block", "start", "length", "doc_id", "size", "source_size", "target").join(uses, ["rank", "block"], "left")
        taken = F.sum(F.col("length") * F.coalesce("uses", F.lit(0))).cast("bigint").alias("taken")
        kept = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
        full = met.groupBy("rank", "start").agg(*kept, taken).drop("rank", "start")
        of = self.sources.select(F.col("source").alias("of"), "source_size", "target")
        empty = self.documents.where("size = 0").join(of, F.col("source").eqNullSafe(F.col("of")))
        return full.unionByName(empty.select("doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken")))

    def texts(self) -> DataFrame:
        """shard, slot, source, text: the words of every slot's block, one space between words. Needs ``keep_text``."""

        def part(block: Column) -> Column:
            begin, length = self._within(block)
            return F.struct(block.alias("block"), F.slice("words", begin.cast("int") + 1, length.cast("int")).alias("words"))

        words = self._placed().withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
        parts = words.select("rank", "source", "start", F.explode(F.transform(F.sequence("first", "last"), part)).alias("part")).select("rank", "source", "start", "part.*")
        # A block holds at most as many documents as words.
        blocks = parts.groupBy("rank", "block").agg(F.first("source").alias("source"), F.sort_array(F.collect_list(F.struct("start", "words"))).alias("parts"))
        text = F.array_join(F.flatten(F.transform("parts", lambda p: p["words"])), " ")
        return self.slots().join(blocks.select("rank", "block", "source", text.alias("text")), ["rank", "block"]).select("shard", "slot", "source", "text")
