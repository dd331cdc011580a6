"""Vector compression: a vector is cut into parts and each part becomes the index of its codebook's nearest entry.

Components are whole numbers, ``floor(4096 * x)``, so every sum and distance is exact and no order of work changes a bit. A
codebook starts as that part of the vectors with the smallest ids and is moved a few times to the means of its parts: each round
is one pass that sends back sums per entry, a few thousand numbers per task.

The nearest entry is found by Orchard's search: for every entry its neighbours are listed by distance; a query walks the list of
its best entry so far, jumps to the list of an entry that is nearer, leaves out entries seen before, and stops where a
neighbour is further from the best entry than twice the query is. All parts of a batch take these steps together.

Defined results: vectors that are null or hold null or non-finite components are dropped. The width is that of the vector with
the smallest id (a null id is the largest; equal ids go by their components). A vector of another width, of a width that does
not divide into the parts, or with a component of 16384 or more in size, whose squares would leave 64 bits, is kept with a null
code and a null error and moves no entry. Repeated rows are coded alike and count as often as they stand there. Ties go to the
lower entry. With fewer vectors than entries the codebooks are shorter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
_LARGEST = 1 << 26
#: Vectors that walk their lists together; bounds the memory of a task.
BLOCK = 4096
#: Labels with more than one of so many rows get their sums by broadcast: fewer labels than this number can have so many.
HEAVY = 1000


class Orchard:
    """Nearest entry of one codebook (entries x width, whole numbers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(self.apart, axis=1, kind="stable")

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) for each query; equal distances go to the lower index.

        A neighbour s of the best entry c that is as near to q as c has d(c, s) <= d(q, c) + d(q, s) <= 2 d(q, c), so stopping
        strictly beyond that loses neither a nearer entry nor a tie.
        """
        n = len(queries)
        best = np.zeros(n, np.int64)
        nearest = ((queries - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, len(self.entries)), bool)
        seen[:, 0] = True
        at = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            met = self.near[best[walking], at[walking]]
            on = self.apart[best[walking], met] <= 4 * nearest[walking]
            walking, met = walking[on], met[on]
            at[walking] += 1
            new = ~seen[walking, met]
            who, met = walking[new], met[new]
            seen[who, met] = True
            d = ((queries[who] - self.entries[met]) ** 2).sum(axis=1)
            better = (d < nearest[who]) | ((d == nearest[who]) & (met < best[who]))
            who, met, d = who[better], met[better], d[better]
            best[who], nearest[who], at[who] = met, d, 0
            walking = walking[at[walking] < len(self.entries)]
        return best, nearest


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]``: the codebook of a part, entries x width of a part."""

    width: int
    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Entries at the floored means of their parts; entries without parts stay."""
        used = counts[:, :, None] > 0
        return Codebooks(self.width, np.where(used, sums // np.maximum(counts, 1)[:, :, None], self.entries))


def _kept(vectors: DataFrame, embedding: str) -> DataFrame:
    """Rows of whole finite vectors, with the vector as doubles in ``__v`` (floats are doubles exactly)."""
    rows = vectors.withColumn("__v", F.col(embedding).cast("array<double>"))
    return rows.where(F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _blocks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole components) of the rows that can be coded, some at a time."""
    for start in range(0, batch.num_rows, BLOCK):
        lists = batch.column(column).slice(start, BLOCK)
        fits = np.flatnonzero(np.array(lists.value_lengths().fill_null(-1)) == width)
        if not len(fits):
            continue
        values = np.floor(lists.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False) * SCALE).reshape(len(fits), width)
        small = (np.abs(values) < _LARGEST).all(axis=1)
        if small.any():
            yield start + fits[small], values[small].astype(np.int64)


def start(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors with the smallest ids, or None where no vector can be coded."""
    rows = _kept(vectors, embedding).select(F.col(vec_id).alias("id"), "__v")
    order = [F.col("id").asc_nulls_last(), "__v"]
    first = rows.orderBy(*order).limit(1).collect()
    width = len(first[0]["__v"]) if first else 0
    if not width or width % parts:
        return None
    codable = (F.size("__v") == width) & F.forall("__v", lambda x: F.abs(F.floor(x * SCALE)) < _LARGEST)
    smallest = rows.where(codable).orderBy(*order).limit(entries).collect()
    whole = np.floor(np.array([r["__v"] for r in smallest], np.float64) * SCALE).astype(np.int64)
    if not len(whole):
        return None
    return Codebooks(width, whole.reshape(len(whole), parts, width // parts).transpose(1, 0, 2))


def round_of(vectors: DataFrame, books: Codebooks, embedding: str = "embedding") -> Codebooks:
    """One pass: every part to its nearest entry, entries to the means of their parts."""
    parts, n, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(e) for e in books.entries]
        total, count = np.zeros((parts, n, width), np.int64), np.zeros((parts, n), np.int64)
        for batch in batches:
            for _, values in _blocks(batch, 0, books.width):
                for p, search in enumerate(searches):
                    mine = values[:, p * width : (p + 1) * width]
                    code, _ = search.nearest(mine)
                    order = np.argsort(code, kind="stable")
                    used, first = np.unique(code[order], return_index=True)
                    total[p, used] += np.add.reduceat(mine[order], first, axis=0)
                    count[p] += np.bincount(code, minlength=n)
        slot = np.arange(parts * n * (width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.concatenate([count[:, :, None], total], axis=2).ravel())], ["slot", "total"])

    found = _kept(vectors, embedding).select("__v").mapInArrow(sums, "slot long, total long")
    table = np.zeros(parts * n * (width + 1), np.int64)
    # As many rows as the codebooks have numbers, sent in one job: an iterator would run a job for each shuffle partition.
    for slot, total in found.groupBy("slot").agg(F.sum("total").alias("total")).collect():
        table[slot] = total
    table = table.reshape(parts, n, width + 1)
    return books.moved(table[:, :, 1:], table[:, :, 0])


def train(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    books = start(vectors, vec_id, embedding, parts, entries)
    for _ in range(rounds if books else 0):
        books = round_of(vectors, books, embedding)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, keep: list[str], embedding: str = "embedding") -> DataFrame:
    """``keep`` columns of every kept row, with code (two hex digits for each part) and error (squared distances summed)."""
    rows = _kept(vectors, embedding).select(*keep, "__v")
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    if books is None:
        return rows.select(*keep, F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    parts, _, width = books.entries.shape

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(e) for e in books.entries]
        for batch in batches:
            code = np.zeros((batch.num_rows, parts), np.uint8)
            error, done = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            for at, values in _blocks(batch, len(keep), books.width):
                done[at] = True
                for p, search in enumerate(searches):
                    code[at, p], d = search.nearest(values[:, p * width : (p + 1) * width])
                    error[at] += d
            text = [c.tobytes().hex() if ok else None for c, ok in zip(code, done, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(text, pa.string()), pa.array(error, mask=~done)], [*keep, "code", "error"])

    return rows.mapInArrow(codes, f"{schema}, code string, error long")


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error (errors summed over equal labels), codebooks_sha256."""
    if entries > 256:
        raise ValueError("an index has two hex digits")
    vectors = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    books = train(vectors, parts=parts, entries=entries, rounds=rounds)
    coded = stored(encode(vectors, books, ["vec_id", "label"]), "codes")
    sums = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    # A label may hold a third of all rows: the few heavy ones are looked up by broadcast, the others are joined by key.
    least = coded.count() // HEAVY
    heavy, light = sums.where(F.col("n") > least).drop("n"), sums.where(F.col("n") <= least).drop("n")
    same = F.col("label").eqNullSafe(F.col("of"))
    tried = coded.join(F.broadcast(heavy.withColumn("found", F.lit(True))), same, "left").drop("of")
    by_key = tried.where("found is null").drop("label_error").join(light, same, "left").drop("of")
    joined = tried.where("found").unionByName(by_key)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))
