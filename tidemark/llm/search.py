"""Ranked lexical search by MaxScore with bounds for pairs of terms.

A set of queries is answered in blocks of bounded text. For a block, one pass over the documents keeps each document's counts of
the block's terms; then the documents are cut into shards, and each shard's index is written: for every term its postings with
impacts and the largest impact, and for every pair of terms that some query uses the *intersection* of their postings, with
joint impacts and the largest joint impact. Every list also carries its 50th largest impact, which is a first threshold for all
queries that contain it, since impacts only add up.

A query pairs its terms by weight, neighbours together. A pair is bounded by its largest joint impact or that of one term alone,
which is less than the sum of both where the two never peak in one document. The bounds are summed from the smallest up: as soon as
the sum of the lists left is below the threshold, documents that only stand in these cannot rank and are skipped; the documents met so far
are looked up in the lists left, the intersection first, and are dropped once their bound falls below the threshold. The
threshold rises with the scores met. A part of the shards is answered first, and its 50th scores are the threshold for the others.

Defined results: a null or empty text, or one without terms, matches nothing and does not count; each other row is a document of
its own, so repeated rows rank one after another and a null doc_id comes last among equal scores. Rows equal in id and text are
one query; rows of one id with different texts are ranked each on its own. Terms are compared as 64-bit hashes. Texts of
any length are read whole; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.tokens import Words, hash_words, pieces

TOP = 50
#: Bytes of query texts that are answered in one go, about; more queries take more goes.
BLOCK = 4 << 20
#: Documents of a shard, and postings after which a shard ends earlier.
SHARD = 4096
POSTINGS = 500_000
#: One shard of so many is answered first.
FIRST = 32
# The ASCII characters of a term; all others from U+0080 on are part of one.
_TERM = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Block:
    """Some queries: their ids, their terms as numbers into ``terms``, ``hashes`` in ascending order."""

    ids: list
    terms: list[str]
    hashes: np.ndarray
    queries: list[list[int]]

    @classmethod
    def of(cls, rows: list) -> Block:
        words = [sorted({w.translate(_LOWER) for w in _TERM.findall(r["text"] or "")}) for r in rows]
        every = sorted({w for ws in words for w in ws})
        hashes = np.array(hash_words(every), np.uint64)
        order = np.argsort(hashes)
        number = {every[k]: at for at, k in enumerate(order.tolist())}
        return cls([r["item_id"] for r in rows], [every[k] for k in order.tolist()], hashes[order], [[number[w] for w in ws] for ws in words])


@dataclass(frozen=True)
class Plan:
    """Weights of a block's terms; each query's pairs as (term, term, number of the pair), and its terms left over."""

    weights: np.ndarray
    documents: int
    tokens: int
    pairs: list[tuple[int, int]]
    queries: list[tuple[list[tuple[int, int, int]], list[int]]]

    @classmethod
    def of(cls, block: Block, documents: int, tokens: int, frequency: dict[int, int]) -> Plan:
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1))) for t in range(len(block.terms))]
        pairs: dict[tuple[int, int], int] = {}
        queries = []
        for terms in block.queries:
            # Terms in no document, or without weight, add nothing.
            by_weight = sorted((t for t in terms if frequency.get(t) and weights[t]), key=lambda t: (weights[t], t))
            own = list(zip(by_weight[::2], by_weight[1::2], strict=False))
            queries.append(([(a, b, pairs.setdefault((a, b), len(pairs))) for a, b in own], by_weight[2 * len(own) :]))
        return cls(np.array(weights, np.int64), documents, tokens, list(pairs), queries)


def blocks(items: DataFrame, size: int = BLOCK) -> Iterator[list]:
    """The different queries, in lists of about ``size`` bytes of text."""
    items = stored(items.select("item_id", "text").distinct(), "queries")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // size))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        if rows:
            yield sorted(rows, key=lambda r: (r["item_id"] is None, str(r["item_id"]), r["text"] or ""))


def counted(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n (terms of the document), terms and counts (those of the block) for every document with a term."""
    hashes = block.hashes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in pieces(batch.column(1)):
                words = Words(data, bounds, "alnum")
                n = np.diff(words.first)
                owner = np.repeat(np.arange(len(n)), n)
                place = np.minimum(np.searchsorted(hashes, words.hash), max(len(hashes) - 1, 0))
                hit = hashes[place] == words.hash if len(hashes) else np.zeros(len(owner), bool)
                keys, counts = np.unique(owner[hit] * max(len(hashes), 1) + place[hit], return_counts=True)
                holder, term = keys // max(len(hashes), 1), keys % max(len(hashes), 1)
                some = np.flatnonzero(n)
                ends = pa.array(np.append(np.searchsorted(holder, some), len(holder)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at + some)), pa.array(n[some], pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<long>")


def _kth(values: np.ndarray, top: int) -> int:
    return int(np.partition(values, len(values) - top)[len(values) - top]) if len(values) >= top else 0


def index(vectors: DataFrame, plan: Plan, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """One row per shard and list. Lists 0 to terms - 1 are terms, the ones after that are pairs.

    most, kth: largest and top-th largest impact of the list; places, impacts: its postings. List -1 holds the shard's document
    ids by place, in ascending order, so that places order ties; nulls stand at the end and ``most`` is their number.
    """
    weights, pairs = plan.weights, plan.pairs

    def lists_of(part: list[pa.RecordBatch], name: str) -> pa.RecordBatch:
        table = pa.Table.from_batches(part)
        table = table.sort_by([("doc_id", "ascending")])  # nulls stand at the end
        n = np.asarray(table["n"], np.int64)
        terms, counts = (table[c].combine_chunks() for c in ("terms", "counts"))
        lengths = np.asarray(terms.value_lengths(), np.int64)
        term, tf = np.asarray(terms.flatten(), np.int64), np.asarray(counts.flatten(), np.int64)
        place = np.repeat(np.arange(len(n)), lengths)
        m = 50 + 50 * n * plan.documents // plan.tokens
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[place]))
        order = np.argsort(term, kind="stable")
        term, place, impact = term[order], place[order].astype(np.int32), impact[order]
        present, first = np.unique(term, return_index=True)
        last = np.append(first[1:], len(term))
        span = {int(t): slice(a, b) for t, a, b in zip(present, first, last, strict=True)}
        numbers, parts = [int(t) for t in present], [(place[s], impact[s]) for s in span.values()]
        for k, (a, b) in enumerate(pairs):
            if a in span and b in span:
                few, many = sorted((span[a], span[b]), key=lambda s: s.stop - s.start)
                at = np.minimum(np.searchsorted(place[many], place[few]), many.stop - many.start - 1)
                both = place[many][at] == place[few]
                if both.any():
                    numbers.append(len(weights) + k)
                    parts.append((place[few][both], impact[few][both] + impact[many][at[both]]))
        ids = table["doc_id"].combine_chunks()
        out = {
            "shard": pa.array([name] * (len(parts) + 1)), "list": pa.array([-1, *numbers], pa.int32()),
            "most": pa.array([ids.null_count, *(int(i.max()) for _, i in parts)], pa.int64()), "kth": pa.array([0, *(_kth(i, top) for _, i in parts)], pa.int64()),
            "places": pa.array([np.asarray(ids.fill_null(0), np.int64).tobytes(), *(p.tobytes() for p, _ in parts)], pa.binary()),
            "impacts": pa.array([b"", *(i.tobytes() for _, i in parts)], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, part, documents, postings = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 32):
                some = batch.slice(start, 32)
                part.append(some)
                documents, postings = documents + some.num_rows, postings + len(some.column(2).flatten())
                if documents >= shard or postings >= POSTINGS:
                    yield lists_of(part, f"{task}-{number}")
                    number, part, documents, postings = number + 1, [], 0, 0
        if part:
            yield lists_of(part, f"{task}-{number}")

    columns = "shard string, list int, most long, kth long, places binary, impacts binary"
    return vectors.where(F.size("terms") > 0).mapInArrow(build, columns)


class Shard:
    """The rows of one shard, to answer queries from."""

    def __init__(self, rows: list[tuple[int, int, bytes, bytes]], terms: int):
        self.terms = terms
        self.lists = {k: (np.frombuffer(places, np.int32), np.frombuffer(impacts, np.int64)) for k, _, places, impacts in rows if k >= 0}
        self.most = {k: most for k, most, _, _ in rows if k >= 0}
        nulls, ids = next((most, np.frombuffer(places, np.int64).tolist()) for k, most, places, _ in rows if k == -1)
        self.doc_ids = [*ids[: len(ids) - nulls], *[None] * nulls]

    def _bound(self, unit: tuple[int, ...]) -> int:
        """The most that a pair (term, term, pair) or a term alone can add to a score."""
        alone = max(self.most.get(t, 0) for t in unit[:2])
        return alone if len(unit) == 1 else max(alone, self.most.get(self.terms + unit[2], 0))

    def _found(self, number: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the places wanted stand in the list, their impacts)."""
        places, impacts = self.lists.get(number, (np.empty(0, np.int32), np.empty(0, np.int64)))
        if not len(places):
            return np.zeros(len(wanted), bool), impacts
        at = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
        hit = places[at] == wanted
        return hit, impacts[at[hit]]

    def _look_up(self, unit: tuple[int, ...], wanted: np.ndarray, score: np.ndarray) -> None:
        """Add what the unit holds of the places wanted to their scores."""
        open_ = np.arange(len(wanted))
        if len(unit) == 3:
            hit, impacts = self._found(self.terms + unit[2], wanted)
            score[hit] += impacts
            open_ = open_[~hit]
        for t in unit[:2]:
            hit, impacts = self._found(t, wanted[open_])
            score[open_[hit]] += impacts

    def best(self, pairs: list[tuple[int, int, int]], single: list[int], threshold: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the best documents with a score of at least ``threshold``, best first."""
        units = [u for u in [*pairs, *((t,) for t in single)] if any(t in self.lists for t in u[:2])]
        bounds = {u: self._bound(u) for u in units}
        units.sort(key=lambda u: (bounds[u], u))
        below = np.cumsum([0, *(bounds[u] for u in units)])  # below[k]: what the first k units can add
        total = np.zeros(len(self.doc_ids), np.int64)
        left = len(units)
        threshold = max(threshold, 1)
        while left and below[left] >= threshold:
            left -= 1
            for t in units[left][:2]:
                if t in self.lists:
                    places, impacts = self.lists[t]
                    total[places] += impacts
            threshold = max(threshold, _kth(total, top))
        places = np.flatnonzero(total + below[left] >= threshold) if left < len(units) else np.empty(0, np.int64)
        places = places[total[places] > 0]
        score = total[places]
        for k in range(left - 1, -1, -1):
            self._look_up(units[k], places, score)
            threshold = max(threshold, _kth(score, top))
            stay = score + below[k] >= threshold
            places, score = places[stay], score[stay]
        order = np.lexsort((places, -score))[:top]
        order = order[score[order] >= threshold]
        return places[order], score[order]


def answer(shards: DataFrame, block: Block, plan: Plan, thresholds: list[int], top: int, id_type) -> DataFrame:
    """item (number in the block), item_id, doc_id, score: the best documents of each shard."""

    def ask(part: pa.Table) -> pa.Table:
        rows = list(zip(*(part[c].to_pylist() for c in ("list", "most", "places", "impacts")), strict=True))
        shard = Shard(rows, len(plan.weights))
        out: dict[str, list] = {"item": [], "doc_id": [], "score": []}
        for q, (pairs, single) in enumerate(plan.queries):
            places, scores = shard.best(pairs, single, thresholds[q], top)
            out["item"] += [q] * len(places)
            out["doc_id"] += [shard.doc_ids[p] for p in places]
            out["score"] += scores.tolist()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    # A shard's lists are small rows that are read in small batches, and a shard is a group of bounded size.
    found = shards.drop("kth").groupBy("shard").applyInArrow(ask, "item long, doc_id long, score long")
    names = shards.sparkSession.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {id_type}")
    return found.join(F.broadcast(names), "item")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    best_first = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every query, from rank 1 on."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    id_type = items.schema["item_id"].dataType.simpleString()
    result = None
    for rows in blocks(items, block):
        queries = Block.of(rows)
        vectors = stored(counted(docs, queries), "term-counts")
        documents, tokens = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents or not queries.terms:
            continue
        # As many rows as the block has terms.
        frequency = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())
        plan = Plan.of(queries, documents, tokens, frequency)
        shards = stored(index(vectors, plan, top, shard), "search-index")
        # As many rows as the block has terms and pairs.
        kth = dict(shards.groupBy("list").agg(F.max("kth").alias("kth")).toLocalIterator())
        thresholds = [max((kth.get(k, 0) for a, b, p in pairs for k in (a, b, len(plan.weights) + p)), default=0) for pairs, _ in plan.queries]
        thresholds = [max([t, *(kth.get(x, 0) for x in single)]) for t, (_, single) in zip(thresholds, plan.queries, strict=True)]
        early = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
        first = stored(_ranked(answer(shards.where(early), queries, plan, thresholds, top, id_type), top), "first-answers")
        for item, score in first.where(F.col("rank") == top).select("item", "score").toLocalIterator():
            thresholds[item] = max(thresholds[item], score)
        found = first.drop("rank").unionByName(answer(shards.where(~early), queries, plan, thresholds, top, id_type))
        ranked = stored(_ranked(found, top).select("item_id", "rank", "doc_id", "score"), "answers")
        result = ranked if result is None else result.unionByName(ranked)
    return result if result is not None else spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
