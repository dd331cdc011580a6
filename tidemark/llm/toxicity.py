"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, weighed by context.

The lexicon is learned from labelled documents: words, and word beginnings (languages that compound),
whose share of toxic documents cannot be chance. Every distinct word of a text is run through the trie: an exact or
beginning match is a hit; an automaton of edit distance 1 over the trie finds misspelled terms. A window
of words around each hit tells quotation (quote marks, reporting words) from abuse. Counts of abusive,
quoted and misspelled hits are weighed by log odds learned from the same rows.

``FIT_ROWS`` labelled rows of each class at most are used to fit, chosen by a hash of their id. Both classes are
counted over all labelled rows: a class that was cut has more weight per row, so that the prior and the share that
a term must have are those of the corpus at every size. All rows are scored, whole texts, with the same weights.
Labels, language, source and id are never inputs of a score.

Defined results: a null text is empty; an empty text has no hits and gets the score of such texts;
without labelled rows of both classes every score is 0; repeated rows each keep their row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

FIT_ROWS = 20_000
LEXICON = 20_000  # terms and beginnings at most, the most telling first
BEGINNINGS = (4, 5, 6, 7)
MISSPELLED_FROM = 5  # letters of a term whose misspellings count
WINDOW = 6  # words on each side of a hit in which quote marks count
REPORTED = 3  # words before a hit in which a reporting word counts
CUTOFF = 0.7
MEMORY = 300_000  # distinct words remembered by a worker; only the speed hangs on it
WORDS = re.compile(r"[^\W_]+")
QUOTES = "\"“”„«»‘"
# Words that report what others say, in the languages of the corpora.
REPORTING = frozenset(
    "said says say quote quoted quotes word words called calling term terms wrote reported slur insult insults "
    "sagte schrieb zitat wort genannt dit mot cité citation appelé dijo palabra cita llamado escribió".split()
)


def folded(doc_id: Column) -> Column:
    """Whether a row is held out from fitting."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def features(text: str) -> set[str]:
    """Whole words (ending in a blank) and beginnings of words."""
    words = set(WORDS.findall(text.lower()))
    return {f"{w} " for w in words} | {w[:n] for w in words for n in BEGINNINGS if len(w) > n}


@dataclass
class Trie:
    """Whole terms and beginnings. ``find`` tells how a word meets them."""

    terms: frozenset[str]
    beginnings: frozenset[str]
    innocent: frozenset[str] = frozenset()
    _root: dict = field(default_factory=dict)
    _heads: set = field(default_factory=set)
    _tails: set = field(default_factory=set)

    def __post_init__(self) -> None:
        for term in self.terms:
            if len(term) >= MISSPELLED_FROM:
                node = self._root
                for c in term:
                    node = node.setdefault(c, {})
                node[""] = True
                self._heads.add(term[:2])
                self._tails.add(term[-2:])

    def misspelled(self, word: str) -> bool:
        """Whether the automaton of edits up to 1 of ``word`` and the trie have a term in common."""
        # One edit leaves the first two or the last two letters of a term of five as they are.
        if len(word) < MISSPELLED_FROM - 1 or (word[:2] not in self._heads and word[-2:] not in self._tails):
            return False
        n = len(word)
        todo = [(self._root, 0, 0)]  # trie node, letters of the word read, edits made
        seen = set()
        while todo:
            node, at, edits = todo.pop()
            if (id(node), at, edits) in seen:
                continue
            seen.add((id(node), at, edits))
            if "" in node and edits + (n - at) <= 1:
                return True
            if at < n and word[at] in node:
                todo.append((node[word[at]], at + 1, edits))
            if edits == 0:
                for c, below in node.items():
                    if c:
                        todo.append((below, at, 1))  # a letter of the term is missing
                        if at < n:
                            todo.append((below, at + 1, 1))  # another letter stands there
                        if at + 1 < n and c == word[at + 1] and word[at] in below:
                            todo.append((below[word[at]], at + 2, 1))  # two letters swapped
                if at < n:
                    todo.append((node, at + 1, 1))  # a letter too many
        return False

    def find(self, word: str) -> int:
        """0: no hit, 1: a term, or a beginning of the word, 2: a misspelled term."""
        if word in self.terms or any(word[:n] in self.beginnings for n in BEGINNINGS if len(word) > n):
            return 1
        return 2 if word not in self.innocent and self.misspelled(word) else 0


class Memory(dict):
    """What was found for words met before."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = self.trie.find(word)
        return found


def hits(text: str, memory: Memory) -> tuple[int, int, int]:
    """(abusive, quoted, misspelled) hits of a text."""
    words = WORDS.findall(text.lower())
    found = [k for k, w in enumerate(words) if memory[w]]
    if not found:
        return 0, 0, 0
    places = [(m.start(), m.end()) for m in WORDS.finditer(text.lower())]
    low, abusive, quoted, misspelled = text.lower(), 0, 0, 0
    for k in found:
        a, b = max(0, k - WINDOW), min(len(words), k + WINDOW + 1)
        before, after = low[places[a][0] : places[k][0]], low[places[k][1] : places[b - 1][1] + 1]
        marked = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
        if marked or any(w in REPORTING for w in words[max(0, k - REPORTED) : k]):
            quoted += 1
        elif memory[words[k]] == 1:
            abusive += 1
        else:
            misspelled += 1
    return abusive, quoted, misspelled


def bucket(counts: tuple[int, int, int]) -> tuple[int, int, int]:
    return min(counts[0], 3), min(counts[1], 2), min(counts[2], 2)


@dataclass(frozen=True)
class Model:
    """A trie and, for each kind of hit and each bucket, log odds. Small enough to travel with the tasks."""

    trie: Trie
    prior: float
    odds: tuple[dict[int, float], ...]

    def score(self, counts: tuple[int, int, int]) -> float:
        if not self.odds:
            return 0.0
        x = self.prior + sum(odds.get(b, 0.0) for odds, b in zip(self.odds, bucket(counts), strict=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def _counted(docs: DataFrame, per_doc) -> DataFrame:
    """Sum ``per_doc(text, toxic) -> keys`` over documents (text, toxic), with partial sums in the tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                seen: Counter = Counter()
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seen.update((key, toxic) for key in per_doc(text or "", toxic))
                keys = list(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in keys], pa.string()), pa.array([t for _, t in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
                    ["key", "toxic", "n"],
                )

    rows = docs.select("text", "toxic").mapInArrow(partial, "key string, toxic int, n long")
    return rows.groupBy("key").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))


def _surprise(bad: int, good: int, base: float) -> float:
    """Log-likelihood ratio of the share of toxic documents against the base share, where it is above."""
    n = bad + good
    share = bad / n if n else 0.0
    if share <= base:
        return 0.0
    return 2 * (bad * math.log(share / base) + (good * math.log((1 - share) / (1 - base)) if good else 0.0))


def most_general(telling: dict[str, int]) -> tuple[frozenset[str], frozenset[str]]:
    """Of telling words and beginnings (with their toxic documents), those that the others do not make needless.

    A longer beginning goes if a shorter one is in clearly more documents, else the shorter goes; a word goes
    if one of its beginnings is in clearly more documents, else these beginnings go.
    """
    beginnings = {k: n for k, n in telling.items() if k[-1] != " "}
    for k in sorted(beginnings, key=lambda k: (len(k), k), reverse=True):
        shorter = k[:-1]
        if k in beginnings and shorter in beginnings:
            beginnings.pop(k if beginnings[shorter] > 1.1 * beginnings[k] else shorter)
    words = {}
    for k, n in telling.items():
        if k[-1] == " ":
            heads = [k[:m] for m in BEGINNINGS if k[:m] in beginnings and len(k) - 1 > m]
            if not any(beginnings[h] > 1.5 * n for h in heads):
                words[k[:-1]] = heads
    needless = {h for heads in words.values() for h in heads}
    return frozenset(words), frozenset(beginnings) - needless


def explaining(toxic: DataFrame, terms: frozenset[str], beginnings: frozenset[str], telling) -> tuple[frozenset[str], frozenset[str]]:
    """The terms and beginnings that explain the toxic documents, taken greedily.

    Copies of a toxic document make all its words telling. So each document wants two hits explained: what adds
    to most documents is taken first, and what adds to too few documents to be telling by itself is not taken.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                found: Counter = Counter()
                for w in WORDS.findall((text or "").lower()):
                    found.update([f"{w} "] if w in terms else [])
                    found.update(w[:n] for n in BEGINNINGS if len(w) > n and w[:n] in beginnings)
                out.append([k for k, n in found.items() for _ in range(min(n, 2))])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["keys"])

    # At most FIT_ROWS documents, and of these only the telling words.
    docs = [Counter(r["keys"]) for r in toxic.select("text").mapInArrow(listed, "keys array<string>").collect()]
    wanted, holders = [2] * len(docs), {}
    for k, found in enumerate(docs):
        for key in found:
            holders.setdefault(key, []).append(k)
    taken: set[str] = set()
    open_ = dict.fromkeys(sorted(holders))
    while open_:
        gain = {key: sum(wanted[k] > 0 for k in holders[key]) for key in open_}
        best = max(gain, key=gain.get)
        if not gain[best] or not telling(best, gain[best]):
            break
        taken.add(best)
        for k in holders[best]:
            wanted[k] -= docs[k][best]
        open_ = {key: None for key in open_ if key != best and telling(key, gain[key])} if gain[best] else {}
    return frozenset(k[:-1] for k in taken if k[-1] == " "), frozenset(k for k in taken if k[-1] != " ")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and label_id is not null")
    known = known.where(~folded(F.col("label_id"))).distinct()
    labelled = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("label_id")
    some = [known.where(F.col("toxic") == t).orderBy(order, "label_id").limit(fit_rows) for t in (0, 1)]
    # Only the two columns: others may be named like the labels'. At most 2 * fit_rows ids: they are broadcast.
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = own.join(F.broadcast(some[0].unionAll(some[1])), own["doc_id"] == F.col("label_id")).select("text", "toxic")
    train = stored(rows, "toxicity-train").select("text", "toxic")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(Trie(frozenset(), frozenset()), 0.0, ())
    # Labelled rows that a row of the sample stands for.
    weight = [max(1.0, labelled[t] / fit_rows) for t in (0, 1)]
    # The test against chance is about the rows drawn, so it takes the share among them; how much more of a class was drawn does not
    # make a term look toxic there, since it moves the term's share and the base alike.
    base = sizes[1] / (sizes[0] + sizes[1])
    least = max(2, math.ceil(math.log(10) / -math.log(base)))
    bad = _counted(train.where("toxic = 1"), lambda t, _: features(t)).select("key", "bad")
    seen = bad.where(F.col("bad") >= least).orderBy(F.desc("bad"), "key").limit(5 * LEXICON).collect()
    candidates = {r["key"]: r["bad"] for r in seen}
    known_keys = frozenset(candidates)
    good = {r["key"]: r["good"] for r in _counted(train.where("toxic = 0"), lambda t, _: features(t) & known_keys).collect()}
    # Tested against the number of candidates, so that about one in ten runs keeps a word by chance.
    needed = 2 * math.log(10 * max(1, len(candidates)))
    scored = sorted(((_surprise(n, good.get(k, 0), base), k) for k, n in candidates.items()), key=lambda x: (-x[0], x[1]))
    telling = {k: candidates[k] for s, k in scored if s >= needed and candidates[k] * weight[1] >= 4 * good.get(k, 0) * weight[0]}
    terms, beginnings = most_general(dict(list(telling.items())[:LEXICON]))
    terms, beginnings = explaining(train.where("toxic = 1"), terms, beginnings, lambda key, bad: _surprise(bad, good.get(key, 0), base) >= needed)
    near = Memory(Trie(terms, beginnings))
    met = _counted(train.where("toxic = 0"), lambda t, _: {w for w in set(WORDS.findall(t.lower())) if near[w] == 2})
    # Words one edit from a term that harmless documents use. There are few: so many edits have the terms.
    trie = Trie(terms, beginnings, frozenset(r["key"] for r in met.select("key").collect()))

    # Weighed without the harmless words just learned from these very rows: they would make misspellings look surer than they are.
    shapes = _counted(train, lambda t, _: [",".join(map(str, bucket(hits(t, near))))]).collect()
    odds = []
    for kind in range(3):
        counts: dict[int, list[float]] = {}
        for r in shapes:
            pair = counts.setdefault(int(r["key"].split(",")[kind]), [0.5, 0.5])
            pair[0] += r["good"]
            pair[1] += r["bad"]
        odds.append({b: math.log(p[1] / (sizes[1] + 0.5)) - math.log(p[0] / (sizes[0] + 0.5)) for b, p in counts.items()})
        for b in range(1, 4):  # a bucket that never came up is as telling as the one below
            odds[kind].setdefault(b, odds[kind].get(b - 1, 0.0) if b > 1 else 0.0)
    return Model(trie, math.log(sizes[1] * weight[1] / (sizes[0] * weight[0])), tuple(odds))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns of ``docs``, and the score. No shuffle."""
    place = docs.columns.index(text)
    places, columns = [k for k, c in enumerate(docs.columns) if c != out], [c for c in docs.columns if c != out]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(model.trie)
        for batch in rows:
            scores = [model.score(hits(t.as_py() or "", memory)) for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in places], pa.array(scores, pa.float64())], [*columns, out])

    schema = docs.select(columns).schema.add(out, "double")
    return docs.mapInArrow(batches, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    own = docs.select("doc_id", "text")
    scored = score(own, fit(own, labels)).drop("text")
    return scored.select("doc_id", F.coalesce(folded(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not found toxic, with all their columns."""
    scored = score(docs, fit(docs, labels), out="__toxicity")
    return scored.where(F.col("__toxicity") < CUTOFF).drop("__toxicity")
