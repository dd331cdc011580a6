"""Fuzzy line dedup: SimHash of normalised lines, joins on blocks, edit similarity, one occurrence per group.

A line is normalised to its lower-cased words (letters, digits). Lines of at least ``LEAST`` words take
part, and lines with at least ``UNSPACED`` letters of scripts that set no spaces between words (Chinese, Japanese,
Thai, Lao, Tibetan, Burmese, Khmer). Features are pairs of neighbouring words, in scripts without spaces pairs of letters.

Two different lines are candidates if they share a block. Some blocks are parts of the 64-bit SimHash: with ``m`` parts, hashes
that differ in ``BITS`` bits agree in ``m - BITS`` of them, and every choice of such parts is a key. A changed word turns
more bits than that, so ``MIN_BLOCKS`` further keys are made of two minimum hashes of the features each. Candidates whose SimHashes differ in
at most ``WIDE`` bits and whose lengths allow it are verified: they are linked if their normalised texts have an edit
similarity of at least ``SIMILAR``.

In each key's region all lines are first compared with one pivot line. Lines in the pivot's component need no
comparing among each other; the other lines of the region are compared with all that can be close to them and
are not in their component. Of each connected group, the occurrence that is smallest by (doc_id, text hash, line number) stays.

Defined results: a null text stays null; empty lines and lines that do not take part stay, exact repeats of them too; rows that agree in id and
text are one document, and each keeps the same lines; null ids come last; lines of any length are worked on whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.components import components
from tidemark.llm.store import stored
from tidemark.llm.tokens import KINDS, Words, mix, pieces

LEAST = 5
UNSPACED = 20
#: SimHash bits that the pigeonhole keys allow for, and bits beyond which a candidate is not verified.
BITS, WIDE = 1, 26
MIN_BLOCKS = 6
SIMILAR = 0.8
#: Rows of ids that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Lines, and letters of them, that a place of a region holds while the others pass by.
OUTERS, OUTER_LETTERS = 1_000, 20_000_000
#: Lines compared with the held ones at once; pairs, and letters of them, that are kept for the edit distance.
BLOCK, KEPT_PAIRS, KEPT_LETTERS = 256, 16_384, 8_000_000
#: Pairs, and letters of them, that the edit distance takes in step; fewer pairs, and lines of more words of 64 letters, go one by one.
LEAST_PAIRS, STEP_PAIRS, STEP_LETTERS, STEP_WORDS = 24, 2_048, 500_000, 32
#: Buckets of letters, of pairs and of triples.
GRAMS = (61, 251, 509)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ORDERS = mix(np.arange(1, 2 * MIN_BLOCKS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
_WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def normalised(line: str) -> str:
    # Of bytes, only the letters A to Z have a lower case.
    return " ".join(_WORD.findall(line.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))


def _line_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte bounds of all lines, and the number of the first line of each text."""
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.sort(np.concatenate([bounds[:-1], breaks]))
    # Every text starts a line, also an empty one; a break at a text's end starts an empty line there.
    first = np.searchsorted(breaks, bounds, "right") + np.arange(len(bounds))
    return np.append(starts, len(data)), first


def _unspaced(data: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """For each line, the number of its letters of scripts that set no spaces between words."""
    at = np.flatnonzero(data >= 0xE0)
    first, second = data[at], data[np.minimum(at + 1, max(0, len(data) - 1))]
    han = (first >= 0xE4) & (first <= 0xE9) | (first == 0xE3) & (second >= 0x81) | (first == 0xEF) & (second >= 0xA4) & (second <= 0xAB) | (first == 0xF0) & (second >= 0xA0)
    other = (first == 0xE0) & (second >= 0xB8) | (first == 0xE1) & ((second <= 0x82) | (second == 0x9E) | (second == 0x9F))
    return np.diff(np.searchsorted(at[han | other], lines))


def _sim(h: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """SimHashes of runs of feature hashes."""
    ones = np.add.reduceat(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1), starts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > size[:, None], axis=1).reshape(-1).view(np.uint64)


def _neighbours(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of each element with the one after it; the last of a run is paired with the run's end."""
    after = np.append(h[1:], np.uint64(0))
    after[starts[1:] - 1] = np.uint64(0)
    return mix(h * _STEP + after)


def _marks(h: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHashes of runs, and their keys of minimum hashes, a row per run."""
    features = _neighbours(h, starts)
    low = [np.minimum.reduceat(features * order, starts) for order in _ORDERS]
    blocks = [mix(low[2 * k] * _STEP + mix(low[2 * k + 1] + np.uint64(k))) for k in range(MIN_BLOCKS)]
    return _sim(features, starts, size), np.stack(blocks, axis=1)


def _marks_of_letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The marks of normalised lines by their letters."""
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts])
    return _marks(letters, np.concatenate([[0], np.cumsum(size)[:-1]]), size)


class Lines:
    """Lines of some texts that take part: ``doc`` (text index), ``line`` (number), ``hash``, bytes ``begin`` to ``end`` of ``data``.

    With ``marked`` also ``sim``, ``blocks`` (keys of minimum hashes) and ``letters`` (of the normalised line, spaces included).
    """

    def __init__(self, at: int, data: np.ndarray, bounds: np.ndarray, least: int, marked: bool):
        lines, first_line = _line_bounds(data, bounds)
        words = Words(data, lines, "alnum")
        count = np.diff(words.first)
        unspaced = _unspaced(data, lines) >= UNSPACED
        long = np.flatnonzero((count >= max(1, least)) | unspaced)
        doc = np.searchsorted(first_line, long, "right") - 1
        self.doc, self.line, self.data = at + doc, long - first_line[doc], data
        self.begin, self.end = lines[long], lines[long + 1]
        if not len(long):
            return
        begin, size = words.first[:-1][long], count[long]
        # Words of the lines that take part, one line after the other.
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        h = words.hash[np.repeat(begin - starts, size) + np.arange(size.sum())]
        place = np.arange(len(h)) - np.repeat(starts, size)
        powers = np.full(int(size.max()) + 1, _STEP, np.uint64)
        powers[0] = np.uint64(1)
        powers = np.multiply.accumulate(powers)
        self.hash = mix(np.add.reduceat(h * powers[place], starts) + size.astype(np.uint64)).view(np.int64)
        if not marked:
            return
        sim, blocks = _marks(h, starts, size)
        if (by_letters := np.flatnonzero(unspaced[long])).size:
            sim[by_letters], blocks[by_letters] = _marks_of_letters([normalised(self.text(k)) for k in by_letters])
        self.sim, self.blocks = sim.view(np.int64), blocks.view(np.int64)
        # A code point is counted at its first byte.
        counted = np.concatenate([[0], np.cumsum(KINDS["alnum"][data] & ((data & 0xC0) != 0x80))])
        self.letters = counted[self.end] - counted[self.begin] + size - 1

    def __len__(self) -> int:
        return len(self.line)

    def text(self, k: int) -> str:
        return self.data[self.begin[k] : self.end[k]].tobytes().decode()


def hashed_lines(texts: pa.Array, least: int, marked: bool = True) -> Iterator[Lines]:
    """The lines with ``least`` words or ``UNSPACED`` letters, of some texts each."""
    for at, data, bounds in pieces(texts):
        found = Lines(at, data, bounds, least, marked)
        if len(found):
            yield found


def blocks_for(lines: int) -> int:
    """Blocks for so many lines: keys of at least log2(lines) bits."""
    m = BITS + 1
    while m < 8 and 64 * (m - BITS) // m < max(1, lines).bit_length():
        m += 1
    return m


def keys(sim: Column, blocks: int) -> Column:
    """The pigeonhole keys of a SimHash."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - BITS)):
        mask = sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen)
        parts.append(F.xxhash64(F.lit(number), sim.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("bigint"))))
    return F.array(*parts)


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _rests(a: str, b: str) -> tuple[str, str]:
    """Both texts reversed without their common beginning and end, the shorter first."""
    n = _shared(a, b)
    a, b = a[n:][::-1], b[n:][::-1]
    n = _shared(a, b)
    a, b = a[n:], b[n:]
    return (b, a) if len(a) > len(b) else (a, b)


def _signs(bits: int, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little")[:size].astype(np.int64)


def edit_distance(a: str, b: str, limit: int | None = None) -> int:
    """Levenshtein distance, bit-parallel over the shorter text; some number above ``limit`` where the distance is above it."""
    a, b = _rests(a, b)
    if not a:
        return len(b)
    match: dict[str, int] = {}
    for k, c in enumerate(a):
        match[c] = match.get(c, 0) | 1 << k
    ones, top, up, down, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), (1 << len(a)) - 1, 0, len(a)
    every = max(32, len(b) // 12) if limit is not None else len(b) + 1
    left = len(a) - np.arange(1, len(a) + 1) if len(b) >= every else None
    for done, c in enumerate(b, 1):
        eq = match.get(c, 0)
        x = eq | down
        eq |= ((eq & up) + up) ^ up
        plus, minus = down | (ones & ~(eq | up)), up & eq
        distance += 1 if plus & top else -1 if minus & top else 0
        plus, minus = (plus << 1 | 1) & ones, minus << 1 & ones
        up, down = minus | (ones & ~(x | plus)), plus & x
        if done % every == 0:
            # Every way to the end passes this column, and needs as many further edits as the rests differ in length.
            column = done + np.cumsum(_signs(up, len(a)) - _signs(down, len(a)))
            least = min(done + abs(len(a) - len(b) + done), int((column + np.abs(left - (len(b) - done))).min()))
            if least > limit:
                return least
    return distance


def similar(a: str, b: str, least: float = SIMILAR) -> bool:
    longest = max(len(a), len(b))
    if min(len(a), len(b)) < least * longest:
        return False
    return longest - edit_distance(a, b, int((1 - least) * longest) + 1) >= least * longest


def edit_distances(a: list[str], b: list[str], limits: list[int]) -> np.ndarray:
    """:func:`edit_distance` of many pairs with a limit each, in step: a row per 64 letters of the first texts, a column per pair.

    No first text is empty or longer than its second; all have the same number of rows. Only rows that a way of ``limit`` edits can
    reach take part; beyond them the distance counts as growing by one a letter, which is never too low.
    """
    order = sorted(range(len(a)), key=lambda k: len(b[k]))
    m, n, limit = (np.array([x[k] for k in order], np.int64) for x in (list(map(len, a)), list(map(len, b)), limits))
    size, words = len(order), -(-int(m.max()) // 64)

    def letters(texts: list[str], length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters with their pairs, the pairs, and the places in the texts."""
        pair = np.repeat(np.arange(size), length)
        codes = np.frombuffer("".join(texts[k] for k in order).encode("utf-32-le", "surrogatepass"), np.uint32)
        return pair << 32 | codes, pair, np.arange(len(pair)) - np.repeat(np.cumsum(length) - length, length)

    known, _, place = letters(a, m)
    known, row = np.unique(known, return_inverse=True)
    match = np.zeros((words, len(known) + 1), np.uint64)
    np.add.at(match, (place // 64, row), np.uint64(1) << (place % 64).astype(np.uint64))
    own, pair, place = letters(b, n)
    row = np.minimum(np.searchsorted(known, own), len(known) - 1)
    text = np.full((int(n.max()), size), len(known), np.int32)
    text[place, pair] = np.where(known[row] == own, row, len(known))

    one, high, full = np.uint64(1), np.uint64(63), ~np.uint64(0)
    out, alive = np.empty(size, np.int64), np.arange(size)
    up, down = np.full((words, size), full), np.zeros((words, size), np.uint64)
    above, first = np.zeros(size, np.int64), 0  # the distance at the letter before the first row that takes part
    column, start, shortest = 0, 0, int(n[0])
    back, ahead = int((limit + n - m).max()) // 2 + 1, int((limit - n + m).max()) // 2 + 1
    while len(alive):
        low, last = min(max(0, (column - back) // 64), words - 1), min(words, (column + ahead) // 64 + 1)
        if low > first:
            above = above + (np.bitwise_count(up[first:low]).astype(np.int64) - np.bitwise_count(down[first:low])).sum(axis=0)
            first = low
        ups, downs = up[first:last], down[first:last]
        x = match[first:last].take(text[column - start], axis=1)
        total = x & ups
        total += ups
        carry = (total < ups)[:-1]
        while carry.any():
            total[1:] += carry
            carry &= total[1:] == 0
            carry = np.concatenate([np.zeros_like(carry[:1]), carry[:-1]])
        total ^= ups
        total |= x
        x |= downs
        plus = total | ups
        np.invert(plus, out=plus)
        plus |= downs
        minus = np.bitwise_and(total, ups, out=total)
        np.left_shift(plus, one, out=ups)
        ups[0] |= one
        ups[1:] |= plus[:-1] >> high
        np.bitwise_and(ups, x, out=downs)
        ups |= x
        np.invert(ups, out=ups)
        ups |= minus << one
        ups[1:] |= minus[:-1] >> high
        above += 1
        column += 1
        if column == shortest:
            done = int(np.searchsorted(n, column, "right"))
            inside = np.clip(m[:done] - 64 * np.arange(first, last)[:, None], 0, 64).astype(np.uint64)
            inside = np.where(inside == 64, full, (one << (inside & high)) - one)
            step = np.bitwise_count(ups[:, :done] & inside).astype(np.int64) - np.bitwise_count(downs[:, :done] & inside)
            out[alive[:done]] = above[:done] + step.sum(axis=0)
            alive, above, m, n, limit = (v[done:] for v in (alive, above, m, n, limit))
            up, down, text = up[:, done:], down[:, done:], text[:, done:]
            shortest = n[0] if len(n) else 0
        if column % 32 == 0 and len(alive):
            # Every way passes this column, and needs as many further edits as the rests differ in length. Their sum is known at every
            # eighth letter; it changes by at most 2 a letter, so between two of these it is at most 8 below their mean.
            step = np.bitwise_count(up[first:last].T.copy().view(np.uint8)).astype(np.int64) - np.bitwise_count(down[first:last].T.copy().view(np.uint8))
            at = 8 * np.arange(8 * first, 8 * last + 1)[:, None]
            least = np.concatenate([above[None], above + np.cumsum(step.T, axis=0)]) + np.abs((m - at) - (n - column))
            least = np.where(at[1:] > m, least[:-1] - 16, (least[:-1] + least[1:]) // 2 - 8)
            least = np.where(at[:-1] > m, np.iinfo(np.int64).max, least).min(axis=0)
            far = least > limit
            if 4 * far.sum() >= len(far):
                out[alive[far]] = least[far]
                alive, above, m, n, limit = (v[~far] for v in (alive, above, m, n, limit))
                up, down, text, start = up[:, ~far], down[:, ~far], text[column - start :, ~far], column
                shortest = n[0] if len(n) else 0
    return out[np.argsort(order)]


def similar_pairs(pairs: list[tuple[str, str]], least: float = SIMILAR) -> np.ndarray:
    """:func:`similar` of each pair."""
    out, rests = np.zeros(len(pairs), bool), []
    for k, (x, y) in enumerate(pairs):
        longest = max(len(x), len(y))
        if min(len(x), len(y)) >= least * longest:
            a, b = _rests(x, y)
            rests.append((-(-len(a) // 64), len(b), k, a, b, int((1 - least) * longest) + 1, longest))
    rests.sort(key=lambda rest: rest[:3])
    first = 0
    while first < len(rests):
        words, last = rests[first][0], first + 1
        while last < len(rests) and rests[last][0] == words and last - first < STEP_PAIRS and (last - first) * rests[last][1] < STEP_LETTERS:
            last += 1
        _, _, number, a, b, limits, longest = zip(*rests[first:last], strict=True)
        if 0 < words <= STEP_WORDS and last - first >= LEAST_PAIRS:
            distance = edit_distances(a, b, limits)
        else:
            distance = np.array([edit_distance(*rest) for rest in zip(a, b, limits, strict=True)])
        longest = np.array(longest)
        out[list(number)] = longest - distance >= least * longest
        first = last
    return out


def _held(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def occurrences(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """A row per line that takes part: doc_id, text_hash, line, hash, sim, letters, blocks. ``docs``: doc_id, text_hash, text."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in hashed_lines(batch.column(2), least):
                own = pa.array(found.doc)
                blocks = pa.ListArray.from_arrays(np.arange(0, found.blocks.size + 1, MIN_BLOCKS, dtype=np.int32), pa.array(found.blocks.reshape(-1)))
                columns = [pa.array(found.line, pa.int64()), pa.array(found.hash), pa.array(found.sim), pa.array(found.letters, pa.int64()), blocks]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own), batch.column(1).take(own), *columns], ["doc_id", "text_hash", "line", "hash", "sim", "letters", "blocks"]
                )

    schema = docs.select("doc_id", "text_hash").schema.add("line", "long").add("hash", "long").add("sim", "long").add("letters", "long")
    return docs.select("doc_id", "text_hash", "text").mapInArrow(listed, schema.add("blocks", ArrayType(LongType())))


def _texts(docs: DataFrame, wanted: DataFrame, lines: DataFrame, least: int) -> DataFrame:
    """hash, text of the ``wanted`` hashes, read from the documents of their first occurrences."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in hashed_lines(batch.column(0), least, marked=False):
                different, at = np.unique(found.hash, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(different), pa.array([found.text(k) for k in at], pa.string())], ["hash", "text"])

    places = lines.join(_held(wanted), "hash", "left_semi").select(F.col("first.doc_id").alias("at_id"), F.col("first.text_hash").alias("at_hash")).distinct()
    places = stored(places, "line-places")
    holders = docs.join(_held(places), docs["text_hash"].eqNullSafe(F.col("at_hash")) & docs["doc_id"].eqNullSafe(F.col("at_id")), "left_semi")
    found = holders.select("text").mapInArrow(listed, "hash long, text string").join(_held(wanted), "hash", "left_semi")
    return stored(found.groupBy("hash").agg(F.min("text").alias("text")), "line-texts")


def _linked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = similar_pairs([(normalised(x.as_py()), normalised(y.as_py())) for x, y in zip(batch.column(2), batch.column(3), strict=True)], similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left, right = texts.select(F.col("hash").alias("a"), F.col("text").alias("x")), texts.select(F.col("hash").alias("b"), F.col("text").alias("y"))
    return stored(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "line-links")


def links(docs: DataFrame, lines: DataFrame, least: int = LEAST, similarity: float = SIMILAR) -> DataFrame:
    """Pairs (a, b) of line hashes that hold the groups together. ``lines``: hash, sim, letters, blocks, first; one row per hash.

    First each line is compared with its nearest pivot, then with other pivots that are not in its component
    yet. What is left in a region outside its pivot's component is compared with all its lines of other components.
    """

    def close(x: str, y: str) -> Column:
        """Whether two lines (structs of sim, letters) have to be verified."""
        shorter, longer = F.least(f"{x}.letters", f"{y}.letters"), F.greatest(f"{x}.letters", f"{y}.letters")
        return (apart(x, y) <= WIDE) & (shorter >= longer * F.lit(similarity))

    def apart(x: str, y: str) -> Column:
        return F.bit_count(F.col(f"{x}.sim").bitwiseXOR(F.col(f"{y}.sim")))

    def rooted(df: DataFrame, groups: DataFrame, *names: str) -> DataFrame:
        for name in names:
            to = groups.select(F.col("id").alias(name), F.col("root").alias(f"root_{name}"))
            df = df.join(_held(to), name, "left").withColumn(f"root_{name}", F.coalesce(f"root_{name}", name))
        return df

    blocks = F.concat("blocks", keys(F.col("sim"), blocks_for(lines.count())))
    entries = lines.select(F.explode(blocks).alias("key"), "hash")
    # Most keys have one line: only keys and counts travel to find the others.
    several = stored(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "line-keys")
    shared = stored(entries.join(_held(several), "key"), "line-entries")
    wanted = stored(shared.select("hash").distinct(), "line-ends")
    marks = stored(lines.join(_held(wanted), "hash", "left_semi").select("hash", F.struct("sim", "letters").alias("mark")), "line-marks")
    texts = _texts(docs, wanted, lines, least)
    # The order of the lines differs from key to key, so that a group of like lines has pivots all over.
    pivots = shared.groupBy("key").agg(F.min(F.col("hash").bitwiseXOR(F.col("key"))).alias("low")).select("key", F.col("low").bitwiseXOR(F.col("key")).alias("pivot"))
    pivots = stored(pivots.join(_held(marks.select(F.col("hash").alias("pivot"), F.col("mark").alias("pivot_mark"))), "pivot"), "line-pivots")
    regions = stored(shared.join(_held(marks), "hash").join(_held(pivots), "key"), "line-regions")
    near = regions.where((F.col("hash") != F.col("pivot")) & close("mark", "pivot_mark"))
    spokes = stored(near.groupBy(F.col("pivot").alias("a"), F.col("hash").alias("b")).agg(F.min(apart("mark", "pivot_mark")).alias("d")), "line-spokes")
    nearest = spokes.groupBy("b").agg(F.min(F.struct("d", "a")).alias("to")).select(F.col("to.a").alias("a"), "b")
    first = _linked(stored(nearest, "line-pairs"), texts, similarity)
    other = rooted(spokes.select("a", "b"), components(first), "a", "b").where("root_a <> root_b").select("a", "b")
    second = first.unionByName(_linked(stored(other.join(nearest, ["a", "b"], "left_anti"), "line-pairs"), texts, similarity))
    # A region of two is settled by its pivot.
    members = rooted(regions.where("n > 2").select("key", "pivot", "hash", "mark"), components(second), "hash", "pivot")
    members = members.where("hash <> pivot").select("key", "hash", "mark.*", F.col("root_hash").alias("root"), (F.col("root_hash") != F.col("root_pivot")).alias("outer"))
    outer = members.where("outer").groupBy("key").agg(F.greatest(F.ceil(F.count("*") / OUTERS), F.ceil(F.sum("letters") / OUTER_LETTERS)).alias("places"))
    every = regions.groupBy("hash").agg(F.collect_set("key").alias("keys"))
    third = _linked_within(members.join(_held(stored(outer, "line-outer")), "key"), every, texts, similarity)
    return second.unionByName(stored(third, "line-links"))


def _linked_within(members: DataFrame, every: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of similar lines of different roots in one region, one of them ``outer``.

    ``members``: key, hash, sim, letters, root, outer, places. A line travels once for each of its regions, and no pair travels: a place of a
    region holds some of the outer lines, and the region's other lines pass by. An outer line passes the places after its own. ``every``: hash, keys
    (of all its regions); two lines are compared in the first region only that both are in.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, kept = None, None, 0  # letters of the pairs kept
        ends: list[tuple[int, int]] = []
        pairs: list[tuple[str, str]] = []

        def linked() -> pa.RecordBatch:
            found = np.array(ends, np.int64).reshape(-1, 2)[similar_pairs(pairs, similarity)]
            ends.clear()
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.min(axis=1, initial=2**63 - 1)), pa.array(found.max(axis=1, initial=-(2**63)))], ["a", "b"])

        for batch in batches:
            key, place, passing, *marks = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:7])
            # The keys of a line's regions before this one.
            before = [{x for x in keys if x < at} for keys, at in zip(batch.column(8).to_pylist(), key.tolist(), strict=True)]
            starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (place[1:] != place[:-1])))
            for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
                if at != (key[first], place[first]):
                    at, held = (key[first], place[first]), Held(similarity)
                for start in range(first, last, BLOCK):
                    rows = slice(start, min(start + BLOCK, last))
                    for one, x, other, y in held.could(~passing[rows], *(m[rows] for m in marks), before[rows], batch.column(7)[rows]):
                        ends.append((one, other))
                        pairs.append((x, y))
                        kept += len(x) + len(y)
                        if len(ends) >= KEPT_PAIRS or kept >= KEPT_LETTERS:
                            yield linked()
                            kept = 0
            yield linked()
            kept = 0

    own = F.when(F.col("outer"), F.pmod(F.xxhash64("hash"), "places")).otherwise(F.lit(0))
    dealt = members.withColumn("own", own).withColumn("place", F.explode(F.sequence("own", F.col("places") - 1)))
    passing = (~F.col("outer") | (F.col("place") != F.col("own"))).alias("passing")
    dealt = dealt.select("key", "place", passing, "hash", "sim", "letters", "root").join(texts, "hash").join(every, "hash")
    dealt = dealt.repartition("key", "place").sortWithinPartitions("key", "place", "passing")
    return dealt.select("key", "place", "passing", "hash", "sim", "letters", "root", "text", "keys").mapInArrow(compare, "a long, b long").distinct()


class Held:
    """Lines that others are compared with. Bounds on the edit distance, on all of them at once, come before the distance itself."""

    def __init__(self, similarity: float):
        self.similarity, self.texts, self.before = similarity, [], []
        self.names, self.letters, self.roots, self.sims = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        self.grams: dict[int, np.ndarray] = {}

    def could(self, hold: np.ndarray, name: np.ndarray, sim: np.ndarray, letters: np.ndarray, root: np.ndarray, keys: list[set[int]], text: pa.Array) -> Iterator[tuple[int, str, int, str]]:
        """Names and normalised texts of lines and held lines of another root that no bound keeps from being similar.

        Lines to ``hold`` come first; each of them is compared with those held before it, the others with all. Lines that share one of ``keys``
        have been compared elsewhere.
        """
        sim, before, kept = sim.view(np.uint64), len(self.names), np.flatnonzero(hold)
        if len(kept):
            self.names, self.letters, self.roots, self.sims = (
                np.concatenate([x, y[kept]]) for x, y in zip((self.names, self.letters, self.roots, self.sims), (name, letters, root, sim), strict=True)
            )
            self.texts += [text[k] for k in kept.tolist()]
            self.before += [keys[k] for k in kept.tolist()]
        upto = np.where(hold, before + np.arange(len(hold)), len(self.names))
        close = (np.arange(len(self.names)) < upto[:, None]) & (self.roots != root[:, None]) & (np.bitwise_count(self.sims ^ sim[:, None]) <= WIDE)
        close &= np.minimum(self.letters, letters[:, None]) >= np.maximum(self.letters, letters[:, None]) * self.similarity
        for k in np.flatnonzero(close.any(axis=1)).tolist():
            at = [x for x in np.flatnonzero(close[k]).tolist() if keys[k].isdisjoint(self.before[x])]
            if not at:
                continue
            for other in at:
                self._counted(other)
            if hold[k]:
                self._counted(before + k)
                own, mine = self.texts[before + k], self.grams[before + k]
            else:
                mine = gram_counts(own := normalised(text[k].as_py()))
            for other, least in zip(at, edits_at_least(mine, [self.grams[x] for x in at]).tolist(), strict=True):
                longest = max(len(own), len(self.texts[other]))
                if longest - least >= self.similarity * longest:
                    yield int(name[k]), own, int(self.names[other]), self.texts[other]

    def _counted(self, k: int) -> None:
        if k not in self.grams:
            self.texts[k] = normalised(self.texts[k].as_py())
            self.grams[k] = gram_counts(self.texts[k])


def gram_counts(text: str) -> np.ndarray:
    """Counts of a text's letters, pairs and triples of letters, by hash, one after the other."""
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    y = x[:-1] * 8191 + x[1:]
    z = y[:-1] * 8191 + x[2:]
    counts = [np.bincount(g % size, minlength=size) for g, size in zip((x, y, z), GRAMS, strict=True)]
    return np.concatenate(counts).astype(np.int32)


def edits_at_least(counts: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """No fewer edits than this make one text of the other: an edit takes away at most q of the runs of q letters and adds at most q."""
    out = np.zeros(len(others), np.int64)
    for start in range(0, len(others), 256):
        more = np.stack(others[start : start + 256]) - counts
        for q, (first, last) in enumerate(zip(np.cumsum((0, *GRAMS[:-1])), np.cumsum(GRAMS), strict=True), 1):
            part = more[:, first:last]
            added, gone = np.maximum(part, 0).sum(axis=1), np.maximum(-part, 0).sum(axis=1)
            out[start : start + 256] = np.maximum(out[start : start + 256], -(-np.maximum(added, gone) // q))
    return out


def dropped(docs: DataFrame, least: int = LEAST, similarity: float = SIMILAR) -> DataFrame:
    """doc_id, text_hash, lines: the numbers of the lines that are not the kept occurrence of their group."""
    found = stored(occurrences(docs, least), "line-occurrences")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "line")
    lines = stored(found.groupBy("hash").agg(*(F.first(x).alias(x) for x in ("sim", "letters", "blocks")), F.min(place).alias("first"), F.count("*").alias("n")), "lines")
    groups = components(links(docs, lines, least, similarity))
    rooted = lines.join(groups, lines["hash"] == groups["id"])
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"))
    fuzzy = stored(rooted.select("hash", "root").join(kept, "root").select("hash", "kept"), "line-groups")
    single = lines.where("n > 1").join(fuzzy, "hash", "left_anti").select("hash", F.col("first").alias("kept"))
    repeated = stored(single.unionByName(fuzzy), "repeated-lines")
    out = found.join(repeated, "hash").where(~place.eqNullSafe(F.col("kept")))
    return stored(out.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("lines")), "dropped-lines")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, similarity: float = SIMILAR) -> DataFrame:
    """All rows and columns of ``docs`` with the repeated lines taken out of ``text``, and ``__dropped``, their numbers."""
    own = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    gone = dropped(own, least, similarity).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("lines").alias("__dropped"))
    lines = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("__dropped")), F.lit(0))).first()
    small = lines[0] + lines[1] <= BROADCAST_ROWS
    hashed = docs.withColumn("__text_hash", F.xxhash64(F.col(text)))
    joined = hashed.join(F.broadcast(gone) if small else gone, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    kept = F.array_join(F.filter(F.transform(F.split(F.col(text), "\n", -1), _unless_dropped), lambda x: x.isNotNull()), "\n")
    return joined.withColumn(text, F.when(F.col("__dropped").isNull(), F.col(text)).otherwise(kept)).select(*docs.columns, "__dropped")


def _unless_dropped(line: Column, number: Column) -> Column:
    return F.when(~F.array_contains("__dropped", number.cast("bigint")), line)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, dropped (line numbers), text."""
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint")
    found = dedup(docs.select("doc_id", "text", n_lines.alias("n_lines")))
    return found.select(
        "doc_id", "n_lines", F.coalesce(F.size("__dropped"), F.lit(0)).cast("bigint").alias("n_dropped"), F.coalesce(F.array_join("__dropped", ","), F.lit("")).alias("dropped"), "text"
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their repeated lines. A document that loses all its words is a copy of others and goes.

    A column ``n_chars`` is counted anew.
    """
    found = dedup(docs, doc_id, text)
    emptied = F.col("__dropped").isNotNull() & ~F.regexp_like(F.coalesce(F.col(text), F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))
    kept = found.where(~F.coalesce(emptied, F.lit(False))).drop("__dropped")
    return kept.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept
