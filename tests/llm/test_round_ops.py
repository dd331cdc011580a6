"""Vector codes, ranked search and source mixing against brute force, with the edge cases their docstrings define."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import rows
from tests.llm.test_native import SF
from tidemark.llm import codes, mixing, queries, search

# -- vector codes ---------------------------------------------------------------------------------


def brute_codes(table, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) and the codebooks' hash, by whole numbers of any size."""
    kept = [r for r in table if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    whole = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    width = len(whole[0]) if whole else 0
    fits = [bool(width) and width % parts == 0 and len(v) == width and all(-(1 << 26) < x < 1 << 26 for x in v) for v in whole]
    step = width // parts if width else 0
    cut = [[tuple(v[p * step : (p + 1) * step]) for p in range(parts)] if ok else None for v, ok in zip(whole, fits)]
    some = [c for c in cut if c]
    books = [[c[p] for c in some[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for c in some:
                mine[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [tuple(sum(x) // len(mine[k]) for x in zip(*mine[k])) if k in mine else e for k, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] if c else None for c in cut]
    errors = [sum(d for d, _ in f) if f else None for f in found]
    by_label = defaultdict(list)
    for r, e in zip(kept, errors):
        by_label[r[2]] += [e] if e is not None else []
    sums = {k: sum(v) if v else None for k, v in by_label.items()}
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f) if f else None, e, sums.get(r[2]), sha) for r, f, e in zip(kept, found, errors)), key=repr)


def vectors(spark, table):
    return spark.createDataFrame(table, "vec_id bigint, embedding array<float>, label int")


def test_codes_of_the_table(spark):
    table = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(120).collect()]
    assert rows(codes.compress(vectors(spark, table))) == brute_codes(table)


def test_codes_edges(spark):
    rng = np.random.default_rng(5)
    table = [(k, [float(x) for x in np.round(rng.normal(size=16), 1).astype(np.float32)], k % 3 or None) for k in range(60)]
    table += [(7, table[7][1], 1), (None, table[3][1], 1), (61, None, 1), (62, [1.0, None] * 8, 1), (63, [float("nan")] * 16, 1), (64, [float("inf")] * 16, 1)]
    table += [(65, [1.0] * 8, 2), (66, [], 2), (67, [2e4] * 16, None), (68, [-0.0] * 16, None)] + [(70 + k, [0.5] * 16, 2) for k in range(20)]
    df = vectors(spark, table).selectExpr("*", "vec_id as code", "label as error", "1 as found", "2 as of", "3 as __v")
    found = rows(codes.compress(df))
    assert found == brute_codes(table) and len(found) == len(table) - 4
    assert codes.compress(vectors(spark, [])).count() == 0
    few = table[:5]
    assert rows(codes.compress(vectors(spark, few))) == brute_codes(few)
    for odd in ([(1, [1.0] * 12, 1)], [(1, [], 1), (2, [1.0] * 16, 1)], [(1, [3e4] * 16, 1)]):
        assert [(r[1], r[2]) for r in rows(codes.compress(vectors(spark, odd)))] == [(None, None)] * len(odd)


def test_light_labels_are_joined_by_key(spark, monkeypatch):
    table = [(k, [float(k % 7)] * 16, k % 40 if k % 2 else 99) for k in range(80)]
    monkeypatch.setattr(codes, "HEAVY", 4)  # only label 99 holds more than a quarter
    assert rows(codes.compress(vectors(spark, table))) == brute_codes(table)


@pytest.mark.parametrize("seed", range(3))
def test_orchard_is_exact(seed):
    rng = np.random.default_rng(seed)
    entries, queries_ = rng.integers(-6, 6, (16, 3)), rng.integers(-8, 8, (5000, 3))
    d = ((queries_[:, None] - entries[None]) ** 2).sum(axis=2)
    best, nearest = codes.Orchard(entries).nearest(queries_)
    assert (best == d.argmin(axis=1)).all() and (nearest == d.min(axis=1)).all()


# -- ranked search --------------------------------------------------------------------------------


def brute_search(docs, items, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", (t or "").translate(lower))
    counts = [(d, Counter(words(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, n_words = len(counts), sum(n for _, _, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c, n in counts:
            m = 50 + 50 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in set(words(text)) if c[w])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def test_search_edges(spark):
    docs = [(k, f"the cat {'sat ' * (k % 5)} on Mat{k % 7} été{k % 3}") for k in range(300)]
    docs += [(5, docs[5][1]), (None, "the dog"), (None, "the dog"), (400, None), (401, ""), (402, " .. "), (403, "Dog the CAT"), (404, "the " * 200_000 + "unicorn")]
    items = [(1, "The cat, the MAT3 sat"), (2, "unicorn dog"), (2, "unicorn dog"), (3, None), (3, ""), (4, "nothing known"), (5, "été1 the"), (5, "cat"), (None, "dog"), (6, "the")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "text as item_id", "1 as score", "2 as rank", "3 as item")
    q = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "item_id as doc_id")
    expected = brute_search(docs, items)
    assert rows(search.search(d, q)) == expected
    assert rows(search.search(d.repartition(7), q, shard=20)) == expected
    assert rows(search.search(d, q, block=8)) == expected
    assert rows(search.search(d.repartition(3), q, top=3, shard=16)) == brute_search(docs, items, 3)
    assert search.search(d.limit(0), q).count() == 0 and search.search(d, q.limit(0)).count() == 0 and search.search(d.where("doc_id = 402"), q).count() == 0


def test_pair_bounds_skip_more_than_single_ones():
    """Two terms that never meet: their pair is bounded by one of them, and the query's other documents are never scored."""
    terms = {0: ([0, 1], [5, 6]), 1: ([2, 3], [6, 5]), 2: ([4, 5], [9, 10])}
    lists = [(k, max(i), np.array(p, np.int32).tobytes(), np.array(i, np.int64).tobytes()) for k, (p, i) in terms.items()]
    shard = search.Shard([*lists, (-1, 0, np.arange(6).tobytes(), b"")], 3)
    assert shard._bound((0, 1, 0)) == 6
    added = []
    shard._look_up = lambda unit, wanted, score: added.append((unit, wanted.tolist()))
    places, scores = shard.best([(0, 1, 0)], [2], 9, 2)
    assert places.tolist() == [5, 4] and scores.tolist() == [10, 9] and added == [((0, 1, 0), [4, 5])]


# -- source mixing --------------------------------------------------------------------------------


def brute_targets(docs):
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target = Fraction(sum(size.values())), {}
    while left:
        free = [s for s in order if s not in target]
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 3 * size[s]]
        if not above:
            target.update({s: left * weight[s] / total for s in free})
            break
        for s in above:
            target[s] = Fraction(3 * size[s])
        left = sum(size.values()) - sum(target.values())
    return size, {s: target.get(s, Fraction(0)) for s in order}


def check_mix(found, docs, block):
    size, target = brute_targets(docs)
    assert Counter((d, len(re.findall("[^\x20\x09-\x0d]+", t or "")), size[s]) for d, t, s in docs) == Counter((d, n, m) for d, n, m, _, _ in found)
    own = {d: s for d, _, s in docs}
    taken = defaultdict(int)
    for d, n, _, t, k in found:
        assert 0 <= k <= 3 * n
        assert t == pytest.approx(float(target[own[d]]), rel=1e-12)
        taken[own[d]] += k
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1.5 * block, (s, taken[s], float(t))


def test_mix_of_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    run = queries.QUERIES["op13_source_mix"]
    found = rows(run(spark, SF))
    check_mix(found, docs, mixing.BLOCK)
    table = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(5)
    assert rows(mixing.Mix(table).report()) == found  # not on files or partitions


def test_mix_edges(spark):
    docs = [(k, "w " * (k % 40), ["b", "a", None, "", "é"][k % 5]) for k in range(300)]
    docs += [(1, "w", "a"), (1, "w", "a"), (900, "x " * 30_000, "long"), (901, "y z", "small"), (902, None, "none"), (903, " \n", "none")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").selectExpr("*", "1 as size", "2 as rank", "3 as bucket", "4 as of", "5 as taken")
    own = {1: "a"} | {d: s for d, _, s in docs}
    check_mix(rows(mixing.Mix(df, block=8, shard=64).report()), [(d, t, own[d]) for d, t, _ in docs], 8)
    # Sources in groups: other draws, the same totals.
    check_mix(rows(mixing.Mix(df, block=8, shard=64, group=2).report()), [(d, t, own[d]) for d, t, _ in docs], 8)
    assert mixing.Mix(df.limit(0)).report().count() == 0
    assert rows(mixing.Mix(df.where("doc_id >= 902")).report()) == [(902, 0, 0, 0.0, 0), (903, 0, 0, 0.0, 0)]
    nulls = spark.createDataFrame([(None, "a b c", None), (None, "a b c", None), (None, None, None)], "doc_id bigint, text string, source string")
    assert sum(r[4] for r in rows(mixing.Mix(nulls).report())) == 6


def test_mix_texts(spark):
    docs = [(k, " ".join(f"{s}{k}_{i}" for i in range(20 + k % 50)), s) for k in range(200) for s in ("a", "b", "c")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    mix = mixing.Mix(df, block=16, shard=32, keep_text=True)
    found = mix.texts().collect()
    size, target = brute_targets(docs)
    words = Counter(w for r in found for w in r["text"].split(" "))
    assert set(words.values()) <= {1, 2, 3} and len({(r["shard"], r["slot"]) for r in found}) == len(found)
    held = Counter(r["shard"] for r in found)
    last = max(held)
    assert all(n == 32 for s, n in held.items() if s != last) and sorted(r["slot"] for r in found if r["shard"] == 0) == list(range(32))
    assert sum(len(r["text"].split(" ")) != 16 for r in found) <= 9  # a source's last block, three times at most
    # Draws differ from shard to shard about as a multinomial does.
    share = float(target["a"]) / sum(map(float, target.values()))
    counts = [sum(r["source"] == "a" for r in found if r["shard"] == s) for s in held if s != last]
    assert 0.3 < np.var(counts) / (32 * share * (1 - share)) < 2.5
    per_doc = Counter()
    for w, n in words.items():
        per_doc[int(w[1:].split("_")[0]), w[0]] += n
    report = {}
    for r in mix.report().collect():
        report.setdefault(r["doc_id"], []).append(r["taken"])
    assert {d: sorted(v) for d, v in report.items()} == {d: sorted(per_doc[d, s] for s in "abc") for d in range(200)}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000])
def test_permutation(size):
    out = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, 77))
    assert sorted(out.tolist()) == list(range(size))


def test_a_round_of_codes_is_one_job_at_any_number_of_partitions(spark):
    """The sums of a round come back in one job, not in one for each shuffle partition."""
    table = [(k, [float((k * p) % 7 - 3) / 8 for p in range(1, 17)], k % 3) for k in range(40)]
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    spark.sparkContext.setJobGroup("codes-round", "codes-round")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        frame = vectors(spark, table)
        books = codes.start(frame, entries=4)
        started = len(spark.sparkContext.statusTracker().getJobIdsForGroup("codes-round"))
        codes.round_of(frame, books)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("codes-round")) - started == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
