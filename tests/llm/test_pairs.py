"""Jaccard join, line dedup, embedding near-dedup and components against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tests.conftest import rows
from tests.llm.test_native import AZ, SF
from tidemark.llm import components, embeddings, jaccard, lines, queries, tokens


class Groups:
    def __init__(self, n):
        self.parent = list(range(n))

    def root(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a, b):
        self.parent[self.root(a)] = self.root(b)


def brute_join(docs, size=4, near=(85, 100)):
    import re

    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    holders, groups = defaultdict(list), Groups(len(docs))
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x]).items():
            if near[1] * n >= near[0] * (len(s) + len(sets[j]) - n):
                groups.link(j, k)
        for x in s:
            holders[x].append(k)
    best = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            best[groups.root(k)] = min(best.get(groups.root(k), doc), doc)
    return sorted([(doc, len(sets[k]), best.get(groups.root(k)) if sets[k] else doc) for k, (doc, _) in enumerate(docs)], key=repr), sets, groups


def near_copies(seed=3, groups=6, copies=25, words=60):
    """Groups of edited copies, chains of edits, a shared passage, odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)] + (passage if rng.random() < 0.5 else [])
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(text)))
            if rng.random() < 0.3:
                base = text
    docs += [(len(docs) + k, " ".join([rng.choice(vocabulary) for _ in range(50)] + passage)) for k in range(40)]
    n = len(docs)
    return [*docs, (n, None), (n + 1, ""), (n + 2, "  "), (n + 3, "one two"), (n + 4, "ONE  two"), (None, "one two"), (5, docs[5][1]), (None, "alone no id here"), (n + 5, "x" * 50_000)]


def test_jaccard_join(spark):
    docs = near_copies()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(jaccard.report(frame.selectExpr("*", "1 as n", "2 as class"))) == brute_join(docs)[0]
    found = jaccard.join(frame, size=5, near=(80, 100)).select("doc_id", "n_shingles", "component_id")
    assert rows(found) == brute_join(docs, 5, (80, 100))[0]
    assert jaccard.report(frame.limit(0)).count() == 0


def test_jaccard_join_by_shuffles_and_places(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "WIDE_ROWS", 0)
    monkeypatch.setattr(jaccard, "PARTNERS", 3)
    docs = near_copies(seed=5, groups=3)
    assert rows(jaccard.report(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute_join(docs)[0]


def test_jaccard_join_on_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.QUERIES["op1_jaccard_join"](spark, SF)) == brute_join(docs)[0]


def test_unlike_sets_of_a_region_make_no_pairs(spark, monkeypatch):
    """Edited copies that are not linked share regions: pairs grow with the copies, not with their square."""
    rng, made = random.Random(17), Counter()
    base = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(150):
        text = list(base)
        for at in rng.sample(range(60), 4):
            text[at] = f"x{rng.randrange(10**6)}"
        docs.append((k, " ".join(text)))
    docs += [(150 + k, docs[k][1] + " end") for k in range(5)]
    kept = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, purpose: made.update({purpose: (out := kept(df, purpose)).count()}) or out)
    assert rows(jaccard.report(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute_join(docs)[0]
    assert made["pairs"] < 2 * len(docs)


def test_a_group_of_near_copies_sends_no_square_of_pairs(spark, monkeypatch):
    """Copies with any of eight edits: two are linked if at most two edits differ, so few are linked with the pivot."""
    rng, sent = random.Random(11), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    docs = []
    for k, bits in enumerate(itertools.product((0, 1), repeat=8)):
        text = list(base)
        for at, bit in enumerate(bits):
            if bit:
                text[10 + 18 * at] = f"v{at}"
        docs.append((k, " ".join(text)))
    compared = jaccard._compared

    def counted(pairs, *more):
        sent.append(pairs.count())
        return compared(pairs, *more)

    monkeypatch.setattr(jaccard, "_compared", counted)
    assert rows(jaccard.report(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute_join(docs)[0]
    assert sum(sent) < 24 * len(docs)


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(4)
    for size in (1, 40, 3000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 63, 30, dtype=np.uint64)]))
        assert int(np.bitwise_count((jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))
    assert len(jaccard.parity(a)) == jaccard.PARITY // 64


def test_one_document_of_each_group_stays(spark):
    docs = near_copies(seed=7, groups=3)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "doc_id as text_hash")
    kept = [tuple(r)[:2] for r in jaccard.one_of_each(frame).collect()]
    _, sets, groups = brute_join(docs, 5, (80, 100))
    assert Counter(t for _, t in kept if not (t or "").strip()) == Counter(t for _, t in docs if not (t or "").strip())
    text_group = {docs[k]: groups.root(k) for k in range(len(docs)) if sets[k]}
    assert Counter(text_group[d] for d in kept if (d[1] or "").strip()) == Counter(dict.fromkeys(set(text_group.values()), 1))


def brute_lines(docs):
    places, texts = [], {}
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            n = lines.normalised(line)
            if len(n.split()) >= lines.LEAST:
                places.append(((doc is None, doc or 0, k), n))
                texts.setdefault(n, len(texts))
    names = list(texts)
    sims, groups, regions = np.zeros(len(texts), np.uint64), Groups(len(names)), defaultdict(list)
    for k, n in enumerate(names):
        h = np.array(tokens.hash_words(n.split()), np.uint64)
        pairs = tokens.mix(h * lines._STEP + np.append(h[1:], np.uint64(0)))
        bits = np.unpackbits(pairs.view(np.uint8).reshape(-1, 8), axis=1).sum(0)
        sims[k] = np.packbits(2 * bits > len(pairs)).view(np.uint64)[0]
        for block in range(lines.MIN_BLOCKS):
            regions[block, *(int((pairs * lines._ORDERS[2 * block + way]).min()) for way in (0, 1))].append(k)
    apart = [(a, int(b)) for a in range(len(names)) for b in a + 1 + np.flatnonzero(np.bitwise_count(sims[a + 1 :] ^ sims[a]) <= lines.BITS)]
    alike = {pair for members in regions.values() for pair in itertools.combinations(members, 2)}
    for a, b in {*apart, *alike}:
        if (int(sims[a]) ^ int(sims[b])).bit_count() <= lines.WIDE and lines.similar(names[a], names[b]):
            groups.link(a, b)
    first = {}
    for place, n in sorted(places):
        first.setdefault(groups.root(texts[n]), place)
    out = defaultdict(set)
    for place, n in places:
        if first[groups.root(texts[n])] != place:
            out[None if place[0] else place[1]].add(place[2])
    return {k: sorted(v) for k, v in out.items()}


def line_docs(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"word{k}" for k in range(300)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 12, 60, 120]))] for _ in range(30)]
    docs = []
    for doc in range(120):
        text = []
        for _ in range(rng.randint(0, 8)):
            line = list(rng.choice(pool)) if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(40)]
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            text.append(" ".join(line).upper() if rng.random() < 0.2 else "  ".join(line) + ".")
        docs.append((doc, "\n".join(text)))
    return [*docs, (200, None), (201, ""), (202, "\n\n"), (203, docs[3][1]), (None, docs[4][1]), (204, "é à ü ö ñ\né à ü ö ñ\n"), (205, "a b c d e " * 20_000)]


def test_line_dedup(spark):
    docs = line_docs()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = lines.report(frame).collect()
    expected = brute_lines(docs)
    assert {r["doc_id"]: [int(x) for x in r["dropped"].split(",")] for r in found if r["dropped"]} == expected
    texts = dict(docs)
    for r in found:
        text, gone = texts[r["doc_id"]], expected.get(r["doc_id"], [])
        assert r["text"] == (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
    again = lines.dedup(frame.selectExpr("*", "1 as hash", "2 as line")).columns
    assert again == ["doc_id", "text", "hash", "line", "__dropped"]
    assert lines.report(frame.limit(0)).count() == 0


def test_line_dedup_in_scripts_without_spaces(spark):
    rng = random.Random(9)
    scripts = [range(0x4E00, 0x9F00), range(0x3041, 0x3097), range(0x0E01, 0x0E2F), range(0x1000, 0x1020), range(0x1780, 0x17A0), range(0x20000, 0x20100)]
    repeated = ["".join(chr(rng.choice(s)) for _ in range(20)) + "。" for s in scripts]
    long = "".join(chr(rng.choice(scripts[0])) for _ in range(900))
    short, hangul = repeated[0][:19], "가나다라마바사아자차카타파하가나다라마바사아 가나"
    docs = [(1, "\n".join([*repeated, long, short, hangul])), (2, "\n".join(["새", *reversed(repeated), short, hangul])), (3, f"{long[:-1]}一\n{repeated[1][:-2]}ゟゟ。")]
    found = {r["doc_id"]: r["dropped"] for r in lines.report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {1: "", 2: ",".join(str(k + 1) for k in range(len(scripts))), 3: "0,1"}
    names = [lines.normalised(x) for x in (*repeated, long)]
    sims, blocks = lines._marks_of_letters(names)
    for k, n in enumerate(names):
        sim, block = lines._marks_of_letters([n])
        assert sims[k] == sim[0] and blocks[k].tolist() == block[0].tolist()


def test_line_dedup_by_shuffles(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    docs = line_docs(seed=2)[:80]
    found = lines.report(spark.createDataFrame(docs, "doc_id bigint, text string")).where("dropped <> ''").collect()
    assert {r["doc_id"]: [int(x) for x in r["dropped"].split(",")] for r in found} == brute_lines(docs)


def test_line_dedup_on_the_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op10_line_dedup"](spark, SF).where("dropped <> ''").collect()
    assert {r["doc_id"]: [int(x) for x in r["dropped"].split(",")] for r in found} == brute_lines(docs)


def test_line_recall_against_edit_similarity_alone(spark):
    """The blocks find at least 0.9 of the pairs with an edit similarity of 0.8; no key takes part in the brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text").toArrow().column(0).combine_chunks()
    names = sorted({lines.normalised(found.text(k)) for found in lines.hashed_lines(docs, lines.LEAST) for k in range(len(found))})
    size = np.array([len(n) for n in names])
    letters = np.array([np.bincount(np.frombuffer(n.encode("utf-32-le"), np.uint32) % 40, minlength=40) for n in names])
    truth = found = 0
    for a in random.Random(5).sample(range(len(names)), 1200):
        b = np.flatnonzero(np.minimum(size[a], size) >= lines.SIMILAR * np.maximum(size[a], size))
        more = letters[b] - letters[a]
        edits = np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))  # no fewer are needed
        b = [int(x) for x in b[edits <= (1 - lines.SIMILAR) * np.maximum(size[a], size[b]) + 1e-9] if x != a and lines.similar(names[a], names[int(x)])]
        for other in b:
            truth += 1
            (one,) = lines.hashed_lines(pa.array([names[a] + "\n" + names[other]]), 1)
            bits = int(np.bitwise_count(one.sim.view(np.uint64)[0] ^ one.sim.view(np.uint64)[1]))
            found += bits <= lines.BITS or bool((one.blocks[0] == one.blocks[1]).any()) and bits <= lines.WIDE
    print("pairs", truth, "found", found)
    assert truth >= 20 and found >= 0.9 * truth


def test_pigeonhole_keys_find_all_close_hashes(spark):
    rng = random.Random(4)
    for blocks in range(lines.BITS + 1, lines.BITS + 5):
        pairs = []
        for _ in range(60):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), lines.BITS):
                b ^= 1 << bit
            pairs.append(tuple(x - (1 << 64) if x >= 1 << 63 else x for x in (a, b)))
        frame = spark.createDataFrame(pairs, "a bigint, b bigint")
        from pyspark.sql import functions as F

        assert frame.where(~F.arrays_overlap(lines.keys(F.col("a"), blocks), lines.keys(F.col("b"), blocks))).count() == 0


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    rng = random.Random(6)
    for _ in range(800):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert lines.edit_distance(a, b) == plain(a, b)


def test_edit_distance_with_a_limit_and_bounds():
    rng = random.Random(12)
    for _ in range(400):
        a = [rng.choice("abcde ") for _ in range(rng.randint(1, 200))]
        b = list(a)
        for _ in range(rng.choice([0, 5, 20, 60, 150])):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 2)] = [rng.choice("abcde ") for _ in range(rng.randint(0, 2))]
        a, b = "".join(a), "".join(b)
        whole = lines.edit_distance(a, b)
        assert int(lines.edits_at_least(lines.gram_counts(a), [lines.gram_counts(b)])[0]) <= whole
        for limit in (0, whole - 1, whole, whole + 1, 30):
            found = lines.edit_distance(a, b, limit)
            assert found == whole if whole <= limit else limit < found <= whole


def test_unlike_lines_of_a_region_make_no_rows(spark, monkeypatch):
    """Rows grow with the lines of a region, not with their pairs, and no link is lost over the places of a region."""
    from pyspark.sql import functions as F

    rng, made = random.Random(14), Counter()
    docs = [(k, " ".join(f"{rng.randrange(10**6)}" for _ in range(4))) for k in range(300)]
    docs += [(300 + k, docs[k][1].replace(" ", " x", 1)) for k in range(0, 300, 30)]
    kept = lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, purpose: made.update({purpose: (out := kept(df, purpose)).count()}) or out)
    monkeypatch.setattr(lines, "OUTERS", 50)
    own = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "xxhash64(text) as text_hash", "text")
    found = lines.occurrences(own, 4).withColumn("first", F.struct("doc_id", "text_hash", "line"))
    same = kept(found.select("hash", F.lit(0).cast("bigint").alias("sim"), "letters", F.array(F.lit(7).cast("bigint")).alias("blocks"), "first"), "lines")
    of = {r["hash"]: r["first"]["doc_id"] for r in same.collect()}
    linked = {frozenset((of[r["a"]], of[r["b"]])) for r in lines.links(own, same, 4).collect()}
    assert linked == {frozenset((k, 300 + k)) for k in range(0, 300, 30)}
    assert made["line-pairs"] < 5 * len(docs)


def test_components(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(-(2**63), 5000), (7, 7)] + [(9000, 9001 + k) for k in range(200)]
    groups = {v: {v} for e in edges for v in e}
    for a, b in edges:
        if groups[a] is not groups[b]:
            joined = groups[a] | groups[b]
            for v in joined:
                groups[v] = joined
    found = defaultdict(set)
    for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect():
        found[r["root"]].add(r["id"])
    assert {frozenset(s) for s in found.values()} == {frozenset(s) for s in groups.values() if len(s) > 1}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_vectors(vectors, least=embeddings.LEAST):
    fine = [(k, np.array(v, float) / max(map(abs, v)), label) for k, (_, v, label) in enumerate(vectors) if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups, links = Groups(len(vectors)), Counter()
    for x, (k, v, label) in enumerate(fine):
        for j, w, other in fine[:x]:
            if label == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                groups.link(k, j)
                links[k] += 1
                links[j] += 1
    best = {}
    for k, (i, _, _) in enumerate(vectors):
        if i is not None:
            best[groups.root(k)] = min(best.get(groups.root(k), i), i)
    own = {k for k, _, _ in fine}
    out = []
    for k, (i, _, _) in enumerate(vectors):
        component = best.get(groups.root(k)) if k in own else i
        out.append((i, links[k], component, i == component))
    return sorted(out, key=repr)


def test_embedding_near_duplicates(spark):
    rng = np.random.default_rng(2)
    vectors = []
    for label in (0, 1, 1, 1):
        centre = rng.normal(size=16)
        vectors += [(len(vectors) + k, (centre + rng.normal(size=16) * s).round(3).tolist(), label) for k, s in enumerate(rng.uniform(0.02, 0.5, 60))]
    vectors += [(len(vectors) + k, rng.normal(size=16).tolist(), int(k % 2)) for k in range(60)]
    n = len(vectors)
    vectors += [(n, vectors[0][1], 0), (n + 1, vectors[0][1], 1), (n + 2, vectors[0][1], None), (n + 3, None, 0), (n + 4, [0.0] * 16, 0), (n + 5, [float("nan")] * 16, 0), (n + 6, [1.0, 2.0], 0)]
    vectors += [(n + 7, [1.0, None], 0), (n + 8, [], 0), (n + 9, [float("inf"), 1.0], 0), (n + 10, [1e300, 2e300], 0), (None, vectors[1][1], 0), (3, vectors[3][1], 0), (None, None, None)]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, label int")
    for shard in (2_000, 40):
        found = embeddings.near_duplicates(frame.selectExpr("*", "1 as class"), shard=shard, beam=64, audit=1_000, recall=1.0)
        assert rows(found) == brute_vectors(vectors)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_on_the_tables(spark):
    vectors = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert rows(queries.QUERIES["op5_embedding_dedup"](spark, SF)) == brute_vectors(vectors)


def test_small_world_graph_recall():
    from tidemark.llm.hnsw import Graph

    rng = np.random.default_rng(3)
    v = rng.normal(size=(1500, 24)) + np.repeat(rng.normal(size=(30, 24)) * 3, 50, axis=0)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = Graph(v)
    truth = v @ v.T >= 0.9
    found = sum(len(graph.within(q, 0.9, 32)) for q in v)
    assert found >= 0.97 * truth.sum()
    assert all((v[graph.within(q, 0.9, 32)] @ q >= 0.9).all() for q in v[:50])


def test_edit_distances_of_many_pairs_are_those_of_each():
    rng = random.Random(8)

    def changed(text, edits):
        letters = list(text)
        for _ in range(edits):
            at = rng.randrange(len(letters))
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é中", "ab"])
            letters = letters or ["a"]
        return "".join(letters)

    pairs = [("", ""), ("", "a"), ("a", "a"), ("a", "b")]
    for size in (3, 63, 64, 65, 128, 200, 700):
        for _ in range(60):
            a = "".join(rng.choice("abcde fé中\U00020000") for _ in range(size))
            shared = "".join(rng.choice("abcdefgh") for _ in range(2 * size))
            pairs.append((a, changed(a, rng.randint(0, size // 3))))
            pairs.append((a[: size // 3] + shared + a, a[size // 2 :] + shared + changed(a, size // 4)))
    assert lines.similar_pairs(pairs).tolist() == [lines.similar(a, b) for a, b in pairs]
    assert lines.similar_pairs([]).tolist() == []
    a, b = zip(*(sorted(p, key=len) for p in pairs if 64 < min(map(len, p)) <= 128), strict=True)
    for limit in (0, 20, 1000):
        found = lines.edit_distances(a, b, [limit] * len(a)).tolist()
        whole = [lines.edit_distance(x, y) for x, y in zip(a, b, strict=True)]
        assert all(f == w if w <= limit else f > limit for f, w in zip(found, whole, strict=True)) and (limit < 1000 or found == whole)


def test_lines_of_several_common_regions_are_compared_once(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    passage = [f"p{k}" for k in range(40)]
    texts = [" ".join([*(f"w{rng.random()}" for _ in range(4)), *passage, *(f"w{rng.random()}" for _ in range(4))]) for _ in range(30)]
    texts += [t + " end" for t in texts[:5]]
    members = [row for one in lines.hashed_lines(pa.array(texts), lines.LEAST) for row in zip(one.hash.tolist(), one.sim.tolist(), one.letters.tolist(), strict=True)]
    names = {h: t for (h, _, _), t in zip(members, texts, strict=True)}
    # Regions of two keys that hold all lines, each line a component of its own.
    frame = spark.createDataFrame([(key, h, s, n, h, True, 1) for key in (7, -7) for h, s, n in members], "key bigint, hash bigint, sim bigint, letters bigint, root bigint, outer boolean, places bigint")
    every = frame.groupBy("hash").agg(F.collect_set("key").alias("keys"))
    by_hash = spark.createDataFrame([(h, t) for h, t in names.items()], "hash bigint, text string")
    got = {tuple(r) for r in lines._linked_within(frame, every, by_hash, lines.SIMILAR).collect()}
    close = {(a, b): ((sa ^ sb) & (1 << 64) - 1).bit_count() <= lines.WIDE for a, sa, _ in members for b, sb, _ in members if a < b}
    assert got == {p for p, near in close.items() if near and lines.similar(lines.normalised(names[p[0]]), lines.normalised(names[p[1]]))} and len(got) >= 5
    once, both = (lines.Held(lines.SIMILAR) for _ in range(2))
    h, s, n = (np.array(x) for x in zip(*members, strict=True))
    arguments = (np.ones(len(h), bool), h, s, n, h)
    assert [*once.could(*arguments, [{-7}] * len(h), pa.array(texts))] == [] and len([*both.could(*arguments, [set()] * len(h), pa.array(texts))]) >= len(got)
