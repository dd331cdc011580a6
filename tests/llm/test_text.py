"""HTML extraction, toxicity and the pipeline."""

import html
import math
import random
import re
import zlib

import pytest

import corpus_pipeline
from tests.conftest import rows
from tests.llm.test_native import SF
from tests.llm.test_pairs import brute_join, brute_lines
from tests.llm.test_python_ops import check_packing
from tidemark.llm import decontaminate, queries, toxicity, wrappers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>ad</p> --><div class="ad">Buy</div>
<article><h1>Head &amp; more</h1><p>One <b>bold</b>\n text<br>next<p>Two &lt;x&gt; &copy;<ul><li>a<li>b</ul><form>Name <input></form>
<aside>Side</aside><div class="comments"><p>First!</p></div></article><footer>Foot</footer>"""


def test_article_text():
    assert wrappers.text_of(PAGE.format(), set()) == "Head & more\n\nOne bold text next\n\nTwo <x> ©\n\na\n\nb"
    assert wrappers.text_of("", set()) == "" and wrappers.text_of("plain  &amp; text", set()) == "plain & text"
    assert wrappers.text_of("<p>a<p>b</div><td>c", set()) == "a\n\nb\n\nc"
    assert wrappers.text_of("<p>1 < 2 and <b", set()) == "1 < 2 and <b"


def test_wrapper_has_slots_options_and_repeats():
    one = wrappers.Wrapper.of(*wrappers.read("<body><h1>A</h1><div class=x>k</div><p>1<p>2</body>"))
    two = wrappers.Wrapper.of(*wrappers.read("<body><h1>B</h1><p>3</body>"))
    both = one.merge(two)
    assert wrappers.expression(both.units) == wrappers.expression(two.merge(one).units) == "<body><h1>#</h1>(<div.x>#</div>)?(<p>#</p>)+</body>" or "(<div.x>#</div>)?" in wrappers.expression(both.units)
    assert wrappers.Wrapper.load(both.dump()).units == both.units and both.slots["/body/h1"][0] is None


def test_pages_without_marked_articles_lose_what_their_host_repeats(spark):
    rng = random.Random(1)
    pages = [(k, f"http://h.example/{k}", f"<body><div>Same on all pages</div><div><a href=x>link {k} to follow</a></div><section><p>Text {rng.random()} of {k}</p></section></body>") for k in range(12)]
    pages += [(100, "http://other.example/", "<body><div>Same on all pages</div></body>"), (101, None, None), (102, "odd", ""), (None, "http://h.example/z", pages[0][2]), (0, *pages[0][1:])]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = wrappers.extract(frame.selectExpr("*", "1 as host", "2 as left_out")).collect()
    assert len(found) == len(pages)
    for r in found:
        source = next(h for p, u, h in pages if (p, u) == (r["page_id"], r["url"]))
        inner = re.search(r"<p>(.*)</p>", source or "")
        assert r["text"] == (inner[1] if inner else "Same on all pages" if r["page_id"] == 100 else "") and r["n_chars"] == len(r["text"])
    assert wrappers.extract(frame.limit(0)).count() == 0


def test_text_that_only_one_page_of_a_host_has_stays(spark):
    tail = "<div>Same on all pages</div>"
    pages = [(k, f"http://h.example/{k}", f"<body>{tail}<section><p>Text of {k}</p></section></body>") for k in range(12)]
    pages += [(20, "http://h.example/long", f"<body>{tail}<section><p>Long</p></section><div>one</div><div>two</div><h2>Head</h2><pre>code</pre><blockquote>said</blockquote></body>")] * 2
    pages += [(30 + k, "http://h.example/few", f"<body>{tail}<section><p>Few {k}</p></section><table><td>On four pages</td></table></body>") for k in range(4)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    found = {r["page_id"]: r["text"] for r in wrappers.extract(frame).collect()}
    assert found[20] == "Long\n\none\n\ntwo\n\nHead\n\ncode\n\nsaid"
    assert all(found[k] == f"Text of {k}" for k in range(12))
    assert all(found[30 + k] == f"Few {k}\n\nOn four pages" for k in range(4))


def test_the_expression_finds_what_optional_parts_move(spark):
    parts = ["", "<div><h2>Figure {k}</h2></div>", "<div><h2>Figure {k}</h2></div><div><pre>code {k}</pre></div>"]
    own = "<div>Same on all pages</div><div><blockquote><a href=x>{k} to follow</a></blockquote></div>"
    pages = [(k, f"http://h.example/{k}", f"<body>{parts[k % 3]}{own}<section><p>Text of {k}</p></section></body>".format(k=k)) for k in range(12)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(5)
    found = {r["page_id"]: r["text"] for r in wrappers.extract(frame).collect()}
    # The like divs stand at three places, on four pages each: no path holds the same text on five pages.
    assert found == {k: "\n\n".join([f"Figure {k}", f"code {k}"][: k % 3] + [f"Text of {k}"]) for k in range(12)}


def test_each_page_of_a_host_matches_its_expression():
    rng = random.Random(3)

    def element(depth):
        name = rng.choice(["div", "section", "p", "ul", "li", "h2"])
        inner = "".join(element(depth - 1) if depth and rng.random() < 0.6 else f" t{rng.randint(0, 3)} " for _ in range(rng.randint(0, 3)))
        return f"<{name}>{inner}</{name}>"

    for _ in range(60):
        pages = [wrappers.read("".join(element(3) for _ in range(rng.randint(0, 4)))) for _ in range(rng.randint(1, 8))]
        whole = pages and wrappers.Wrapper.of(*pages[0])
        for page in pages[1:]:
            whole = whole.merge(wrappers.Wrapper.of(*page))
        expression = wrappers.Expression(wrappers.Wrapper.load(whole.dump()).units)
        for blocks, stream in pages:
            units = [u for u, _ in wrappers.fold(stream)]
            at = expression.match(units)
            assert at == sorted(set(at)) and [whole.units[k][0] for k in at] == units
            assert all(optional for k, (_, optional) in enumerate(whole.units) if k not in at)
            assert len(expression.slots(blocks, stream)) == len(blocks)
    assert wrappers.Expression([("#", False)]).match(["<div>"]) is None


def test_html_text_on_the_tables(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op6_html_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_misspelled_terms():
    trie = toxicity.Trie(frozenset({"stupid", "scum"}), frozenset({"lowei"}), frozenset({"stupor"}))
    near = ["stpid", "stupidd", "stvpid", "stuipd", "tupid", "xstupid", "stupi"]
    assert [trie.find(w) for w in near] == [2] * len(near)
    assert [trie.find(w) for w in ("stupid", "loweient", "lowei", "scun", "stupor", "stud", "cupids", "")] == [1, 1, 0, 0, 0, 0, 0, 0]

    def plain(a, b):
        from tidemark.llm.lines import edit_distance

        swaps = {a[:k] + a[k + 1] + a[k] + a[k + 2 :] for k in range(len(a) - 1)}
        return edit_distance(a, b) <= 1 or b in swaps

    rng = random.Random(3)
    words = {"".join(rng.choice("stupid") for _ in range(rng.randint(4, 7))) for _ in range(3000)} | set(near)
    assert all(trie.misspelled(w) == plain("stupid", w) for w in words)


def test_context_tells_quotation_from_abuse():
    memory = toxicity.Memory(toxicity.Trie(frozenset({"moron", "stupid"}), frozenset()))
    assert toxicity.hits("you moron and stupid", memory) == (2, 0, 0)
    assert toxicity.hits('he was told "you moron" once', memory) == (0, 1, 0)
    assert toxicity.hits("the word moron is old, you stuppid one", memory) == (0, 1, 1)
    assert toxicity.hits("", memory) == (0, 0, 0)


@pytest.mark.parametrize("n", [900])
def test_toxicity_learns_from_its_own_folds_only(spark, n):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "mo") for b in ("ran", "sel", "tim", "vok", "zen")]
    docs, labels = [], []
    for doc in range(n):
        toxic = doc % 5 == 0
        words = [rng.choice(vocabulary) for _ in range(30)]
        if toxic:
            words[3], words[9] = rng.sample(["scumbag", "worthless", "disgusting"], 2)
        held_out = zlib.crc32(str(doc).encode()) % 3 == 1
        docs.append((doc, " ".join(words)))
        labels.append((doc, int(toxic != held_out)))  # wrong on the fold that must not be used
    docs += [(n, None), (n + 1, ""), (None, "worthless"), (n + 2, "x " * 100_000), (5, docs[5][1])]
    frame, known = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([*labels, (None, 1), (n + 9, None)], "doc_id bigint, toxic int")
    found = toxicity.report(frame.selectExpr("*", "1 as toxic", "2 as score"), known).collect()
    assert len(found) == len(docs)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
            assert r["predicted"] == int(r["doc_id"] < n and r["doc_id"] % 5 == 0)
    kept = toxicity.clean(frame.selectExpr("*", "1 as score"), known)
    assert kept.columns == ["doc_id", "text", "score"]
    assert {r[0] for r in kept.select("doc_id").collect()} >= {k for k in range(n) if k % 5} | {n, n + 1, n + 2}
    assert toxicity.report(frame.limit(0), known).count() == 0
    assert {r["score"] for r in toxicity.report(frame, known.limit(0)).collect()} == {0.0}


def test_toxicity_of_a_sample_keeps_the_share_of_the_corpus(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for doc in range(1800):
        toxic = doc % 10 == 0
        words = [f"word{rng.randrange(60)}" for _ in range(20)]
        if toxic:
            words[3], words[9], words[12] = "scumbag", "worthless", "grumpy"
        elif doc % 10 == 1:
            words[7] = "grumpy"  # as often harmless as toxic, 9 times as often toxic in equal samples
        docs.append((doc, " ".join(words)))
        labels.append((doc, int(toxic)))
    frame, known = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    used = [t for doc, t in labels if zlib.crc32(str(doc).encode()) % 3 != 1]
    whole, part = (toxicity.fit(frame, known, fit_rows=n) for n in (20_000, 90))
    for model in (whole, part):
        assert abs(model.prior - math.log(sum(used) / (len(used) - sum(used)))) < 1e-9
        assert model.trie.terms | model.trie.beginnings and not any("grumpy".startswith(t) for t in model.trie.terms | model.trie.beginnings)


def test_toxicity_on_the_held_out_rows(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in found) / len(found)
    wrong = sum(r["predicted"] and not r["toxic"] for r in found) / max(1, sum(1 - r["toxic"] for r in found))
    assert right > 0.97 and wrong < 0.005


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]

    def run(name, frame):
        out = stages[name](spark, frame, SF)
        if name != "packing":
            assert out.columns == frame.columns
        kept = [r.asDict() for r in out.collect()]
        return kept, spark.createDataFrame(kept, out.schema) if kept else out

    first, frame = run("toxicity", docs)
    assert {r["doc_id"] for r in first} <= {r["doc_id"] for r in docs.collect()}
    second, frame2 = run("line_dedup", frame)
    gone = brute_lines([(r["doc_id"], r["text"]) for r in first])
    expected = {r["doc_id"]: "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in gone.get(r["doc_id"], ())) for r in first}
    assert {r["doc_id"]: r["text"] for r in second} == {k: v for k, v in expected.items() if re.search(r"[^\W_]", v) or k not in gone}
    assert all(r["n_chars"] == len(r["text"]) for r in second)
    third, frame3 = run("jaccard_join", frame2)
    components = brute_join([(r["doc_id"], r["text"]) for r in second], 5, (80, 100))[0]
    assert {r["doc_id"] for r in third} == {c for _, n, c in components if n} | {d for d, n, _ in components if not n}
    fourth, frame4 = run("decontamination", frame3)
    bad = {r["doc_id"] for r in decontaminate.report(frame3, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert {r["doc_id"] for r in fourth} == {r["doc_id"] for r in third} - bad
    check_packing(stages["packing"](spark, frame4, SF).collect(), [(r["doc_id"], r["text"]) for r in fourth])
    whole = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == {r["doc_id"] for r in fourth}


def test_pipeline_on_odd_and_empty_tables(spark):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f g", None, None, 13), (3, "a b c d e f g", "en", "s", 13), (3, "a b c d e f g", "en", "s", 13)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for docs in (spark.createDataFrame(odd, schema).selectExpr("*", "1 as hash"), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            docs = docs if name == "packing" else spark.createDataFrame(out.collect(), docs.schema)
        assert {r[0] for r in docs.select("doc_id").collect()} <= {1, 2, 3, None}
    assert rows(docs) == []
