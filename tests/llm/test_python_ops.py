"""WARC round trip, packing and license scan against brute force."""

import base64
import gzip
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.conftest import rows
from tests.llm.test_native import AZ, SF, WORD
from tidemark.llm import licenses, packing, queries, tokens, warc
from tidemark.session import shared_dir


def brute_warc(pages):
    first = {}
    for page, html in pages:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, html in pages:
        payload = (html or "").encode()
        to = first.get(html or "")
        revisit = to is not None and page != to
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_warc(spark):
    assert rows(queries.QUERIES["op3_warc"](spark, SF)) == brute_warc([tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()])
    odd = [(3, "a\r\nb", None), (2, None, "x"), (5, None, "\r\n\r\nWARC/1.1\r\n\r\né"), (5, None, "\r\n\r\nWARC/1.1\r\n\r\né"), (9, "u", "x"), (None, "u", "x"), (None, "u", "alone"), (1, "", ""), (8, "u", "A" * 17_000_000)]
    pages = spark.createDataFrame(odd, "page_id bigint, url string, html string")
    assert rows(warc.round_trip(pages.withColumn("digest", pages.url))) == brute_warc([(p, h) for p, _, h in odd])
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_files_are_members_at_their_offsets(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").unionByName(spark.createDataFrame([(10**6, "u", "B" * 17_000_000)], "page_id bigint, url string, html string"))
    raw, target = shared_dir(spark, "raw"), shared_dir(spark, "warc")
    warc.write_archives(pages, raw, records=40)
    warc.normalise(spark, raw, target)
    entries = warc.read_index(spark, target)
    found = warc.read_members(spark, target, entries).collect()
    assert len(found) == pages.count()
    for r in found:
        record = gzip.decompress(r["member"])
        assert record.startswith(b"WARC/1.1\r\n") and f"Page-ID: {r['page_id']}\r\n".encode() in record and len(r["member"]) == r["length"]
    files = spark.read.format("binaryFile").load(f"{target}/kind=warc").select("content").collect()
    assert sum(gzip.decompress(f[0]).count(b"WARC/1.1\r\n") for f in files) == len(found)


def check_packing(found, docs, length=2048):
    model = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = [np.array(model.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in docs]
    expected, got = defaultdict(list), defaultdict(list)
    for (doc, _), x in zip(docs, ids):
        expected[doc].append((len(x), zlib.crc32(x[: min(len(x), length)].tobytes())))
    bins = defaultdict(list)
    for r in found:
        if r["start"] == 0:
            got[r["doc_id"]].append((r["doc_tokens"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert sum(r["length"] for r in found) == sum(map(len, ids))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sum(map(len, ids)) / (len(bins) * length)


def test_packing(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert check_packing(queries.QUERIES["op4_packing"](spark, SF).collect(), docs) > 0.98
    odd = [(1, None), (2, ""), (3, "a  b\n\n c\t\t\td   "), (3, "a  b\n\n c\t\t\td   "), (None, " \x1c\x1c x　　y \n"), (7, "it's I'll  'll\r\n\r\n123 45é — ok"), (8, "word " * 9000), (9, "x" * 5000)]
    frame = spark.createDataFrame(odd, "doc_id bigint, text string")
    check_packing(packing.pack(frame.selectExpr("*", "1 as length")).collect(), odd)
    assert packing.pack(frame.limit(0)).count() == 0


def test_first_fit_decreasing_equals_the_plain_form():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 65, 500):
        sizes = [int(x) for x in rng.integers(1, 101, n)]
        bins, plain = [], {}
        for k in sorted(range(n), key=lambda k: (-sizes[k], k)):
            b = next((b for b, used in enumerate(bins) if used + sizes[k] <= 100), len(bins))
            if b == len(bins):
                bins.append(0)
            plain[k] = (b, bins[b])
            bins[b] += sizes[k]
        assert packing.first_fit_decreasing(sizes, 100) == [plain[k] for k in range(n)]


def brute_licenses(docs):
    out = []
    for doc, text in docs:
        w = WORD.findall((text or "").translate(AZ))
        at = [(k, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()] for k in range(len(w)) if w[k : k + len(p)] == p]
        places = [k for k, _ in at]
        out.append((doc, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return sorted(out, key=repr)


def test_licenses(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert rows(queries.QUERIES["op8_license_scan"](spark, SF).select(base)) == brute_licenses(docs)
    odd = [
        (1, None), (2, ""), (None, "mit"), (3, "license"), (4, "MIT License, the MIT license. CC-BY"), (4, "MIT License, the MIT license. CC-BY"), (5, "é" * 9 + " cc by"),
        (6, "Licensed under the Apache License, Version 2.0."), (7, "licensed under Apache License 2.0"), (8, "Licensed under a Apache License 2.0"),
        (9, "x " * 5000 + licenses.TEMPLATES["gpl-header"].replace("<<any 2>>", " foo ")), (10, "Released under the MIT License."), (11, "under the MIT"),
    ]
    found = licenses.scan(spark.createDataFrame(odd, "doc_id bigint, text string").selectExpr("*", "1 as labels"))
    assert rows(found.select(base)) == brute_licenses(odd)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in found.collect()}
    assert labels[6] == ("apache,apache-2.0", 1.0) and labels[7] == ("apache,apache-2.0", 1.0) and labels[10] == ("mit,mit-notice", 1.0)
    assert labels[8] == ("apache", 0.5) and labels[9] == ("gpl,gpl-header", 1.0) and labels[1] == ("", 0.0)
    assert licenses.scan(found.selectExpr("doc_id", "labels as text").limit(0)).count() == 0


def test_words_hash_alike_wherever_they_stand():
    texts = ["", "Ab c", "c abé", " x ", "ab", " c"]
    import pyarrow as pa

    for size in (1, 8, 1 << 20):
        got = []
        for _, data, bounds in tokens.pieces(pa.array(texts), size):
            w = tokens.Words(data, bounds, "space")
            got += [[w.text(k) for k in range(w.first[d], w.first[d + 1])] for d in range(len(bounds) - 1)]
            for k in range(len(w.hash)):
                assert w.hash[k] == tokens.hash_words([w.text(k)])[0]
        assert got == [t.split(" ") if t and t != " x " else ["x"] if t else [] for t in texts]
