"""Added tokens in texts, clashing column names before the toxicity score, audits of the small-world graph."""

import json
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_native import SF
from tidemark.llm import packing, toxicity
from tidemark.llm.hnsw import Graph


def test_added_tokens_have_their_own_ids():
    model = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        added = [t["content"] for t in json.load(file)["added_tokens"]]
    assert added
    texts = [form.format(t=t) for t in added for form in ("{t}", "{t} a", "a {t}", "a{t}b", "a  {t}  b", "{t}{t}", "x {t}{t} y\n\n{t}", "<{t}>", "{t}\n \n")]
    texts += [t[:-1] for t in added] + [t.upper() for t in added]
    pick, parts = random.Random(1), [*added, " ", "  ", "\n", "word", "It's", "12", "é", " ", "<|", "|>", "endoftext"]
    texts += ["".join(pick.choices(parts, k=pick.randrange(9))) for _ in range(3000)]
    encode = packing.encoder()
    for text in texts:
        assert encode.ids(text).tolist() == [*model.encode(text, add_special_tokens=False).ids, packing.END], text


def test_toxicity_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = toxicity.clean(docs, labels)
    named = docs.selectExpr("*", "1 as toxic", "2 as label_id", "3 as __id", "4 as quality", "5 as bad", "6 as key")
    clean = toxicity.clean(named, labels)
    assert clean.columns == named.columns
    assert sorted(r[0] for r in clean.select("doc_id").collect()) == sorted(r[0] for r in plain.select("doc_id").collect())


def test_an_audit_cannot_pass_on_nothing():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(600, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = Graph(v)
    met = []
    found = Graph.within
    graph.within = lambda q, least, beam: met.append(least) or found(graph, q, least, beam)
    beam = graph.audited(v[:50], 0.999, 4, 0.995, np.arange(50))  # no two are that close
    assert met and beam >= 4 and max(met) < 0.999
    # Linked vectors: a query's hit on itself does not count.
    v[1] = v[0]
    graph = Graph(v)
    assert graph.audited(v[:2], 0.999, 4, 0.995, np.array([0, 1])) >= 4
