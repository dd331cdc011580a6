"""License scans: template markup compiled into token automata.

A template is plain wording with regions in angle brackets: ``<<opt>> ... <</opt>>`` may be left out,
``<<any N>>`` stands for 0 to N words. It is compiled into an automaton over word hashes; a text is
accepted where its words run through the automaton with all mandatory wording exact. Automata start
only at a template's first mandatory word pair, found for a whole block of texts at a time.

Defined results: a null text is empty; empty texts have no words and score 0; every row stands for
itself. The score is 1 where a template is accepted, else the largest share of a template's mandatory
words that was matched in a row from its start, else 0.5 for a base phrase alone (the larger counts).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tokens import Words, hash_words, pieces

# Phrases and labels of the base.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Public wordings, as templates. Labels are those of the method.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        <<opt>>and associated documentation files<</opt>> (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software""",
    "isc-text": """Permission to use, copy, modify, and<<opt>>/or<</opt>> distribute this software for any purpose with or
        without fee is hereby granted""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<any 4>> except in
        compliance with the License""",
    "gpl-header": """This program is free software<<any 2>> you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation<<any 2>> either version <<any 2>> of the License,
        or (at your option) any later version""",
    "apache-2.0": "licensed under <<opt>>the<</opt>> Apache License<<opt>>,<</opt>> <<opt>>Version<</opt>> 2.0",
    "gpl-2.0": "licensed under <<opt>>the<</opt>> GNU General Public License <<opt>>version<</opt>> 2",
    "gpl-3.0": "licensed under <<opt>>the<</opt>> GNU General Public License <<opt>>version<</opt>> 3",
    "cc-by-nc-4.0": "licensed under <<opt>>a Creative Commons<</opt>> CC BY-NC 4.0",
    "cc-by-sa-4.0": "licensed under <<opt>>a Creative Commons<</opt>> CC BY-SA 4.0",
    "cc-by-4.0": "licensed under <<opt>>a Creative Commons<</opt>> CC BY 4.0",
    "mit-notice": "<<opt>>released<</opt>> under the MIT License",
}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_words(text: str) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class Automaton:
    """States 0..n; from state k ``step[k] = word`` leads to k + 1, ``skip[k]`` lists states reached without a word,
    ``loop[k]`` is how many free words may be passed before the next step."""

    def __init__(self, label: str, markup: str):
        self.label = label
        self.step: list[int] = []
        self.skip: dict[int, int] = {}
        self.free: dict[int, int] = {}
        optional: list[bool] = []
        opened = -1
        for part in re.split(r"(<<[^>]*>>)", markup):
            if part == "<<opt>>":
                opened = len(self.step)
            elif part == "<</opt>>":
                self.skip[opened] = len(self.step)
                opened = -1
            elif m := re.fullmatch(r"<<any (\d+)>>", part):
                self.free[len(self.step)] = int(m[1])
            elif words := lower_words(part):
                self.step += hash_words(words)
                optional += [opened >= 0] * len(words)
        must = [k for k, o in enumerate(optional) if not o]
        if len(must) < 2:
            raise ValueError(f"template {label} has no mandatory pair of words")
        # The mandatory words passed on reaching each state; the first pair of mandatory words that stand together.
        self.passed = [sum(k < s for k in must) / len(must) for s in range(len(self.step) + 1)]
        self.first = must[0]
        self.pair = next(((self.step[k], self.step[k + 1], k) for k in must if k + 1 in must and k + 1 not in self.free and k not in self.skip), None)
        if self.pair is None:
            raise ValueError(f"template {label} has no two mandatory words side by side")

    def _reach(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """Add what is reached without a word. A state is (number, free words left)."""
        todo, seen = list(states), set()
        while todo:
            s = todo.pop()
            if s in seen:
                continue
            seen.add(s)
            if s[0] in self.skip and s[1] == self.free.get(s[0], 0):
                todo.append((self.skip[s[0]], self.free.get(self.skip[s[0]], 0)))
        return seen

    def run(self, words: np.ndarray, at: int) -> tuple[int, float]:
        """(end of the longest accepted run from word ``at``, or -1; share of mandatory words matched)."""
        states = self._reach({(0, self.free.get(0, 0))})
        best, share, last = -1, 0.0, len(self.step)
        for k in range(at, len(words) + 1):
            share = max([share, *(self.passed[s] for s, _ in states)])
            if any(s == last for s, _ in states):
                best = k
            if not states or k == len(words):
                break
            w, after = int(words[k]), set()
            for s, left in states:
                if s < last and self.step[s] == w:
                    after.add((s + 1, self.free.get(s + 1, 0)))
                if left and s < last:
                    after.add((s, left - 1))
            states = self._reach(after)
        return best, share


AUTOMATA: list[Automaton] = []


def automata() -> list[Automaton]:
    """The compiled templates, once in each Python worker."""
    if not AUTOMATA:
        AUTOMATA.extend(Automaton(label, markup) for label, markup in TEMPLATES.items())
    return AUTOMATA


def _begin(machine: Automaton, words: np.ndarray, pair_at: int) -> Iterator[int]:
    """Words where a run through the pair may begin: up to the wording before the pair, left out or not."""
    before = machine.pair[2]
    slack = sum(n for s, n in machine.free.items() if s <= before)
    for back in range(before + slack + 1):
        if pair_at - back >= 0:
            yield pair_at - back


def scan_batch(ids: pa.Array, texts: pa.Array) -> dict[str, list]:
    """Results for one batch of documents."""
    out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
    phrases = [(hash_words(p.split()), label) for p, label in PHRASES.items()]
    for _, data, bounds in pieces(texts):
        words = Words(data, bounds, "alnum")
        h, first = words.hash, words.first
        count = len(bounds) - 1
        base: list[list[int]] = [[] for _ in range(count)]
        base_labels: list[set[str]] = [set() for _ in range(count)]
        labels: list[set[str]] = [set() for _ in range(count)]
        score = [0.0] * count
        for phrase, label in phrases:
            n = len(phrase)
            if len(h) < n:
                continue
            places = np.flatnonzero(h[: len(h) - n + 1] == np.uint64(phrase[0]))
            for k in range(1, n):
                places = places[h[places + k] == np.uint64(phrase[k])]
            for p, doc in zip(places.tolist(), (np.searchsorted(first, places, "right") - 1).tolist(), strict=True):
                if p + n <= first[doc + 1]:
                    base[doc].append(p - int(first[doc]))
                    base_labels[doc].add(label)
                    score[doc] = max(score[doc], 0.5)
        for machine in automata():
            a, b, _ = machine.pair
            places = np.flatnonzero((h[:-1] == np.uint64(a)) & (h[1:] == np.uint64(b))) if len(h) > 1 else np.empty(0, np.int64)
            for p, doc in zip(places.tolist(), (np.searchsorted(first, places, "right") - 1).tolist(), strict=True):
                own = h[first[doc] : first[doc + 1]]
                if machine.label in labels[doc] or p + 2 > first[doc + 1]:
                    continue
                for at in _begin(machine, own, p - int(first[doc])):
                    end, share = machine.run(own, at)
                    score[doc] = max(score[doc], 1.0 if end >= 0 else share)
                    if end >= 0:
                        labels[doc].add(machine.label)
                        break
        for k in range(count):
            places = base[k]
            out["n_words"].append(int(first[k + 1] - first[k]))
            out["n_base"].append(len(places))
            out["first_word"].append(min(places) if places else None)
            out["last_word"].append(max(places) if places else None)
            out["base_labels"].append(",".join(sorted(base_labels[k])))
            out["labels"].append(",".join(sorted(base_labels[k] | labels[k])))
            out["score"].append(score[k])
    return out


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, words, places of the base phrases, labels, score. No shuffle."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = scan_batch(batch.column(0), batch.column(1))
            types = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, types.get(k, pa.int64())) for k, v in found.items()]], ["doc_id", *found]
            )

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(batches, f"doc_id {id_type}, {SCHEMA}")
