"""Packing of tokenised documents into fixed-length sequences.

A document's ids are cut into pieces of the sequence length; whole pieces are sequences of their own. The
rests are dealt at random into groups of about ``GROUP`` and each group is packed on its own by first-fit
decreasing: a tournament tree over the bins' free room finds the leftmost bin that fits in logarithmic time.

Defined results: a null text is empty and is the end token alone; every row is a document of its own, so
repeated rows and null ids are packed like others; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

END = 1
LENGTH = 2048
GROUP = 2048
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary and merges as byte_bpe_50k.json, as ranks
VOCABULARY = "byte_bpe_50k.json"
# Unicode's White_Space.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUN = re.compile(f"(?<=[{_WHITE}])(?=[{_WHITE}][^{_WHITE}])")
_DOUBLE = re.compile(f"[{_WHITE}][{_WHITE}]")
_ENCODERS: dict = {}


class Encoder:
    """The ids of a text.

    Tokens added to the vocabulary beside its merges stand for themselves wherever a text holds them, before all other rules.

    The vocabulary's pattern has one look-ahead: of a run of white space before other text, the last
    character goes its own way. Cut there, texts can be matched without the look-ahead, at twice the speed.
    """

    def __init__(self, ranks: str, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("the vocabulary's added tokens are not plain ones")
        self._added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._around_added = re.compile(f"({'|'.join(longest_first)})") if added else None
        pattern = public_tokenizers.PATTERN
        plain = pattern.replace(r"|\s+(?!\S)|\s+", r"|\s+")
        if "(?" in plain:
            raise ValueError("the vocabulary's pattern is not the expected one")
        self._encoding = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=merges, special_tokens={})

    def _plain(self, text: str) -> list[int]:
        if _DOUBLE.search(text):
            return [i for part in _RUN.split(text) for i in self._encoding.encode_ordinary(part)]
        return self._encoding.encode_ordinary(text)

    def ids(self, text: str) -> np.ndarray:
        parts = self._around_added.split(text) if self._around_added else [text]
        if len(parts) == 1:
            return np.array([*self._plain(text), END], "<u4")
        found = [i for part in parts if part for i in ([self._added[part]] if part in self._added else self._plain(part))]
        return np.array([*found, END], "<u4")


def encoder(ranks: str = RANKS) -> Encoder:
    """One encoder in each Python worker."""
    if ranks not in _ENCODERS:
        _ENCODERS[ranks] = Encoder(ranks)
    return _ENCODERS[ranks]


def first_fit_decreasing(lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece. Pieces are placed from long to short, equal ones in the given order."""
    order = sorted(range(len(lengths)), key=lambda k: (-lengths[k], k))
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    free = [room] * (2 * leaves)  # free[n]: the most room of a bin below node n
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for k in order:
        size, node = lengths[k], 1
        if size > room:
            raise ValueError(f"a piece of {size} does not fit {room}")
        while node < leaves:
            node = 2 * node if free[2 * node] >= size else 2 * node + 1
        placed[k] = (node - leaves, room - free[node])
        free[node] -= size
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return placed


def cut(docs: DataFrame, doc_id: str, text: str, length: int, groups: int, ranks: str) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, and sequence_id of whole pieces or bin group of rests."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks)
        task, row, whole = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("at", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "bin_group", "place")}
            for k, value in enumerate(batch.column(1)):
                ids = encode.ids(value.as_py() or "")
                row += 1
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    full = len(part) == length
                    whole += full
                    # Place in the input decides the group: repeated rows spread, and a task run again deals alike.
                    shuffled = zlib.crc32(f"{task}:{row}".encode())
                    line = (k, start, len(part), zlib.crc32(part.tobytes()), len(ids), -(task << 32) - whole if full else None, None if full else shuffled % groups, (task << 32) + row)
                    for column, x in zip(out.values(), line, strict=True):
                        column.append(x)
            own = batch.column(0).take(pa.array(out.pop("at"), pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *[pa.array(v, pa.int64()) for v in out.values()]], ["doc_id", *out])

    longs = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, bin_group long, place long"
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(pieces, f"doc_id {id_type}, {longs}")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP, ranks: str = RANKS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Whole pieces have negative sequence ids, the bins of the groups ids from 0 on.
    """
    groups = max(1, -(-docs.count() // group))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # The ids are wanted once: whole pieces and rests come from one pass, and only the rests are shuffled.
    found = stored(cut(docs, doc_id, text, length, groups, ranks), "pieces")
    id_type = found.schema["doc_id"].dataType.simpleString()

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place", ignore_index=True)
        bins = first_fit_decreasing([int(x) for x in part["length"]], length)
        part["sequence_id"] = (int(part["bin_group"].iloc[0]) << 32) + np.array([b for b, _ in bins], np.int64)
        part["offset"] = np.array([o for _, o in bins], np.int64)
        return part[columns]

    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rests = found.where("bin_group is not null").groupBy("bin_group").applyInPandas(fill, schema)
    whole = found.where("bin_group is null").withColumn("offset", F.lit(0).cast("bigint")).select(columns)
    return whole.unionByName(rests)
