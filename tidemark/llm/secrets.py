"""Secret scans with a trigram index.

From the parse of each rule's regular expression a Boolean query over trigrams is derived: alternatives
are joined by OR, the trigrams of text that must stand there by AND. The index is partitioned by document,
so that postings intersect where the text is and nothing is shuffled: each row carries one bit for each trigram that
any query mentions. Only documents whose bits satisfy a rule's query are verified with the regular
expression itself; a rule without mandatory trigrams scans every document. Spark functions only.

Defined results: a null text is empty; spans count code points, the end is exclusive; each row stands for
itself, so repeated rows and null ids pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 62
LIMIT = 64  # strings of an exact set; a node with more is taken as unknown text


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same in Java and Python. A match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),  # the runs of AKIA[A-Z0-9]+ with 20 and more characters
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ with 24 and more
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("urlauth", r"[a-z]{3,16}://[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!$-]{3,64}@"),
)

# A query is None (anything may match), ("tri", t), ("and", [queries]) or ("or", [queries]).
Query = tuple | None


def _all(parts: list[Query]) -> Query:
    kept = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def _any(parts: list[Query]) -> Query:
    if any(p is None for p in parts):
        return None
    kept = list(dict.fromkeys(parts))
    return kept[0] if len(kept) == 1 else ("or", tuple(kept))


def _of_strings(strings: set[str]) -> Query:
    return _any([_all([("tri", s[k : k + 3]) for k in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(op, value) -> set[str] | None:
    """The texts that a node stands for, lower-cased, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN":
        found: set[str] = set()
        for kind, v in value:
            if str(kind) == "LITERAL":
                found.add(chr(v).lower())
            elif str(kind) == "RANGE" and v[1] - v[0] < 8:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if name == "MAX_REPEAT":
        low, high, body = value
        if str(high) == "MAXREPEAT" or high > 8:
            return None
        one, out, power = _exact_of(body), set(), {""}
        if one is None:
            return None
        for n in range(high + 1):
            out |= power if n >= low else set()
            power = {a + b for a in power for b in one}
            if len(power) > LIMIT:
                return None
        return out if len(out) <= LIMIT else None
    if name == "BRANCH":
        sets = [_exact_of(b) for b in value[1]]
        return None if any(s is None for s in sets) else set().union(*sets)
    if name == "SUBPATTERN":
        return _exact_of(value[3])
    return None


def _exact_of(nodes) -> set[str] | None:
    texts = {""}
    for op, value in nodes:
        one = _exact(op, value)
        if one is None:
            return None
        texts = {a + b for a in texts for b in one}
        if len(texts) > LIMIT:
            return None
    return texts


def _query(nodes) -> Query:
    parts: list[Query] = []
    run: set[str] = {""}  # texts that end where we stand

    def close() -> None:
        nonlocal run
        parts.append(_of_strings(run))
        run = {""}

    for op, value in nodes:
        one = _exact(op, value)
        if one is not None and len(run) * len(one) <= LIMIT:
            longer = {a + b for a in run for b in one}
            if _of_strings(run) is not None and _of_strings(longer) is None:
                close()
                continue
            run = longer
            continue
        close()
        if one is not None:
            run = one
        elif str(op) == "SUBPATTERN":
            parts.append(_query(value[3]))
        elif str(op) == "BRANCH":
            parts.append(_any([_query(b) for b in value[1]]))
        elif str(op) == "MAX_REPEAT" and value[0] > 0:
            parts.append(_query(value[2]))
    close()
    return _all(parts)


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match satisfies, over the lower-cased text."""
    return _query(_parser.parse(pattern))


def trigrams(query: Query) -> list[str]:
    if query is None:
        return []
    if query[0] == "tri":
        return [query[1]]
    return list(dict.fromkeys(t for q in query[1] for t in trigrams(q)))


def index(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", post: str = "__post") -> tuple[DataFrame, dict[str, int]]:
    """Add ``post``: an array of bit sets of the trigrams that the rules' queries mention. Also the trigrams' numbers."""
    numbers = {t: k for k, t in enumerate(dict.fromkeys(t for r in rules for t in trigrams(trigram_query(r.pattern))))}
    low = docs.withColumn("__low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    bits = [F.when(F.contains("__low", F.lit(t)), F.lit(1 << (k % BITS))).otherwise(F.lit(0)).cast("bigint") for t, k in numbers.items()]
    sets = [reduce(lambda a, b: a.bitwiseOR(b), bits[at : at + BITS]) for at in range(0, len(bits), BITS)]
    return low.withColumn(post, F.array(*sets) if sets else F.array(F.lit(0).cast("bigint"))).drop("__low"), numbers


def satisfied(query: Query, numbers: dict[str, int], post: str = "__post") -> Column:
    """Whether the postings of a document intersect as the query demands."""
    if query is None:
        return F.lit(True)
    if query[0] == "or":
        return reduce(lambda a, b: a | b, [satisfied(q, numbers, post) for q in query[1]])
    masks: dict[int, int] = {}
    rest = []
    for q in [query] if query[0] == "tri" else query[1]:
        if q[0] == "tri":
            word, bit = divmod(numbers[q[1]], BITS)
            masks[word] = masks.get(word, 0) | 1 << bit
        else:
            rest.append(satisfied(q, numbers, post))
    parts = [F.col(post)[word].bitwiseAND(F.lit(mask)) == F.lit(mask) for word, mask in masks.items()]
    return reduce(lambda a, b: a & b, parts + rest)


SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def _spans(rule: Rule, rank: int, text: Column) -> Column:
    """Matches with their places: the pieces between the matches and the matches add up to positions."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    # The last piece has no match after it: arrays_zip gives it a null length.
    placed = F.aggregate(
        F.arrays_zip(between.alias("gap"), matches.alias("size"), kept.alias("kept")),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("found")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.coalesce(x["size"], F.lit(0))).alias("at"),
            F.when(
                x["kept"],
                F.concat(
                    a["found"],
                    F.array(
                        F.struct(
                            (a["at"] + x["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            (a["at"] + x["gap"] + x["size"]).alias("end"),
                            F.lit(rule.kind).alias("kind"),
                        )
                    ),
                ),
            )
            .otherwise(a["found"])
            .alias("found"),
        ),
        lambda a: a["found"],
    )
    return placed


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: all spans as (start, rank, end, kind), by start and then in the order of the rules."""
    indexed, numbers = index(docs, rules, text)
    value = F.coalesce(F.col(text), F.lit(""))
    found = [
        F.when(satisfied(trigram_query(r.pattern), numbers) & F.regexp_like(value, F.lit(r.pattern)), _spans(r, k, value)).otherwise(F.array().cast(SPAN))
        for k, r in enumerate(rules)
    ]
    return indexed.withColumn(out, F.array_sort(F.concat(*found))).drop("__post")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of their spans, and all spans."""
    kinds = [r.kind for r in BASE]
    found = scan(docs.select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [F.size(F.filter("spans", _is(k))).cast("bigint").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
