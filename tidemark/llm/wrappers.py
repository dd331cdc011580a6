"""HTML extraction with wrappers inferred from pages of the same host.

Every page is read as a stream of block-level tags and text slots. The streams of a host are aligned one
after the other into a union-free regular expression: equal parts stay, repeated siblings become ``(...)+``,
parts that only some pages have become ``(...)?``, and texts that differ become slots. Tasks fold the pages
they read (a partial wrapper per host), so only wrappers are shuffled; a host with very many pages is
folded in two steps.

On pages that mark their article (``article``, ``main``, ``role=main``), the article is the text. The others
are matched to their host's expression, which gives each of their texts a slot whatever optional parts come before it. Slots
whose text is the same on many different pages of the host, or mostly links, are left out, and so are paths of
elements of which this holds. Only hosts with such pages have rows to be joined to the pages.

Defined results: a null html is empty and has an empty text; a page without tags is one block; a null or
odd url is a host of its own (the empty one); repeated rows each keep their row.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored

TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Fixed values of HTML: elements whose content is raw text, inline elements, void elements, elements that close a like one.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTED = frozenset("p li dt dd tr td th option h2 h3 h4 h5 h6 blockquote pre".split())
# Elements, roles and words of class names that are not the article.
LEFT_OUT = frozenset("nav footer aside form button select dialog menu head figure-caption svg canvas audio video object fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
HINTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|notification|alert|menu|nav|navbar|navigation|breadcrumbs?|"
    r"sidebar|side|widget|related|recommend\w*|share|sharing|social|comments?|commentlist|replies|reply|respond|disqus|footer|header|masthead|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|search|pagination|pager|toolbar|skip)(?=$|[\s_-])",
    re.I,
)
DIFFERENT = 5  # pages that must differ before a text they share is taken as the host's own


class Block:
    __slots__ = ("at", "inside", "links", "path", "text")

    def __init__(self, path: str, text: str, links: int, inside: bool, at: int):
        self.path, self.text, self.links, self.inside, self.at = path, text, links, inside, at


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)} if source.strip(" /\n\t\r") else {}


def read(page: str) -> tuple[list[Block], list[str]]:
    """The blocks of a page outside what is left out, and its stream of block tags and slots (``#``); ``at`` is a block's place in it."""
    blocks: list[Block] = []
    stream: list[str] = []
    # Open elements: (name, path, left out, inside the article).
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]
    children: list[dict[str, int]] = [{}]  # like siblings so far, for each open element
    parts: list[str] = []
    links = anchor = 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            _, path, out, inside = stack[-1]
            stream.append("#")
            if not out:
                blocks.append(Block(path, text, min(links, len(text)), inside, len(stream) - 1))
        parts.clear()
        links = 0

    def close(to: int) -> None:
        while len(stack) > to:
            flush()
            stream.append(f"</{stack.pop()[0]}>")
            children.pop()

    at = 0
    while m := TOKEN.match(page, at):
        at = m.end()
        name = m[2]
        if name is None:
            if page[m.start()] != "<" or m.end() == m.start() + 1:
                parts.append(m[0])
                if anchor:
                    links += len(m[0])
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif name in INLINE:
            if name == "a":
                anchor = 0 if m[1] else 1
        elif m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                flush()
        elif name in RAW:
            flush()
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            flush()
            if name in CLOSES:
                k = len(stack) - 1
                while k > 0 and (stack[k][0] in CLOSES[name] or stack[k][0] in LISTED and stack[k][0] not in ("blockquote", "td", "th", "li")):
                    k -= 1
                if any(s[0] in CLOSES[name] for s in stack[k + 1 :]):
                    close(k + 1)
            given = _attributes(m[3])
            label = name + "".join(f".{c}" for c in given.get("class", "").split()[:3])
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
            role = given.get("role", "").lower()
            hinted = name not in ("html", "body", "main") and bool(HINTS.search(given.get("class", "")) or HINTS.search(given.get("id", "")))
            _, path, out, inside = stack[-1]
            own = name in ("article", "main") or role == "main" or given.get("itemprop") == "articleBody"
            out = out or hidden or hinted or name in LEFT_OUT or role in ROLES or (name == "header" and not inside)
            number = children[-1].get(label, 0)
            children[-1][label] = number + 1
            children.append({})
            # Siblings are slots of their own, unless they come in lists.
            place = f"{label}[{number}]" if number and name not in LISTED else label
            stack.append((name, f"{path}/{place}", out, inside or own))
            stream.append(f"<{label}>")
    close(1)
    flush()
    return blocks, stream


# A unit of a wrapper is a tag or slot (text) or a repeated group (tuple of units); a wrapper is a list of (unit, optional).


def fold(stream: list[str]) -> list[tuple]:
    """Make repeated siblings, and single ones of elements that come in lists, into groups."""
    return folded(stream)[0]


def folded(stream: list[str]) -> tuple[list[tuple], dict[int, tuple]]:
    """The units of a page, and for the place of each of its texts in the stream: unit, slot in the unit, numbers of the repeated siblings around it."""
    # Open elements: label, units so far, slots before each of them and in all, repeats of the last unit, and what texts stand
    # in: (place, unit, slot in it, numbers of siblings).
    open_: list[list] = [["", [], [0], 0, []]]
    for at, token in enumerate(stream):
        if token.startswith("</"):
            label, inner, firsts, _, held = open_.pop()
            name = label[1:-1].split(".")[0]
            element = (label, *inner, token)
            around = open_[-1]
            unit = ("+", element) if name in LISTED else element
            if around[1] and around[1][-1] == unit:
                around[3] += 1
            else:
                around[1].append(unit)
                around[2].append(around[2][-1] + firsts[-1])
                around[3] = 0
            number = () if name in LISTED else (around[3],)
            around[4] += [(place, len(around[1]) - 1, firsts[k] + slot, number + numbers) for place, k, slot, numbers in held]
        elif token.startswith("<"):
            open_.append([token, [], [0], 0, []])
        else:
            around = open_[-1]
            if not around[1] or around[1][-1] != "#":
                around[1].append("#")
                around[2].append(around[2][-1] + 1)
            around[4].append((at, len(around[1]) - 1, 0, ()))

    flat: list[tuple] = []
    slots: list[tuple[int, int]] = []  # unit and number in it, of all slots in order

    def unroll(units) -> None:
        for unit in units:
            if isinstance(unit, str) or unit[0] == "+":
                slots.extend((len(flat), k) for k in range(_slots(unit)))
                flat.append((unit, False))
            else:
                unroll(unit)

    _, root, firsts, _, held = open_[0]
    unroll(root)
    return flat, {place: (*slots[firsts[k] + slot], numbers) for place, k, slot, numbers in held}


def _slots(unit) -> int:
    """Slots of a unit."""
    found, units = 0, [unit]
    while units:
        if isinstance(some := units.pop(), str):
            found += some == "#"
        else:
            units += some
    return found


def align(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """Align two wrappers; what only one of them has becomes optional."""
    if a == b:
        return a
    out: list[tuple] = []
    match = SequenceMatcher(None, [u for u, _ in a], [u for u, _ in b], autojunk=False)
    for kind, a1, a2, b1, b2 in match.get_opcodes():
        if kind == "equal":
            out += [(u, x or y) for (u, x), (_, y) in zip(a[a1:a2], b[b1:b2], strict=True)]
        else:
            out += [(u, True) for u, _ in a[a1:a2]] + [(u, True) for u, _ in b[b1:b2]]
    return out


def expression(wrapper: list[tuple]) -> str:
    """The wrapper as text."""

    def show(unit) -> str:
        if isinstance(unit, str):
            return unit
        return f"({show(unit[1])})+" if unit[0] == "+" else "".join(map(show, unit))

    text, inside = "", False
    for unit, optional in wrapper:
        if optional != inside:
            text += "(" if optional else ")?"
            inside = optional
        text += show(unit)
    return text + (")?" if inside else "")


class Expression:
    """An expression that pages are matched to, all ways at once: a bit per unit says whether a page's units so far may end before it."""

    def __init__(self, wrapper: list[tuple]):
        self.units = [u for u, _ in wrapper]
        self.optional = sum(1 << k for k, (_, optional) in enumerate(wrapper) if optional)
        at: dict = {}
        for k, unit in enumerate(self.units):
            at.setdefault(unit, []).append(k)
        self.at = {unit: sum(1 << k for k in places) for unit, places in at.items()}

    def _past(self, ends: int) -> int:
        """The ends, and those that optional units lead to: a carry runs through each row of these."""
        return ends | ((self.optional + (ends & self.optional)) ^ self.optional)

    def match(self, units: list) -> list[int] | None:
        """The expression's unit for each unit of a page, the last ones possible; None if the page does not match."""
        if units == self.units:
            return list(range(len(units)))
        # Ends are kept at some units only and found again between them.
        every = isqrt(len(units)) + 1
        ends, kept = self._past(1), []
        for k, unit in enumerate(units):
            if k % every == 0:
                kept.append(ends)
            ends = self._past((ends & self.at.get(unit, 0)) << 1)
        state = len(self.units)
        if not ends >> state & 1:
            return None
        out: list[int] = []
        for first in range((len(units) - 1) // every * every, -1, -every):
            ends, could = kept[first // every], []
            for unit in units[first : first + every]:
                could.append(ends & self.at[unit])
                ends = self._past(could[-1] << 1)
            for places in reversed(could):
                state = (places & ((1 << state) - 1)).bit_length() - 1
                out.append(state)
        return out[::-1]

    def slots(self, blocks: list[Block], stream: list[str]) -> list[str] | None:
        """The expression's slot of each block; None if the page does not match, which only pages of other hosts may."""
        units, places = folded(stream)
        at = self.match([u for u, _ in units])
        if at is None:
            return None
        return [".".join(map(str, (f"#{at[unit]}", slot, *numbers))) for unit, slot, numbers in (places[b.at] for b in blocks)]


def _tuples(x):
    return tuple(_tuples(y) for y in x) if isinstance(x, list) else x


class Wrapper:
    """The wrapper of some pages of a host, with what its slots held; two of them can be merged."""

    def __init__(self, units: list[tuple], slots: dict[str, list]):
        self.units, self.slots = units, slots

    @classmethod
    def of(cls, blocks: list[Block], stream: list[str]) -> Wrapper:
        """Slots: path -> [text, or None if it varies; characters; characters in links; different pages that hold the text, up to DIFFERENT].

        Only pages that mark no article have slots.
        """
        marked = any(b.inside for b in blocks)
        return cls(fold(stream), {} if marked else _held_by(blocks, [b.path for b in blocks]))

    @classmethod
    def matched(cls, blocks: list[Block], stream: list[str], to: Expression) -> Wrapper:
        """What the slots of the host's expression hold on a page, in place of paths, and no units."""
        names = None if any(b.inside for b in blocks) else to.slots(blocks, stream)
        return cls([], {} if names is None else _held_by(blocks, names))

    def merge(self, other: Wrapper) -> Wrapper:
        slots = {k: list(v) for k, v in self.slots.items()}
        for path, (text, chars, links, pages) in other.slots.items():
            slot = slots.setdefault(path, [text, 0, 0, []])
            if slot[0] == text:
                slot[3] = sorted({*slot[3], *pages})[:DIFFERENT]
            else:
                slot[0], slot[3] = None, []
            slot[1] += chars
            slot[2] += links
        return Wrapper(align(self.units, other.units), slots)

    def dump(self) -> str:
        return json.dumps([self.units, self.slots])

    @classmethod
    def load(cls, text: str) -> Wrapper:
        units, slots = json.loads(text)
        return cls([(_tuples(u), o) for u, o in units], slots)

    def left_out(self) -> list[str]:
        """Paths of slots that are the host's own text, or mostly links."""
        return sorted(p for p, (_, chars, links, pages) in self.slots.items() if len(pages) >= DIFFERENT or 2 * links > chars)


def _held_by(blocks: list[Block], names: list[str]) -> dict[str, list]:
    """What the slots of these names hold on a page."""
    slots: dict[str, list] = {}
    page = zlib.crc32("\n".join(b.text for b in blocks).encode())
    for b, name in zip(blocks, names, strict=True):
        slot = slots.setdefault(name, [b.text, 0, 0, [page]])
        if slot[0] != b.text:
            slot[0], slot[3] = None, []
        slot[1] += len(b.text)
        slot[2] += b.links
    return slots


@lru_cache(maxsize=32)
def _expression_of(wrapper: str) -> Expression:
    return Expression(Wrapper.load(wrapper).units)


def _host(url: str) -> str:
    m = re.match(r"[a-zA-Z][-+.\w]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


HELD_HOSTS = 2_000  # wrappers that a task holds before it hands them on


def infer(pages: DataFrame) -> DataFrame:
    """One row per host: ``host``, ``wrapper`` (see :class:`Wrapper`), from all its pages."""
    return _by_host(pages.select("url", "html"), lambda page: Wrapper.of(*read(page)))


def held(pages: DataFrame) -> DataFrame:
    """One row per host: ``host``, ``wrapper``, a wrapper of what the slots of the host's expression hold. ``pages``: url, html, wrapper."""
    return _by_host(pages.select("url", "html", "wrapper"), lambda page, wrapper: Wrapper.matched(*read(page), _expression_of(wrapper)))


def _by_host(pages: DataFrame, wrapper_of) -> DataFrame:
    """The merged wrappers that ``wrapper_of`` makes of the pages' columns after ``url``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}
        salt = TaskContext.get().partitionId() % 64

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([salt] * len(held), pa.int32()), pa.array([w.dump() for w in held.values()])], ["host", "salt", "wrapper"])
            held.clear()
            return batch

        for batch in batches:
            for url, *page in zip(*batch.columns, strict=True):
                host, own = _host(url.as_py()), wrapper_of(*(x.as_py() or "" for x in page))
                held[host] = held[host].merge(own) if host in held else own
                if len(held) >= HELD_HOSTS:
                    yield out()
        if held:
            yield out()

    def merged(keys: list[str]):
        def merge(part: pd.DataFrame) -> pd.DataFrame:
            whole = reduce(Wrapper.merge, map(Wrapper.load, sorted(part["wrapper"])))
            return pd.DataFrame({**{k: [part[k].iloc[0]] for k in keys}, "wrapper": [whole.dump()]})

        return merge

    parts = pages.mapInArrow(partial, "host string, salt int, wrapper string")
    some = parts.groupBy("host", "salt").applyInPandas(merged(["host", "salt"]), "host string, salt int, wrapper string")
    return some.groupBy("host").applyInPandas(merged(["host"]), "host string, wrapper string")


def text_of(page: str, left_out: set[str], expression: Expression | None = None) -> str:
    """The text of a page without the paths, and slots of its host's expression, that are ``left_out``."""
    blocks, stream = read(page)
    if any(b.inside for b in blocks):
        kept = [b for b in blocks if b.inside]
    else:
        slots = expression and expression.slots(blocks, stream) or [b.path for b in blocks]
        kept = [b for b, slot in zip(blocks, slots, strict=True) if b.path not in left_out and slot not in left_out]
    return "\n\n".join(b.text for b in kept)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def unmarked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(Wrapper.load(w.as_py()).slots) for w in batch.column(1)], pa.bool_()))

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, w, [*Wrapper.load(w).left_out(), *(Wrapper.load(s).left_out() if s else ())]) for h, w, s in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            found = [x for x in found if x[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else ([], [], []), types, strict=True)], ["host", "wrapper", "left_out"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                text_of(p.as_py() or "", set(r.as_py() or ()), _expression_of(w.as_py()) if w.is_valid else None)
                for p, w, r in zip(*batch.columns[2:5], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], ["page_id", "url", "text", "n_chars"])

    types = [pa.string(), pa.string(), pa.list_(pa.string())]
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][-+.\w]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = pages.select("page_id", "url", "html", host.alias("host"))
    # Written first: by the size of the files Spark broadcasts the rows of the hosts or shuffles both sides, splitting large hosts.
    found = stored(infer(pages).mapInArrow(unmarked, "host string, wrapper string"), "wrappers")
    slots = held(own.join(found, "host")).select("host", F.col("wrapper").alias("held"))
    left_out = stored(found.join(slots, "host", "left").mapInArrow(rules, "host string, wrapper string, left_out array<string>"), "left-out")
    joined = own.join(left_out, "host", "left").select("page_id", "url", "html", "wrapper", "left_out")
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return joined.mapInArrow(texts, schema)
