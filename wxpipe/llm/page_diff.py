"""Main text of web pages: page structure and differences between neighbouring pages.

A page's text is cut into lines (one per block element). Lines inside menus, headers, footers,
sidebars, notices, adverts, forms, reader comments, scripts and styles are dropped by element and by
class. All pages are then put in order of host and URL path, those that mark an article or a main
element apart from the others, and each is paired with the neighbour whose path shares the longer
prefix. Both pages' lines are aligned by a longest common subsequence; those that are not aligned
are the page's own. Its text are the own lines, or all if none is. Where an article (or, without one,
the main element) is marked, its lines are the text, also those that the neighbour has: a repeated
paragraph is still the article's. If it holds no own line, as a teaser that all pages show, the own lines
around it belong to the text too.

Pages are compared by hashes of their lines, 64 bits each, so what is ordered and stored is small
beside the texts; these travel once, to be joined with the verdict. Ordering by range splits a host of
any size over many tasks, each of which holds three pages at a time. The first and the last page of a
range, whose neighbours lie in other ranges, are set aside and compared once all ranges are read, so
the texts do not depend on how many ranges there are.

Defined cases: null pages and pages without text give an empty text; pages without URL form one
host; pages alone on their host are not compared; pages with one URL are ordered by their key;
repeated pages share all lines and so keep them, rows alike in key, URL and page without being
compared with others; of two neighbours with paths as alike the one before counts; unclosed elements
end with the page; very long pages are parsed whole, one at a time; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import batched
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging

# Fixed values of the HTML language.
_RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript",
        "template", "svg", "math", "object", "canvas", "select")
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements and class words that hold no main text.
_SKIP = frozenset("nav header footer aside form button dialog menu head label fieldset".split())
_SKIP_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu".split()
)
_SKIP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion nav "
    "navbar navigation menu sidebar sidebars aside footer header masthead cookie cookies consent "
    "gdpr notice notices banner popup modal overlay newsletter subscribe subscription signup login "
    "breadcrumb breadcrumbs share sharing social related recommended comment comments respond "
    "replies disqus pagination pager toolbar".split()
)
_COMMENT_WORDS = frozenset("comment comments respond replies disqus".split())
_TOP = frozenset(("html", "body", "main", "article"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>" + "|".join(_RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_URL = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)")


_FIRST, _LAST = 1, 2


class Neighbour(NamedTuple):
    path: str
    lines: list[int]


@dataclass
class Page:
    id: object
    id2: object
    host: str
    path: str
    copies: int
    lines: list[int]


def _is_skipped(name: str, attrs: str) -> bool:
    if name in _SKIP:
        return True
    words: set[str] = set()
    for kind, value in _ATTR.findall(attrs):
        value = value.strip("\"'").lower()
        if kind.lower() == "role":
            if value in _SKIP_ROLES and name not in _TOP:
                return True
        else:
            words.update(re.split(r"[^a-z0-9]+", value))
    return bool(words & (_COMMENT_WORDS if name in _TOP else _SKIP_WORDS))


def parse_lines(page: str) -> tuple[list[str], list[bool], bool]:
    """All lines, which of them are in the page's article or main element, and whether it has one.

    Without one, all are.
    """
    found: list[tuple[str, list[str]]] = []  # zone and parts of each line
    line: list[str] = []
    skipping, depth = "", 0  # the skipped element, and how many of its name are open
    inside = {"article": 0, "main": 0}
    line_zone = ""

    def end_line() -> None:
        nonlocal line
        if line:
            found.append((line_zone, line))
            line = []

    def add(text: str) -> None:
        nonlocal line_zone
        zone = "article" if inside["article"] else "main" if inside["main"] else ""
        if zone != line_zone:
            end_line()
            line_zone = zone
        line.append(text)

    at = 0
    for token in _TOKEN.finditer(page):
        if not skipping and token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            if token[0][:9].upper() == "<![CDATA[" and not skipping:
                add(token[0][9:].removesuffix("]]>"))
            continue
        opening = not token["close"]
        if opening and name in inside and skipping and skipping not in ("#comments", name):
            skipping = ""  # an unclosed menu or advert does not swallow the article
        if skipping:
            if name == (skipping if skipping != "#comments" else comments_name):
                depth += 1 if opening and not token["attrs"].endswith("/") else -1
                if depth <= 0:
                    skipping = ""
            elif opening and skipping in ("p", "li") and name in _BLOCK:
                skipping = ""
            if skipping or not opening:
                continue
        if name in _BLOCK:
            end_line()
        if opening and name not in _VOID and _is_skipped(name, token["attrs"]):
            if not token["attrs"].endswith("/"):
                end_line()
                comments = name in _TOP or _COMMENT_WORDS & set(re.split(r"[^a-z]+", token["attrs"].lower()))
                skipping, depth, comments_name = "#comments" if comments else name, 1, name
            continue
        if name in inside:
            inside[name] = max(0, inside[name] + (1 if opening else -1))
    if not skipping and at < len(page):
        add(page[at:])
    end_line()
    zones = {zone for zone, _ in found}
    marked = next((z for z in ("article", "main") if z in zones), "")
    texts = ((zone, " ".join(html.unescape("".join(parts)).split())) for zone, parts in found)
    kept = [(x, not marked or zone == marked) for zone, x in texts if x]
    return [x for x, _ in kept], [inside for _, inside in kept], bool(marked)


def parse(page: str) -> tuple[list[str], bool]:
    """Lines of the page's article or main element, and True; else of its whole text."""
    lines, inside, marked = parse_lines(page)
    return [x for x, own in zip(lines, inside, strict=True) if own], marked


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``.

    Bit-parallel: a row of the usual table is one number, whose zero bits are its steps.
    """
    places: dict[int, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    raw = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    steps = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(steps)))


def common_places(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``, in linear memory."""
    shared = set(a) & set(b)
    kept = [i for i, x in enumerate(a) if x in shared]
    out: list[int] = []
    work = [(kept, [x for x in b if x in shared])]
    while work:
        left, right = work.pop()
        if not left or not right:
            continue
        if len(left) == 1:
            out += left if a[left[0]] in right else []
            continue
        middle = len(left) // 2
        head, tail = left[:middle], left[middle:]
        before = _lengths([a[i] for i in head], right)
        after = _lengths([a[i] for i in reversed(tail)], right[::-1])[::-1]
        cut = int(np.argmax(before + after))
        work += [(head, right[:cut]), (tail, right[cut:])]
    return sorted(out)


def own_lines(lines: list[int], other: list[int]) -> np.ndarray:
    """Which of ``lines`` are not aligned to a line of ``other``."""
    own = np.ones(len(lines), bool)
    own[common_places(lines, other)] = False
    return own


def without_shared(lines: list[str], other: list[str]) -> list[str]:
    """``lines`` without those aligned to a line of ``other``; all of them if none would stay."""
    numbers: dict[str, int] = {}
    a, b = ([numbers.setdefault(x, len(numbers)) for x in side] for side in (lines, other))
    return [x for x, own in zip(lines, own_lines(a, b), strict=True) if own] or lines


def main_text(lines: list[str], inside: list[bool], marked: bool, own: bytes | None) -> str:
    """The page's text, given the bits of its own lines; None if it has none or was not compared."""
    chosen = np.array(inside, bool)
    if own is not None:
        mine = np.unpackbits(np.frombuffer(own, np.uint8), count=len(lines)).astype(bool)
        if not marked:
            chosen = mine
        elif not (chosen & mine).any():
            chosen |= mine
    return " ".join(x for x, keep in zip(lines, chosen.tolist(), strict=True) if keep)


def _nearest(path: str, others: Iterable[Neighbour | None]) -> Neighbour | None:
    near = [other for other in others if other is not None]
    return max(near, key=lambda other: len(commonprefix((other.path, path))), default=None)


def _verdict(lines: list[int], path: str, others: Iterable[Neighbour | None]) -> bytes | None:
    """A bit for each line that the nearest page does not share; None if there is none."""
    near = _nearest(path, others)
    own = None if near is None else own_lines(lines, near.lines)
    return None if own is None or not own.any() else np.packbits(own).tobytes()


def _numbers(lines: bytes) -> list[int]:
    return np.frombuffer(lines, np.int64).tolist()


def _hashed(pages: DataFrame) -> DataFrame:
    """What the comparison takes of every page: its place and the hashes of its lines."""
    kind = pages.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                hosts, found = [], []
                for host, body in zip(part["host"].to_pylist(), part["html"].to_pylist(), strict=True):
                    lines, _, marked = parse_lines(body or "")
                    hosts.append(("+" if marked else "-") + host)
                    found.append(b"".join(xxhash.xxh3_64_digest(x.encode("utf-8", "surrogatepass")) for x in lines))
                places = [pa.array(hosts, pa.string()), part["path"], pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays([part["id"], part["id2"], part["key"], *places], names=names)

    schema = f"id bigint, id2 bigint, key {kind}, host string, path string, lines binary"
    names = ["id", "id2", "key", "host", "path", "lines"]
    return pages.select("id", "id2", "key", "host", "path", "html").mapInArrow(run, schema)


def _row(page: Page, before: Page | None, after: Page | None, part: int) -> tuple:
    """A page's verdict; for the first and last page of a task, what it takes to find theirs."""
    around = [
        Neighbour(p.path, p.lines) if p is not None and p.host == page.host else None
        for p in (before, after)
    ]
    edge = (_FIRST if before is None else 0) | (_LAST if after is None else 0)
    if not edge:
        own = _verdict(page.lines, page.path, around) if page.copies == 1 else None
        return (page.id, page.id2, own, *[None] * 8)
    known = around[1] if before is None else around[0]
    inner = (known.path, known.lines) if known else (None, None)
    return (page.id, page.id2, None, page.host, page.path, page.copies, part, edge, page.lines, *inner)


def _parted(ordered: DataFrame) -> DataFrame:
    """Verdicts on the pages inside each task's range, and the pages at its ends."""

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                columns = (c.to_pylist() for c in batch.slice(at, 128).columns)
                for *place, lines in zip(*columns, strict=True):
                    yield Page(*place, _numbers(lines))

    def rows(stream: Iterator[Page]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        before, page = None, next(stream, None)
        while page is not None:
            after = next(stream, None)
            yield _row(page, before, after, part)
            before, page = page, after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, lines = pa.string(), pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.binary(), text, text, pa.int64(), pa.int32(), pa.int32()]
        kinds += [lines, text, lines]
        for chunk in batched(rows(pages(batches)), 512):
            columns = [pa.array(c, t) for c, t in zip(zip(*chunk, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "id bigint, id2 bigint, own binary, host string, path string, copies bigint, part int, edge int, "
        "lines array<bigint>, inner_path string, inner_lines array<bigint>"
    )
    names = [field.split()[0] for field in schema.split(", ")]
    return ordered.select("id", "id2", "host", "path", "copies", "lines").mapInArrow(run, schema)


def _edges(parted: DataFrame) -> DataFrame:
    """Verdicts on the pages at the ends of ranges, whose other neighbour is in the next range.

    There are two such pages per range at most, so a host has no more of them than there are
    ranges, whatever its size.
    """
    order = Window.partitionBy("host").orderBy("part", "edge")
    there = F.struct("part", "path", "lines")
    ends = parted.where(F.col("edge").isNotNull())
    # A task's only page has both bits; its first (1) comes before its last (2).
    seen = ends.withColumn("before", F.lag(there).over(order)).withColumn("after", F.lead(there).over(order))

    def outer(side: str, bit: int) -> Column:
        inside = F.col("edge").bitwiseAND(F.lit(bit)) != 0
        return F.when(inside & (F.col(f"{side}.part") != F.col("part")), F.col(side))

    asked = seen.select(
        "id", "id2", "path", "copies", "lines", "edge", "inner_path", "inner_lines",
        outer("before", _FIRST).alias("before"), outer("after", _LAST).alias("after"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                lines, path = row["lines"] or [], row["path"]
                inner = None
                if row["inner_path"] is not None:
                    inner = Neighbour(row["inner_path"], row["inner_lines"])
                sides = [
                    Neighbour(row[s]["path"], row[s]["lines"]) if row[s] else None
                    for s in ("before", "after")
                ]
                # The inner neighbour stands on the side that lies in the task's own range.
                around = [sides[0] or inner, sides[1]] if row["edge"] & _LAST else [sides[0], inner]
                found.append(_verdict(lines, path, around) if row["copies"] == 1 else None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["id2"], pa.array(found, pa.binary())], names=["id", "id2", "own"]
            )

    return asked.mapInArrow(run, "id bigint, id2 bigint, own binary")


def _split(pages: DataFrame) -> DataFrame:
    """Every page with its lines, and which of them are in its marked element."""
    kind = pages.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                lines, inside, marked = zip(*(parse_lines(x or "") for x in part["html"].to_pylist()), strict=True)
                found = [pa.array(lines, pa.list_(pa.string())), pa.array(inside, pa.list_(pa.bool_()))]
                same = [part[c] for c in ("id", "id2", "key", "url")]
                yield pa.RecordBatch.from_arrays([*same, *found, pa.array(marked, pa.bool_())], names=names)

    schema = f"id bigint, id2 bigint, key {kind}, url string, lines array<string>, inside array<boolean>, marked boolean"
    names = ["id", "id2", "key", "url", "lines", "inside", "marked"]
    return pages.select("id", "id2", "key", "url", "html").mapInArrow(run, schema)


def _texts(judged: DataFrame) -> DataFrame:
    """``key``, ``url`` and text of pages with their lines and verdict."""
    kind = judged.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                columns = (part[c].to_pylist() for c in ("lines", "inside", "marked", "own"))
                texts = [main_text(*row) for row in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["key"], part["url"], pa.array(texts, pa.string())], names=["key", "url", "text"]
                )

    return judged.mapInArrow(run, f"key {kind}, url string, text string")


def extract(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``key``, ``url`` and the main text of every page."""
    address = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    narrow = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
        F.lower(F.regexp_extract(address, _URL.pattern, 1)).alias("host"),
        F.regexp_extract(address, _URL.pattern, 2).alias("path"),
    ).withColumns({
        # Two hashes name a row: what is found on its lines' hashes returns to its text by them.
        "id": F.xxhash64(F.lit(1), "key", "url", "html"),
        "id2": F.xxhash64(F.lit(2), "key", "url", "html"),
    })
    same = [F.any_value(c).alias(c) for c in ("key", "host", "path", "lines")]
    ordered = (
        _hashed(narrow).groupBy("id", "id2").agg(F.count("*").alias("copies"), *same)
        .repartitionByRange("host", "path", "key", "id", "id2")
        .sortWithinPartitions("host", "path", "key", "id", "id2")
    )
    staging = Staging(pages.sparkSession, until_exit=True)
    parted = staging.write(_parted(ordered), "pages")
    inside = parted.where(F.col("edge").isNull()).select("id", "id2", "own")
    verdicts = inside.union(_edges(parted)).where(F.col("own").isNotNull())
    # Parsed a second time: that costs less than a stored copy of all texts.
    judged = _split(narrow).join(verdicts.hint("shuffle_hash"), ["id", "id2"], "left")
    return _texts(judged).toDF(key, url, "text")
