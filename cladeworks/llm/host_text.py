"""Main text of web pages, with boilerplate found by a suffix array per host.

A page is read into blocks. Blocks inside ``article`` or ``main`` are its text; blocks of elements that
are navigation, headers, footers, sidebars, notices, adverts, forms or comments, by name, role or class,
are not. A class or id counts by its words, the last one that is not a part (``is_boiler_label``), and never on ``html``, ``body``,
``main``, ``article`` or an element whose role is main; a label that is missed is left to repetition. A page is parsed once, in
time linear in its length, whatever is left open in it, and its blocks are written to the shared folder.

For everything outside the article, the token streams of a host's pages form a suffix array in buckets: a bucket has the stretches of the host's streams whose windows of ``RUN`` tokens have one
anchor, so a host of any size is spread and equal windows meet. The suffixes of a bucket's stretches are
sorted, neighbours in that order are compared for their common prefix, and intervals of neighbours that
share ``RUN`` tokens and are of more than one page are repeated. A stretch ends where its anchor does, and
the next one overlaps it by ``RUN - 1`` tokens: a repeated string of any length is the union of its
windows, so runs that are put together on the page are the maximal ones of the whole array.

On a page without an article the blocks that are neither boilerplate by markup nor covered for the larger
part are its text. On a page with one, the article is its text, and so are such blocks outside it that
have ``RUN`` tokens at least, if the host has another page; shorter ones, and hosts of one page, give the array
nothing to judge by. Text inside the article is never removed by repetition: mirrors and shared passages
are text of their page.

Defined results: null and empty html give an empty text; character references are decoded; white space
(Unicode's) inside a block becomes one space; pages of one host that are equal to the last byte count as
one page for repetition; a null or odd url has its own empty host; unclosed elements end with their
parent; texts of any length are kept whole; an empty table gives an empty result; a
block covered for exactly half counts as boilerplate; input columns of the prefix ``_ht_`` are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from cladeworks.llm.induced_sorting import doubled_order
from cladeworks.runtime import ensure_checkpoint_dir, materialize, read_table, sized

#: Tokens that a repeated run has at least; tokens of an anchor; tokens that a task sorts at once, unless one bucket has more.
RUN, PREFIX, SHARD_TOKENS = 8, 4, 1 << 18
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
#: Share of a block's tokens that must be covered for it to count as boilerplate.
COVERED = 0.5
#: Characters of a class or id that are looked at; longer ones are no names.
MAX_LABEL = 128
#: Pages held as Python objects at once.
PAGES = 256

MAIN, OPEN, BOILER = 0, 1, 2
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>\"'<]*+)")
EVENT = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
MAIN_ROLE = re.compile(r"role\s*=\s*[\"']?main\b")
LONG_REFERENCE = re.compile(r"&#(?:([0-9]{8,})|([xX])([0-9a-fA-F]{7,}))")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}\s*+>", re.I) for name in "script style textarea title template iframe svg math".split()}
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
BOILER_TAGS = frozenset("nav header footer aside form button select dialog menu".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: A label is read as words, without those of ``PARTS`` at its end. Its last word makes it boilerplate if it is one of these, whatever comes before,
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements adsbygoogle adplaceholder sponsor sponsors sponsored sidebar sidebars nav navbar navigation navmenu breadcrumb breadcrumbs footer cookie cookies gdpr newsletter signup subscribe comment comments commenters replies disqus sharing skiplinks".split())
#: or one of these, if no other word than ``PLACES`` comes before.
PLACED_WORDS = frozenset("menu notice notices consent popup modal social share related widget widgets promo promos header masthead topbar banner topnavigation mainnavigation".split())
PLACES = frozenset("site page main global primary secondary left right top bottom cookie social post posts share sharing footer header sidebar".split())
PARTS = frozenset("area areas articles author avatar bar block body box button buttons container content count form group holder icons inner item items label link links list listing media meta overlay panel policy popup modal posts region reply respond row section slot stories text thread title toggle tools top bottom unit widget widgets wrap wrapper".split())
#: Words that turn a label into a statement about the page.
NEGATIONS = frozenset("no not non without with has have is hide hidden show open closed enabled disabled".split())
#: Of inline elements these are code, not readers' words.
CODE_WORDS = frozenset(("comment", "comments"))
#: A label in one word ends with one of these, or is one of the words above and a part.
JOINED = re.compile("(?:sidebar|navbar|navigation|breadcrumbs?|footer|comments?|newsletter|advertisement)$")
#: An element closes an open one of its own kind, unless one of these was opened in between; a paragraph closes one with only inline elements open in it.
CLOSED_BY = {"li": ("ul", "ol"), "option": ("select",), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
LABEL_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\dA-Z_]+")


@lru_cache(maxsize=1 << 16)
def is_boiler_label(label: str, inline: bool = False) -> bool:
    """Whether a class or id names boilerplate, by its words: ``reader-comments``, ``leftSidebar`` and ``ad_box`` do, ``comments-open`` and ``related-work`` do not."""
    words = [w.lower() for w in LABEL_WORDS.findall(label)]
    if not words or not NEGATIONS.isdisjoint(words):
        return False
    end = len(words)
    while end > 1 and words[end - 1] in PARTS and words[end - 1] not in BOILER_WORDS:
        end -= 1
    last, before = words[end - 1], words[: end - 1]
    if inline and last in CODE_WORDS:
        return False
    if last in BOILER_WORDS or last in PLACED_WORDS and PLACES.issuperset(before):
        return True
    whole = "".join(words)
    if whole in BOILER_WORDS or whole in PLACED_WORDS:
        return True
    glued = any(whole[i:] in PARTS and (whole[:i] in BOILER_WORDS or whole[:i] in PLACED_WORDS) for i in range(2, len(whole)))
    return len(words) == 1 and not inline and (glued or JOINED.search(whole) is not None)


def is_article(name: str, attributes: str) -> bool:
    return name in ("article", "main") or "role" in attributes and MAIN_ROLE.search(attributes) is not None


def is_boilerplate(name: str, attributes: str) -> bool:
    if name in BOILER_TAGS:
        return True
    if "=" not in attributes:
        return False
    holder = name in ("html", "body") or is_article(name, attributes)
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.strip().lower() in BOILER_ROLES:
            return True
        if key in ("class", "id") and not holder and any(is_boiler_label(label[:MAX_LABEL], name in INLINE) for label in value.split()):
            return True
    return False


def _short_reference(found: re.Match) -> str:
    """A numeric reference with its leading zeros gone; numbers beyond all code points stay beyond them."""
    decimal, x, digits = found.groups()
    return f"&#{decimal.lstrip('0')[:8] or '0'}" if decimal else f"&#{x}{digits.lstrip('0')[:8] or '0'}"


def decode(text: str) -> str:
    """Character references decoded, white space as single spaces."""
    if "&" in text:
        text = unescape(LONG_REFERENCE.sub(_short_reference, text))
    return " ".join(text.split())


class TagEnds:
    """Where tags end: at the first ``>`` outside quotes. A page is read once, however many tags are left open.

    From a place outside quotes the next event is a ``>``, which ends the tag, or a quote, which is skipped to
    its partner. Quotes from which no end is reached are remembered, and so is the first event after the last tag.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        self.dead: set[int] = set()
        self.first = -1

    def after(self, at: int) -> int:
        """The place after the end of a tag that is open at ``at``, or -1; calls go forward."""
        if at > self.last[">"]:
            return -1
        if self.first < at:
            self.first = EVENT.search(self.html, at).start()
        place, path = self.first, []
        while (mark := self.html[place]) != ">":
            path.append(place)
            close = -1 if place in self.dead or self.last[mark] == place else self.html.find(mark, place + 1)
            if close < 0 or close > self.last[">"]:
                self.dead.update(path)
                return -1
            place = EVENT.search(self.html, close + 1).start()
        return place + 1


class Elements:
    """The open elements of a page; each question is answered without a walk over them."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.flags: list[tuple[bool, bool]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.boiler = self.main = 0

    def open(self, name: str, boiler: bool, main: bool) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name not in INLINE:
            self.blocks.append(len(self.names))
        self.names.append(name)
        self.flags.append((boiler, main))
        self.boiler += boiler
        self.main += main

    def last(self, name: str) -> int:
        held = self.places.get(name)
        return held[-1] if held else -1

    def close(self, to: int) -> None:
        """Close the element at ``to`` and all in it."""
        while len(self.names) > to:
            name = self.names.pop()
            boiler, main = self.flags.pop()
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()
            self.boiler -= boiler
            self.main -= main

    def make_way(self, name: str) -> None:
        """Close what a new element of this name ends."""
        place = self.last(name)
        if name == "p":
            if place >= 0 and self.blocks[-1] == place:
                self.close(place)
        elif name in CLOSED_BY and place > max(map(self.last, CLOSED_BY[name])):
            self.close(place)


def blocks(html: str) -> list[tuple[int, str]]:
    """``(MAIN | OPEN | BOILER, text)`` of the blocks in page order; empty ones are left out. Time is linear in the page, however broken."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    held, ends = Elements(), TagEnds(html)

    def flush() -> None:
        if parts:
            text = decode("".join(parts))
            if text:
                out.append((BOILER if held.boiler else MAIN if held.main else OPEN, text))
            parts.clear()

    at = done = 0
    while True:
        at = html.find("<", at)
        if at < 0:
            parts.append(html[done:])
            break
        opened, here = at, html[at + 1 : at + 2]
        named = NAME.match(html, at + 1) if here == "/" or here.isalpha() else None
        if html.startswith("!--", at + 1):
            close = html.find("-->", at + 4)
            at = close + 3 if close >= 0 else len(html)
        elif here in ("!", "?") and here:
            at = html.find(">", at) + 1 if ends.last[">"] > at else -1
        else:
            at = ends.after(named.end()) if named else -1
        if at < 0:  # no tag: the sign is text
            at = opened + 1
            continue
        if opened > done:
            parts.append(html[done:opened])
        done = at
        if named is None:
            continue
        name = named[2].lower()
        if named[1]:
            if name not in INLINE:
                flush()
            if (place := held.last(name)) >= 0:
                held.close(place)
            continue
        if name in RAW:
            close = RAW[name].search(html, at)
            at = done = close.end() if close else len(html)
            continue
        if name in ("br", "wbr"):
            parts.append(" " if name == "br" else "")
            continue
        if name not in INLINE:
            flush()
            if held.names and held.names[-1] == "p":
                held.close(len(held.names) - 1)
        attributes = html[named.end() : at - 1]
        if name in VOID or attributes.endswith("/"):
            continue
        held.make_way(name)
        held.open(name, name in ("noscript", "head") or is_boilerplate(name, attributes), is_article(name, attributes))
    flush()
    return out


def host_of(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _tokens(text: str) -> list[str]:
    return text.lower().split()


def stretches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and anchor hash of the stretches of a token stream.

    The anchor of ``RUN`` tokens is their least-hashed gram of ``PREFIX`` tokens, the first of equals;
    neighbouring windows with one anchor are a stretch. Equal windows have equal anchors.
    """
    n = len(marks) - RUN + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = (np.lib.stride_tricks.sliding_window_view(marks, PREFIX).astype(np.uint64) * MIX).sum(axis=1)
    gram ^= gram >> np.uint64(29)
    gram *= MIX[0]
    gram ^= gram >> np.uint64(32)
    place = np.arange(n) + np.lib.stride_tricks.sliding_window_view(gram, RUN - PREFIX + 1).argmin(axis=1)
    heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return heads, np.diff(np.r_[heads, n]), gram[place[heads]].view(np.int64)


def parsed(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``pages`` without the html, with ``_ht_page`` (equal for equal pages), ``_ht_host`` and the blocks: ``_ht_kinds``, a byte each, and ``_ht_blocks``. Written once; all that follows reads it."""
    others = [c for c in pages.columns if not c.startswith("_ht_") and c != html_col]
    added = ["_ht_page", "_ht_host", "_ht_kinds", "_ht_blocks"]
    rows = pages.select(*others, F.xxhash64(F.col(url_col), F.col(html_col)).alias("_ht_page"), F.col(url_col).alias("_ht_host"), F.col(html_col).alias("_ht_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                *rest, url, html = part.columns
                found = [blocks(h or "") for h in html.to_pylist()]
                hosts = [host_of(u) for u in url.to_pylist()]
                columns = [pa.array(hosts, pa.string()), pa.array([bytes(k for k, _ in f) for f in found], pa.binary()), pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*rest, *columns], [*others, *added])

    schema = pages.select(*others).schema.add("_ht_page", "long").add("_ht_host", "string").add("_ht_kinds", "binary").add("_ht_blocks", ArrayType(StringType()))
    folder = f"{ensure_checkpoint_dir(pages.sparkSession)}/pages-{uuid.uuid4().hex}"
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(folder)
    return pages.sparkSession.read.parquet(folder)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of what is outside the article: host, anchor, page, position, tokens, and whether repetition decides on a block of the page. An empty one stands for the page itself."""
    names = ["host", "anchor", "page", "at", "tokens", "judged"]
    for batch in batches:
        for first in range(0, batch.num_rows, PAGES):
            host, anchor, page, place, run, judged = [], [], [], [], [], []
            for name, key, kinds, texts in zip(*(c.slice(first, PAGES).to_pylist() for c in batch.columns), strict=True):
                marks = np.array([xxhash.xxh32_intdigest(w) for kind, t in zip(kinds, texts, strict=True) if kind != MAIN for w in _tokens(t)], dtype=np.uint32)
                starts, windows, anchors = stretches(marks)
                raw = marks.tobytes()
                host += [name] * (len(starts) + 1)
                page += [key] * (len(starts) + 1)
                judged += [OPEN in kinds] * (len(starts) + 1)
                anchor.append(np.r_[0, anchors])
                place.append(np.r_[0, starts])
                run += [b"", *(raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), (starts + windows + RUN - 1).tolist(), strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(host), pa.array(np.concatenate(anchor)), pa.array(page, pa.int64()), pa.array(np.concatenate(place).astype(np.int32)), pa.array(run, pa.binary()), pa.array(judged)], names)


def host_stretches(rows: DataFrame) -> DataFrame:
    """Of the table that ``parsed`` gives."""
    return rows.select("_ht_host", "_ht_page", "_ht_kinds", "_ht_blocks").mapInArrow(_stretches, "host string, anchor long, page long, at int, tokens binary, judged boolean")


def common_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Symbols that each suffix of ``order`` shares with the next; ``left``: symbols up to the end of each one's stretch."""
    a, b = order[:-1], order[1:]
    most = np.minimum(left[a], left[b])
    out = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        live = live[text[a[live] + out[live]] == text[b[live] + out[live]]]
        out[live] += 1
        live = live[out[live] < most[live]]
    return out


def shared_runs(bucket: np.ndarray, tokens: list[bytes], lo: np.ndarray, hi: np.ndarray, run: int = RUN) -> list[list[tuple[int, int]]]:
    """For each stretch, the maximal ``(start, end)`` that runs of ``run`` tokens of more than one page of its bucket cover.

    The suffixes of all stretches are sorted together. Neighbours that share ``run`` tokens are one
    interval of the order; it is repeated if the pages of its suffixes are not all the same.
    """
    sizes = np.array([len(t) // 4 for t in tokens])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    owner = np.repeat(np.arange(len(tokens)), sizes + 1)
    left = ends[owner] - 1 - np.arange(ends[-1])
    text = np.zeros(ends[-1], dtype=np.uint64)  # a stretch ends with 0, tokens of different buckets differ
    text[left > 0] = (np.frombuffer(b"".join(tokens), dtype=np.uint32).astype(np.uint64) | (np.repeat(bucket, sizes).astype(np.uint64) + np.uint64(1)) << np.uint64(32))
    order = doubled_order(np.unique(text, return_inverse=True)[1], int(sizes.max()) + 1)
    order = order[left[order] >= run]
    again = np.zeros(len(text), dtype=bool)
    if len(order):
        heads = np.flatnonzero(np.r_[True, common_prefixes(text, order, left) < run])
        many = np.minimum.reduceat(lo[owner[order]], heads) < np.maximum.reduceat(hi[owner[order]], heads)
        again[order] = np.repeat(many, np.diff(np.r_[heads, len(order)]))
    turn = np.diff(np.r_[0, again.view(np.int8), 0])
    out: list[list[tuple[int, int]]] = [[] for _ in tokens]
    for a, b in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
        out[owner[a]].append((a - int(starts[owner[a]]), b - 1 + run - int(starts[owner[a]])))
    return out


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by host and anchor; whole buckets are sorted together."""
    held: list[tuple] = []
    size, bucket, last = 0, -1, None

    def shard() -> pa.RecordBatch:
        lo, hi = (np.array([r[i] for r in held], dtype=np.int64) for i in (3, 4))
        runs = shared_runs(np.array([r[5] for r in held]), [r[2] for r in held], lo, hi)
        out = [(*row[:3], found) for row, found in zip(held, runs, strict=True) if found or not row[2] and row[3] < row[4]]
        host, anchor, tokens, found = zip(*out, strict=True) if out else [[]] * 4
        pairs = pa.array([[{"a": a, "b": b} for a, b in r] for r in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
        return pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(anchor, pa.int64()), pa.array(tokens, pa.binary()), pairs], ["host", "anchor", "tokens", "runs"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != last:
                if size >= SHARD_TOKENS:
                    yield shard()
                    held, size, bucket = [], 0, -1
                bucket += 1
            held.append((*row, bucket))
            size += len(row[2]) // 4 + 1
            last = row[:2]
    if held:
        yield shard()


def repeated_runs(found: DataFrame) -> DataFrame:
    """``(host, anchor, tokens, runs)``: the stretches with runs that more than one page of the host has.

    Equal stretches are one row with their least and greatest page, summed before they are dealt, so a
    footer on every page of a large host costs each task one row. Of hosts with more than one page the
    empty stretch is a row too.
    """
    kinds = found.groupBy("host", "anchor", "tokens").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
    dealt = kinds.repartition("host", "anchor").sortWithinPartitions("host", "anchor")
    return dealt.mapInArrow(_sort_buckets, "host string, anchor long, tokens binary, runs array<struct<a:int,b:int>>")


def covered_places(found: DataFrame, runs: DataFrame) -> DataFrame:
    """``(page, places)``: the runs, in tokens outside the article, of pages that repetition decides on; no row where the host has one page only."""
    placed = found.where("judged").join(sized(runs), ["host", "anchor", "tokens"])
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b")))
    return placed.groupBy("page").agg(F.flatten(F.collect_set(moved)).alias("places"))


def page_text(found: list[tuple[int, str]], places: list[dict[str, int]] | None) -> str:
    """The text of a page from its blocks."""
    article = any(kind == MAIN for kind, _ in found)
    turns: Counter = Counter()
    for p in places or ():
        turns[p["a"]] += 1
        turns[p["b"]] -= 1
    bounds = sorted(turns)
    kept, at, depth, passed = [], 0, 0, 0
    for kind, text in found:
        if kind == MAIN:
            kept.append(text)
            continue
        n, covered = len(_tokens(text)), 0
        end, place = at + n, at
        while passed < len(bounds) and bounds[passed] < end:  # from turn to turn
            covered += (bounds[passed] - place) * (depth > 0)
            place = max(place, bounds[passed])
            depth += turns[bounds[passed]]
            passed += 1
        covered += (end - place) * (depth > 0)
        judged = not article or places is not None and n >= RUN
        if kind == OPEN and judged and covered < COVERED * n:
            kept.append(text)
        at = end
    return "\n".join(kept)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without the html and with ``_ht_text``."""
    rows = parsed(pages, url_col, html_col)
    found = materialize(host_stretches(rows))
    runs = materialize(repeated_runs(found))
    places = materialize(covered_places(found, runs))
    names = [c for c in rows.columns if not c.startswith("_ht_")]
    joined = rows.join(sized(places.toDF("_ht_page", "_ht_places")), "_ht_page", "left")
    schema = rows.select(*names).schema.add("_ht_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                text = [page_text(list(zip(k, t, strict=True)), p) for k, t, p in zip(*(c.to_pylist() for c in part.columns[-3:]), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(text, pa.string())], [*names, "_ht_text"])

    return joined.select(*names, "_ht_kinds", "_ht_blocks", "_ht_places").mapInArrow(run, schema)


def op8_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", F.col("_ht_text").alias("text"), F.length("_ht_text").cast("long").alias("n_chars"))
