"""Main text of web pages, with a suffix array per host (operator 10).

1. Each page is cut into blocks of text at block-level tags. A block is
   *marked* inside elements that never hold the article (nav, footer, aside,
   form, script, style, ...; a header outside the article; any element whose
   class, id or role names a menu, advert, notice, sidebar, comments, ...), and
   *main* inside an unmarked article or, failing one, main element. The body and
   main elements are never marked by such names, an article only by those of
   comments, adverts and related items. Where a page has an article or main
   element, but all of them in marked elements (a form around the page, a wrapper
   named after its sidebar, a nav that is never closed), marks from outside the
   outermost one don't count, if what it holds outweighs the unmarked text
   elsewhere; and if a page would give no text at all, only marks inside the
   innermost one count.
2. The token streams of a host's pages, all blocks in page order, are
   concatenated, with a mark of its own after each page. A suffix array,
   sorted by doubling up to ``MIN_RUN`` tokens, brings equal runs together;
   runs that occur on ``MIN_PAGES`` distinct pages or more cover their tokens. (A
   longer repeated run is covered by its runs of ``MIN_RUN`` tokens, so nothing is
   gained by sorting further.)
3. A page with main blocks gives these whole, however often its host repeats
   them: republished articles are text, not boilerplate. Of a page without
   main blocks, the tokens of unmarked blocks stay that aren't covered.

The pages of a host meet in groups of about ``GROUP_PAGES``, dealt by row
number, so neither a large host nor many copies of a page are too much for a task. On a host of several groups
the runs are counted across them: each page gives the 64-bit hashes of its
runs, summed up per run and group as the least and greatest hash of the
streams that hold it. Runs whose streams differ over all groups are given back
to the groups and count as repeated there. Hosts all of whose pages have main
blocks (or no unmarked one) skip that, as no page of theirs asks. Copies of
one whole stream count as one page.

Null and empty html gives an empty text. Unclosed tags, comments and scripts
run to the end of the page, as in a browser. Repeated rows are answered alike
and stay; a null url has the empty host.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, table, word_hashes
from tablefit.llm.url_filter import host_of

MIN_RUN = 8
#: Across groups, "two" is told by two streams that differ.
MIN_PAGES = 2
GROUP_PAGES = 128
#: Hosts, and characters of their names, that are broadcast at most; more are joined by a shuffle.
BROADCAST_HOSTS, BROADCAST_CHARS = 200_000, 16_000_000

# Element names of HTML.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg"}
NEVER = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp",
          "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banners?|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|"
    r"cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|search|share|social|related|comments?|respond|disqus|replies|"
    r"contentinfo|complementary|widget)(?=$|[\s_-])",
    re.I,
)
#: Names that mark an article itself, and such of reader comments.
NAMED_ARTICLE = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|related|comments?|respond|disqus|replies)(?=$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|respond|disqus|replies)(?=$|[\s_-])", re.I)
_TAG = re.compile(r"<(?:!--(.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[!?][^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

MAIN, OPEN, MARKED = 2, 1, 0

_TEXTS = "page_id long, url string, text string"
_RUNS = "place long, part long, run long, stream long"


class _Place(NamedTuple):
    """Where a block stands: what marks it, counted from the top (``marked``), from
    the outermost and the innermost article or main element, whether in reader
    comments; and 2 in an article, 1 in a main element, unmarked ones or any."""

    name: str = ""
    marked: bool = False
    level: int = 0
    outer: bool = False
    inner: bool = False
    comments: bool = False
    any_level: int = 0


def _enter(at: _Place, name: str, names: list[str]) -> _Place:
    holds = name in ("article", "main")
    pattern = NAMED_ARTICLE if name == "article" else None if name in ("main", "body") else NAMED
    named = pattern is not None and any(pattern.search(n) for n in names)
    comments = named and any(COMMENTS.search(n) for n in names)
    here = named or name in NEVER
    marked = at.marked or here or (name == "header" and at.level < 2)
    inside = here or (name == "header" and at.any_level < 2)
    level = 2 if name == "article" else 1 if name == "main" else 0
    return _Place(
        name, marked, max(at.level, 0 if marked else level),
        (False if holds and not at.any_level else at.outer or inside) or (holds and comments),
        False if holds else at.inner or inside,
        at.comments or comments, max(at.any_level, level),
    )


def blocks_of(page: str | None) -> list[tuple[str, int]]:
    """``(text, kind)`` of the page's non-empty blocks in order; kind is MAIN
    inside an article (or main element, if no article has text), MARKED or OPEN."""
    top = _Place()
    stack: list[_Place] = []
    found: list[tuple[str, _Place]] = []
    held: list[str] = []
    here, page = top, page or ""

    def close() -> None:
        text = "".join(held)
        held.clear()
        if "&" in text:
            text = entities.unescape(text)
        text = " ".join(text.split())
        if text:
            found.append((text, here))

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            held.append(page[at:])
            break
        m = _TAG.match(page, lt)
        if m is None:
            held.append(page[at : lt + 1])
            at = lt + 1
            continue
        held.append(page[at:lt])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            close()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    here = stack[-1] if stack else top
                    break
            continue
        if name in VOID or name == "html":
            continue
        if stack and stack[-1].name == "head" and name not in RAW:
            stack.pop()
            here = stack[-1] if stack else top
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
            close()
            at = size if end is None else end.start()
            if end is not None:
                at = page.find(">", at) + 1 or size
            continue
        if m[4].endswith("/") and name not in INLINE:
            continue
        names = [a or b or c for a, b, c in _ATTRIBUTE.findall(m[4])] if "=" in m[4] else []
        if name in INLINE:
            if not any(NAMED.search(n) for n in names):
                continue
            close()
        here = _enter(here, name, names)
        stack.append(here)
    close()
    return list(zip((text for text, _ in found), _kinds(found)))


def _kinds(found: list[tuple[str, _Place]]) -> list[int]:
    """MAIN, OPEN or MARKED for each block; see the module's first step."""
    def kinds(level_of, bad_of) -> list[int]:
        best = max((level_of(p) for _, p in found if not bad_of(p)), default=0)
        return [MARKED if bad_of(p) else MAIN if best and level_of(p) == best else OPEN for _, p in found]

    strict = kinds(lambda p: p.level, lambda p: p.marked)
    if MAIN in strict or not any(p.any_level for _, p in found):
        return strict
    size = lambda which: sum(len(text) for (text, _), k in zip(found, which) if k == MAIN)
    relaxed = kinds(lambda p: p.any_level, lambda p: (p.outer or p.comments) if p.any_level else p.marked)
    opened = sum(len(text) for (text, p), k in zip(found, strict) if k == OPEN and not p.any_level)
    if size(relaxed) > opened:
        return relaxed
    if OPEN not in strict:
        return kinds(lambda p: p.any_level, lambda p: p.inner if p.any_level else p.marked)
    return strict


def covered_by_repeats(streams: list[np.ndarray], min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> list[np.ndarray]:
    """Of each page's token stream, which tokens lie in a run of ``min_run``
    or more that ``min_pages`` distinct pages hold."""
    lengths = np.array([len(s) + 1 for s in streams])
    if not len(streams):
        return []
    text = np.concatenate([np.append(s, 0) for s in streams]).astype(np.int64)
    page = np.repeat(np.arange(len(streams)), lengths)
    ends = np.cumsum(lengths) - 1
    _, rank = np.unique(text, return_inverse=True)
    rank = rank + len(streams)
    rank[ends] = np.arange(len(streams))  # each page ends in a mark of its own
    step = 1
    while step < min_run:
        reach = min(step, min_run - step)  # of the last doubling, only what is lacking
        later = np.zeros(len(rank), np.int64)
        later[:-reach] = rank[reach:] + 1
        _, rank = np.unique(rank * (int(rank.max()) + 2) + later, return_inverse=True)
        step += reach
    order = np.argsort(rank * len(streams) + page)  # the suffix array, equal runs by page
    runs = np.cumsum(np.diff(rank[order], prepend=-1) != 0) - 1
    fresh = (np.diff(runs, prepend=-1) != 0) | (np.diff(page[order], prepend=-1) != 0)
    pages = np.bincount(runs, weights=fresh)
    starts = order[pages[runs] >= min_pages]
    marks = np.zeros(len(text) + min_run + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + min_run, -1)
    inside = np.cumsum(marks)[: len(text)] > 0
    return [inside[e - n + 1 : e] for e, n in zip(ends.tolist(), lengths.tolist())]


def _streams(pages: list[tuple[str, ...]]) -> list[np.ndarray]:
    numbers: dict[str, int] = {}
    return [np.array([numbers.setdefault(t, len(numbers) + 1) for b in page for t in b.split(" ")], np.int64) for page in pages]


def run_hashes(page: list[str] | tuple[str, ...], place: int, min_run: int = MIN_RUN) -> np.ndarray:
    """64-bit hashes of the page's runs of ``min_run`` tokens on the host numbered ``place``, by first token."""
    h = word_hashes([t.encode("utf-8", "surrogatepass") for b in page for t in b.split(" ")])
    n = max(len(h) - min_run + 1, 0)
    runs = np.full(n, place, np.uint64)
    for j in range(min_run):
        runs *= np.uint64(0xFF51AFD7ED558CCD)
        runs ^= runs >> np.uint64(32)
        runs += h[j : j + n]
    runs ^= runs >> np.uint64(33)
    runs *= np.uint64(0xC4CEB9FE1A85EC53)
    runs ^= runs >> np.uint64(29)
    return runs.view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's distinct runs with the hash of its stream."""
    for batch in batches:
        for place, part, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            runs = np.unique(run_hashes(blocks, place))
            stream = _stream(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(runs), x, np.int64)) for x in (place, part)] + [pa.array(runs), pa.array(np.full(len(runs), stream, np.int64))],
                ["place", "part", "run", "stream"],
            )


def _stream(blocks: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(blocks).encode("utf-8", "surrogatepass")) - (1 << 63)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [blocks_of(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([[t for t, _ in p] for p in pages], pa.list_(pa.string())),
             pa.array([[k for _, k in p] for p in pages], pa.list_(pa.int8()))],
            ["page_id", "url", "blocks", "kinds"],
        )


def _cover(inside: np.ndarray, page: list[str] | tuple[str, ...], place: int, runs: np.ndarray) -> None:
    """Marks the tokens of the page that lie in one of ``runs``."""
    for start in np.flatnonzero(np.isin(run_hashes(page, place), runs)):
        inside[start : start + MIN_RUN] = True


def _kept(group: pd.DataFrame, repeated: pd.DataFrame | None = None) -> pd.DataFrame:
    """The texts of one group of a host's pages; ``repeated`` has the runs that other groups repeat."""
    pages = [tuple(b) for b in group["blocks"]]
    first: dict[tuple[str, ...], int] = {}
    place = [first.setdefault(p, len(first)) for p in pages]
    covered = covered_by_repeats(_streams(list(first)))
    host = int(group["place"].iloc[0])
    if repeated is not None and len(repeated):
        for page, inside in zip(first, covered):
            _cover(inside, page, host, repeated["run"].to_numpy(np.int64))
    texts = []
    for blocks, kinds, i in zip(pages, group["kinds"], place):
        tokens = [t for b in blocks for t in b.split(" ")]
        of = np.repeat(np.array(kinds, np.int8), [b.count(" ") + 1 for b in blocks])
        drop = of != MAIN if MAIN in kinds else covered[i] | (of != OPEN)
        texts.append(" ".join(t for t, bad in zip(tokens, drop) if not bad))
    return pd.DataFrame({"page_id": group["page_id"].astype("Int64"), "url": group["url"], "text": texts})


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of each row of ``pages(page_id, url, html)``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    blocks = rows.mapInArrow(_blocks, "page_id long, url string, blocks array<string>, kinds array<tinyint>").withColumn("of_host", host_of("url"))
    has = lambda kind: F.array_contains("kinds", F.lit(kind).cast("tinyint"))
    hosts = blocks.groupBy(F.col("of_host").alias("host")).agg(F.count("*").alias("n"), F.max(has(OPEN) & ~has(MAIN)).alias("asks"))
    hosts = materialize(hosts.withColumn("place", F.monotonically_increasing_id()))
    asked = not hosts.where(F.col("asks") & (F.col("n") > GROUP_PAGES)).isEmpty()
    size = hosts.agg(F.count("*").alias("n"), F.sum(F.length("host")).alias("chars")).first()
    if size["n"] <= BROADCAST_HOSTS and (size["chars"] or 0) <= BROADCAST_CHARS:
        hosts = F.broadcast(hosts)
    dealt = blocks.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())).join(hosts, blocks["of_host"] == hosts["host"])
    dealt = dealt.withColumn("part", F.pmod("deal", F.ceil(F.col("n") / GROUP_PAGES)))
    groups = dealt.select("place", "part", "page_id", "url", "blocks", "kinds").groupBy("place", "part")
    if not asked:
        return groups.applyInPandas(lambda group: _kept(group), _TEXTS)
    runs = dealt.where(F.col("asks") & (F.col("n") > GROUP_PAGES)).select("place", "part", "blocks").mapInArrow(_runs, _RUNS)
    held = materialize(runs.groupBy("run", "place", "part").agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")))
    repeated = held.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select(F.col("run").alias("again"))
    # What a group repeats within itself its suffix array finds.
    lacking = held.where("lo = hi").join(repeated, F.col("run") == F.col("again"), "left_semi").select(
        *[F.col(c).alias(c) for c in ("place", "part", "run")]
    )
    return groups.cogroup(lacking.groupBy("place", "part")).applyInPandas(lambda group, again: _kept(group, again), _TEXTS)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
