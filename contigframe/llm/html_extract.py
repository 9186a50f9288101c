"""Main text of web pages by site style trees.

Pages are read into block elements (``dom``). All pages of a host are merged into one tree: an element node stands at a place of its
parent's style, and a style is the row of kinds of children, of which equal neighbours count once. A node's importance is an
entropy. For an element it is that of its styles over the pages that have it, mixed with the importance of what they hold; for text it is
one less the mean entropy of the texts over the pages: texts that are on every page weigh nothing, those of one page weigh all. A page's
branches of low importance go, and so do those that say themselves that they are aside (``dom.set_aside``), as many hosts have
too few pages to tell. Of what is left an article element is the text, or else all but menus.

The tree is never held as a whole. Pages give rows of their nodes, styles and texts, which aggregates merge by key; a page that repeats another's
text isn't counted again, and nodes of a single page, whose importance is one, go at once. Importance then climbs a level of depth at a
time. Keys of low importance are broadcast if they are few, and else meet their hosts' pages in a salted join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import dom, tokens, util

#: Levels of a tree; what lies deeper is text of the element at the last level.
DEPTH = 24
#: What an element's own styles weigh less for each style it has, and the importance below which a branch goes.
DECAY, LOW = 0.9, 0.3
#: Pages, and part of its host's pages, that a branch must be on: fewer may be near copies of one another.
PAGES, PART = 4, 0.1
#: A branch that holds more than this part of a page's remaining text is the page itself.
MOST = 0.5
#: Part of the remaining text that an article or main element must hold to be the whole text.
ARTICLE = 0.25
#: Outside of articles an element of so many links, and more of its text in them, is a menu.
LINKS, LINKED = 3, 0.66
#: Keys that may be broadcast (8 bytes each).
FEW_KEYS = 1_000_000
NODE, STYLE, TEXT = 0, 1, 2
_HOST = re.compile(r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", re.I)
_COPYRIGHT = re.compile(r"^(?:©|\(c\)|copyright\b)", re.I)
_MENU = frozenset("ul ol dl menu div table td tr section p".split())


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text, seed)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def host_key(url: str | None) -> int | None:
    """A number for the page's host; none if the address has none."""
    m = _HOST.match(url or "")
    return _hash(m[1].lower()) if m else None


def tree(page: dom.Page, keep: list[bool], host: int) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """Rows (kind, key, other, depth) of a page's branches that have kept text, and the key of each element (0 where it is in no branch) and block.

    NODE rows have the style above as other, STYLE rows the style, TEXT rows the text's hash.
    """
    size = page.sums(keep)
    rows, element, block = [], [0] * len(page.tags), [0] * len(page.blocks)
    element[0], todo = host, [(0, host, 0, 0)]
    while todo:
        i, key, up, depth = todo.pop()
        rows.append((NODE, key, up, depth))
        label, at, kinds, children = None, -1, [], []
        if depth >= DEPTH:
            kinds, children = ["#text"], [(0, "#text", ~b) for b in _below(page, i) if keep[b]]
        else:
            for c in page.children[i]:
                if (not keep[~c]) if c < 0 else (not size[c]):
                    continue
                name = page.labels[c] if c >= 0 else "#text"
                if name != label:
                    label, at = name, at + 1
                    kinds.append(name)
                children.append((at, name, c))
        style = _hash("\0".join(kinds), key)
        rows.append((STYLE, key, style, depth))
        for at, name, c in children:
            own = _hash(f"{at} {name}", style)
            if c >= 0:
                element[c] = own
                todo.append((c, own, style, depth + 1))
            else:
                block[~c] = own
                rows.append((NODE, own, style, depth + 1))
                rows.append((TEXT, own, _hash(page.blocks[~c][1]), depth + 1))
    return rows, element, block


def _below(page: dom.Page, i: int) -> list[int]:
    out, todo = [], [i]
    while todo:
        for c in page.children[todo.pop()]:
            if c < 0:
                out.append(~c)
            else:
                todo.append(c)
    return sorted(out)


def main_text(page: dom.Page, shown: list[bool], keep: list[bool], low: set[int], host: int | None) -> str:
    """The page's blocks that are kept, without the branches whose key is in ``low``, in the article if there is one. Headings of an article stay."""
    size = page.sums(keep)
    inside = _within(page, _articles(page, size))
    if low and host is not None:
        _, element, block = tree(page, shown, host)
        held: dict[int, int] = {}  # kept text below each key, at all its places
        for key, n in zip((*element, *block), (*size, *(len(b[1]) if k else 0 for k, b in zip(keep, page.blocks, strict=True))), strict=True):
            held[key] = held.get(key, 0) + n
        goes = {k for k in low if held.get(k, 0) <= MOST * size[0]}
        gone = [False] * len(element)
        for i in range(1, len(gone)):
            gone[i] = gone[page.parents[i]] or (element[i] in goes and not (inside[i] and page.tags[i] in dom.HEADINGS))
        heading = [inside[i] and page.tags[i] in dom.HEADINGS for i in range(len(gone))]
        keep = [k and not gone[b[0]] and (key not in goes or heading[b[0]]) for k, b, key in zip(keep, page.blocks, block, strict=True)]
    if any(inside):
        keep = [k and inside[b[0]] for k, b in zip(keep, page.blocks, strict=True)]
    else:
        keep = _without_menus(page, keep)
    return "\n".join(b[1] for k, b in zip(keep, page.blocks, strict=True) if k)


def _within(page: dom.Page, roots: set[int]) -> list[bool]:
    out = [False] * len(page.tags)
    for i in range(1, len(out)):
        out[i] = out[page.parents[i]] or i in roots
    return out


def _articles(page: dom.Page, size: list[int]) -> set[int]:
    """The outermost elements that say they are the page's content, if they hold enough of it: articles, or else main elements."""
    for tags in (("article",), ("main",), None):
        found: set[int] = set()
        covered = [False] * len(page.tags)
        for i in range(1, len(page.tags)):
            covered[i] = covered[page.parents[i]]
            if not covered[i] and size[i] and page.content[i] and (tags is None or page.tags[i] in tags):
                covered[i] = True
                found.add(i)
        if found and sum(size[i] for i in found) >= ARTICLE * size[0]:
            return found
    return set()


def _without_menus(page: dom.Page, keep: list[bool]) -> list[bool]:
    size, linked, links = page.sums(keep), page.sums(keep, 2), page.sums(keep, 3)
    menu = [False] * len(page.tags)
    for i in range(1, len(menu)):
        menu[i] = menu[page.parents[i]] or (page.tags[i] in _MENU and links[i] >= LINKS and linked[i] > LINKED * size[i] and size[i] <= MOST * size[0])
    return [k and not menu[b[0]] and not (_COPYRIGHT.match(b[1]) and len(b[1]) <= 200) for k, b in zip(keep, page.blocks, strict=True)]


def _read(source: str) -> tuple[dom.Page, list[bool], list[bool]]:
    """(page, blocks that are shown, those that aren't aside)."""
    page = dom.read(source)
    shown, aside = dom.unseen(page), dom.set_aside(page)
    return page, [not shown[b[0]] for b in page.blocks], [not aside[b[0]] for b in page.blocks]


def branches(pages: DataFrame) -> DataFrame:
    """(host, sign, rows): a page's host, a hash of its text that isn't aside, and its rows of the style tree. Pages without a host or text have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "html"):
                hosts, signs, sizes, flat = [], [], [0], []
                for url, source in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
                    host = host_key(url)
                    if host is None or not source:
                        continue
                    page, shown, keep = _read(source)
                    if not any(shown):
                        continue
                    counts: dict[tuple[int, int, int, int], int] = {}
                    for row in tree(page, shown, host)[0]:
                        counts[row] = counts.get(row, 0) + 1
                    hosts.append(_signed(host))
                    signs.append(_signed(_hash("\n".join(b[1] for k, b in zip(keep, page.blocks, strict=True) if k))))
                    flat += [(*row, n) for row, n in counts.items()]
                    sizes.append(len(flat))
                if hosts:
                    kind, key, other, depth, n = zip(*flat, strict=True)
                    long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                    fields = [pa.array(kind, pa.int32()), long(key), long(other), pa.array(depth, pa.int32()), pa.array(n, pa.int64())]
                    rows = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(fields, ["kind", "key", "other", "depth", "n"]))
                    yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(signs), rows], names=["host", "sign", "rows"])

    return pages.mapInArrow(tokens.tidy(work), "host long, sign long, rows array<struct<kind: int, key: long, other: long, depth: int, n: long>>")


def style_tree(pages: DataFrame, tmp: util.Scratch) -> DataFrame:
    """(host, kind, key, other, depth, pages, n, spread): the merged trees of all hosts, without what only one page has; ``spread`` is the sum of n ln n over pages."""
    each = branches(pages).groupBy("host", "sign").agg(F.first("rows").alias("rows"))  # equal remaining texts count once
    rows = each.select("host", F.explode("rows").alias("r")).select("host", "r.*")
    spread = F.sum(F.col("n") * F.log(F.col("n").cast("double")))
    merged = tmp.written(rows.groupBy("host", "kind", "key", "other", "depth").agg(F.count("*").alias("pages"), F.sum("n").alias("n"), spread.alias("spread")), "tree")
    shared = merged.where((F.col("kind") == NODE) & (F.col("pages") > 1)).select("host", "key", F.col("pages").alias("m"))
    return tmp.written(merged.join(shared, ["host", "key"]), "shared")


def importance(merged: DataFrame, tmp: util.Scratch) -> DataFrame:
    """(host, key, m, importance) of the nodes that several pages have, from the deepest level up."""
    per = F.log(F.col("m").cast("double"))
    texts = merged.where(F.col("kind") == TEXT).withColumn("h", (F.log(F.col("n").cast("double")) - F.col("spread") / F.col("n")) / per)
    texts = texts.groupBy("host", "key").agg((1 - F.least(F.avg("h"), F.lit(1.0))).alias("text"))
    of_styles = merged.where(F.col("kind") == STYLE).groupBy("host", "key").agg(F.sum("n").alias("total"), F.count("*").alias("l"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("nlogn"))
    own = F.least(F.greatest((F.log(F.col("total").cast("double")) - F.col("nlogn") / F.col("total")) / per, F.lit(0.0)), F.lit(1.0))
    nodes = merged.where(F.col("kind") == NODE).select("host", "key", F.col("other").alias("up"), "depth", "m")
    nodes = nodes.join(texts, ["host", "key"], "left").join(of_styles, ["host", "key"], "left").withColumn("own", own).withColumn("left", F.pow(F.lit(DECAY), F.col("l")))
    nodes = tmp.written(nodes.select("host", "key", "up", "depth", "m", "text", "own", "left", "total"), "nodes")
    styles = merged.where(F.col("kind") == STYLE).select("host", "key", F.col("other").alias("style"), "n", "depth")
    deepest = nodes.agg(F.max("depth")).first()[0]
    out = None
    below = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        if below is not None:
            held = below.groupBy("host", "up").agg(F.avg("importance").alias("held")).withColumnRenamed("up", "style")
            # a style of one page has children of one page, whose importance is one
            inner = styles.where(F.col("depth") == depth).join(held, ["host", "style"], "left").groupBy("host", "key").agg(F.sum(F.col("n") * F.coalesce("held", F.lit(1.0))).alias("inner"))
            level = level.join(inner, ["host", "key"], "left")
        else:
            level = level.withColumn("inner", F.lit(None).cast("double"))
        inner = F.coalesce(F.col("inner") / F.col("total"), F.lit(1.0))
        below = level.select("host", "key", "up", "m", F.coalesce("text", (1 - F.col("left")) * F.col("own") + F.col("left") * inner).alias("importance"))
        below = tmp.written(below, "level")
        out = below if out is None else out.unionByName(below)
    return out.drop("up") if out is not None else nodes.select("host", "key", "m", F.lit(1.0).alias("importance"))


def low_branches(found: DataFrame, tmp: util.Scratch) -> DataFrame:
    """(host, key) of the nodes of low importance that enough of their host's pages have."""
    low = tmp.written(found.where((F.col("importance") < LOW) & (F.col("m") >= PAGES) & (F.col("key") != F.col("host"))).select("host", "key", "m"), "unimportant")
    roots = found.where(F.col("key") == F.col("host")).select("host", F.col("m").alias("all"))
    return util.join_heavy(low, roots, ["host"]).where(F.col("m") >= PART * F.col("all")).select("host", "key")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", few: int = FEW_KEYS) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Defined cases: a null page is empty; an empty one, or one without main text, gives the empty text. Pages without a host in their address (or
    without an address) have no site, so only their own elements tell. Pages that aren't HTML are one block of text. Repeated rows stay
    rows, and are counted once in their site. Pages of any length and depth are read whole. An empty table gives an empty result. Other columns are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    with util.Scratch(spark) as tmp:
        found = tmp.written(low_branches(importance(style_tree(rows.select("url", "html"), tmp), tmp), tmp), "low")
        sent = None
        if found.limit(few + 1).count() <= few:
            sent = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in found.select("key").toLocalIterator()], np.int64)))
            rows = rows.withColumn("low", F.lit(None).cast("array<long>"))
        else:
            lists = found.groupBy("host").agg(F.collect_list("key").alias("low"))
            rows = tmp.written(_with_host(rows), "hosts")
            rows = util.join_heavy(rows, lists, ["host"], "left", heavy=util.heavy_keys(rows, ["host"])).drop("host")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = sent.value.view(np.uint64) if sent else None
            for batch in batches:
                for part in tokens.slices(batch, "html"):
                    texts = []
                    for url, source, own in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), part.column("low").to_pylist(), strict=True):
                        host = host_key(url)
                        page, shown, keep = _read(source or "")
                        if keys is None:
                            low = {x % (1 << 64) for x in own or []}
                        else:
                            low = _known(keys, page, shown, host) if len(keys) and host is not None else set()
                        texts.append(main_text(page, shown, keep, low, host))
                    yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        kind = rows.schema["page_id"].dataType.simpleString()
        out = rows.select("page_id", "url", "html", "low").mapInArrow(tokens.tidy(work), f"page_id {kind}, url string, text string, n_chars long")
        return util.written(out, "main-text")


def _known(keys: np.ndarray, page: dom.Page, shown: list[bool], host: int) -> set[int]:
    """The keys of the page's own branches among sorted ``keys``, compared as signed numbers."""
    _, element, block = tree(page, shown, host)
    own = np.unique(np.array([k for k in (*element, *block) if k], np.uint64).view(np.int64))
    at = np.minimum(np.searchsorted(keys.view(np.int64), own), len(keys) - 1)
    return {int(x) % (1 << 64) for x in own[keys.view(np.int64)[at] == own]}


def _with_host(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_key(u) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if h is None else _signed(h) for h in hosts], pa.int64())], names=[*batch.schema.names, "host"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"page_id {kind}, url string, html string, host long")


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
