"""Main text of web pages by site style trees.

The pages of a host are merged to one tree: a node is a path of tags with their
class, id and role. For each node that holds text, the tree counts the distinct
texts and links it holds (content) and the distinct sequences of tags inside it
(presentation), and on how many pages each occurs. A node's presentation
importance is the entropy of its sequences over the pages, its content
importance one less the mean entropy of its texts, to the base of the number of
pages; together ``(1 - GAMMA) presentation + GAMMA content``. What every page
repeats in the same shape has a low importance, and branches below ``least`` go.
Nodes that fewer than ``min_pages`` of the host's pages have are judged by the
tree of all hosts together. Elements that never hold main text by their tag, by
their role, by a ``hidden`` attribute or by a class or id that is a word of the list
(a number behind it apart) go as well; any other class name is left to the tree. A
page whose every text stands under such a class or id is left to the tree, too.

The counts are aggregates by (host, node, text), so a host with a third of all
pages is no group of its own anywhere.

A null or empty page has the empty text. A null url is a host of its own.
Repeated rows count as pages of their own. Unclosed and stray tags are taken as
browsers take them; a page that would lose all its text to the style tree keeps
its text. An empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import keep_columns, ship, slices, written

GAMMA = 0.9

# HTML's void, raw-text and block elements, and tags without main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr br img".split())
NEVER = set("script style title textarea noscript iframe xmp noembed noframes head nav header footer aside form button select "
            "template svg canvas object audio video menu dialog option datalist math".split())
WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
            "cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
            "popup promo promos promoted related respond share sharing sidebar skip social sponsor sponsored subscribe toolbar "
            "widget widgets".split())
#: Of those, elements that may stand round a whole page all the same.
WRAPPING = set("nav header footer aside form dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A new start tag of these ends an open one of the set: HTML's optional end tags.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tbody"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "tbody": {"table"}, "thead": {"table"}}

#: Parts of compound names that mark an element as they stand alone, and parts beside which they don't.
PARTS = set("comment comments footer breadcrumb breadcrumbs newsletter cookie cookies advert advertisement".split())
NOT_BESIDE = set("no not has have with without off hide hidden disable disabled enable enabled".split())
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile(r"=\s*[\"']|>")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)")
_ATTR = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NUMBER = re.compile(r"[-_]?[0-9]+$")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#:]*)"


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\x00".join(parts).encode(), digest_size=8).digest(), "little", signed=True)


class Node:
    """An open element. ``gone``: how strongly it or an element round it rules out
    main text; ``by``: the outermost elements that do, few of them, and ``n_by`` their number."""
    __slots__ = ("tag", "path", "own", "gone", "by", "n_by", "block", "holder", "inside")

    def __init__(self, tag, parent, style, gone, block):
        self.tag, self.own, self.block, self.inside = tag, gone, block, []
        self.path = _key(str(parent.path), f"{tag}[{style}]") if block and parent else parent.path if parent else 0
        self.holder = self if block else parent.holder
        self.gone = max(gone, parent.gone) if parent else gone
        by = parent.by if parent else ()
        self.by = by + (self,) if gone and len(by) < WRAPPERS else by
        self.n_by = (parent.n_by if parent else 0) + (gone > 0)


#: Nested elements round a whole page that may each seem to rule it out.
WRAPPERS = 4


class Scanner:
    """A page's markup piece by piece, in time linear in its length: ends and quotes
    that no longer occur are searched for once."""

    def __init__(self, html: str):
        self.html, self.n, self.missing = html, len(html), set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Where the tag whose attributes begin here ends (its ``>``), or -1. A quote counts
        after an equals sign, and only if what follows the closing one can follow a value:
        else it was never closed, and the tag ends at the next ``>``."""
        while True:
            if ">" in self.missing:
                return -1
            m = _EDGE.search(self.html, at)
            if not m:
                self.missing.add(">")
                return -1
            if m.group() == ">":
                return m.start()
            close = self.find(m.group()[-1], m.end())
            if close < 0 or self.html[close + 1:close + 2] not in (" ", "\t", "\n", "\r", "\x0c", "/", ">", ""):
                return self.find(">", m.end())
            at = close + 1

    def pieces(self):
        """``(slash, tag, attributes, None, end)`` of tags and ``("", None, "", text, end)`` of text; send back another place to go on from."""
        at, html = 0, self.html
        while at < self.n:
            if html[at] != "<":
                end = self.find("<", at)
                end = self.n if end < 0 else end
                yield "", None, "", html[at:end], end
                at = end
                continue
            if html.startswith("<!--", at):
                end = self.find("-->", at + 4)
                at = self.n if end < 0 else end + 3
                continue
            if html[at + 1:at + 2] in ("!", "?"):
                end = self.find(">", at)
                at = self.n if end < 0 else end + 1
                continue
            m = _TAG.match(html, at + 1)
            if not m:
                yield "", None, "", "<", at + 1
                at += 1
                continue
            end = self.tag_end(m.end())
            if end < 0:  # a tag that never ends is no text
                return
            back = yield m[1], m[2].lower(), html[m.end():end], None, end + 1
            at = end + 1 if back is None else back


def _marks(name: str) -> bool:
    """Whether a class or id rules out main text: a whole listed name, or a compound
    one that begins or ends with a telling part."""
    name = _NUMBER.sub("", name)
    if name in WORDS:
        return True
    parts = re.split(r"[-_]+", name)
    return len(parts) > 1 and (parts[0] in PARTS or parts[-1] in PARTS) and NOT_BESIDE.isdisjoint(parts)


def _attributes(raw: str) -> tuple[str, int]:
    """The style of a start tag, and whether it rules out main text: 3 if it is
    never seen, 2 by a role, 1 by a class or id only, else 0."""
    style, gone = [], 0
    for name, a, b, c in _ATTR.findall(raw):
        name, value = name.lower(), (a or b or c).lower()
        if name == "style":
            if _UNSEEN.search(value):
                gone = 3
            continue
        if name not in ("class", "id", "role", "hidden"):
            continue
        if name == "hidden":
            gone = 3
        elif name == "role":
            gone = max(gone, 2 * (value.strip() in ROLES))
        else:
            gone = max(gone, any(_marks(x) for x in value.split()))
        style.append(f"{name}={re.sub(r'[0-9]+', '0', value)}")
    return " ".join(style), gone


def blocks(html: str) -> list[tuple[int, str, str]]:
    """``(node, tags inside, text)`` of the page's text blocks in order,
    without those whose tags or names rule them out. An element round all text that is
    left rules nothing out (a form round a whole page, say, but nothing unseen); if
    classes and ids rule out all that is left, those."""
    root = Node("", None, "", 0, True)
    stack, out, other, text = [root], [], [], []
    opened: Counter = Counter()

    def flush():
        if text:
            line = " ".join(unescape("".join(text)).split())
            text.clear()
            top, holder = stack[-1], stack[-1].holder
            if line and top.gone < 3:
                (other if top.gone else out).append((top, (holder.path, " ".join(holder.inside), line)))
            holder.inside = []

    def close(k):
        if any(x.block for x in stack[k:]):
            flush()
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    scanner = Scanner(html)
    pieces = scanner.pieces()
    piece = next(pieces, None)
    while piece is not None:
        slash, tag, raw, chars, at = piece
        back = None
        if chars is not None:
            text.append(chars)
        elif slash:
            if opened[tag] > 0:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
        else:
            inline = tag in INLINE
            if tag in CLOSES and any(opened[x] for x in CLOSES[tag]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in _SCOPE[tag]:
                        break
                    if stack[k].tag in CLOSES[tag]:
                        close(k)
                        break
            if not inline:
                if opened["p"] > 0:
                    for k in range(len(stack) - 1, 0, -1):  # a paragraph ends where a block begins
                        if stack[k].tag == "p":
                            close(k)
                            break
                        if stack[k].block:
                            break
                flush()
            else:
                if tag == "br":
                    text.append(" ")
                stack[-1].holder.inside.append(tag)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                back = end.end() if end else len(html)
            elif not (tag in VOID or raw.rstrip().endswith("/") and inline):
                style, named = _attributes(raw) if raw.strip() else ("", 0)
                named = 0 if named == 1 and tag in ("html", "body", "article", "main") else named
                if tag in NEVER:
                    named = max(named, 2 if tag in WRAPPING else 3)
                stack.append(Node(tag, stack[-1], style, named, not inline))
                opened[tag] += 1
        try:
            piece = pieces.send(back) if back is not None else next(pieces)
        except StopIteration:
            piece = None
    flush()
    if out or not other:
        return [x for _, x in out]
    # nothing is left: what stands round all of it doesn't count
    for depth in range(WRAPPERS):
        round_all = {id(top.by[depth]) if len(top.by) > depth else None for top, _ in other}
        if len(round_all) > 1 or None in round_all:
            break
        free = [x for top, x in other if top.n_by == depth + 1]
        if free:
            return free
    return [x for top, x in other if top.gone < 2]


# ---- the trees -----------------------------------------------------------

def _tree_rows(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            seen: Counter = Counter()
            for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                page = set()
                for node, inside, line in blocks(html or ""):
                    page.update(((node, 0, 0), (node, 1, _key(line)), (node, 2, _key(inside))))
                for x in page:
                    seen[host, *x] += 1
            if seen:
                cols = list(zip(*seen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int64()), pa.array(list(seen.values()), pa.int64())], ["host", "node", "kind", "item", "n"])


def importance(counts: DataFrame, by: list[str]) -> DataFrame:
    """``(by, pages, importance)`` of each node from ``(by, kind, item, n)``: kind 0
    has the pages of the node, 1 its texts, 2 its tag sequences."""
    n = F.col("n")
    sums = counts.groupBy(*by).agg(
        F.max(F.when(F.col("kind") == 0, n)).alias("pages"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("texts"), F.sum(F.when(F.col("kind") == 1, F.log(n))).alias("t"),
        F.sum(F.when(F.col("kind") == 2, n)).alias("shapes"), F.sum(F.when(F.col("kind") == 2, n * F.log(n))).alias("s"))
    base = F.log("pages")
    content = 1 - F.col("t") / F.col("texts") / base
    shape = F.least(F.lit(1.0), (F.log("shapes") - F.col("s") / F.col("shapes")) / base)
    both = F.when(F.col("pages") > 1, (1 - GAMMA) * shape + GAMMA * content).otherwise(1.0)
    return sums.select(*by, "pages", both.alias("importance"))


def dropped_nodes(pages: DataFrame, least: float, min_pages: int) -> tuple[DataFrame, DataFrame]:
    """Nodes that all hosts together rule out, ``(node)``; and where a host's own
    tree decides otherwise, ``(host, node, low)``."""
    rows = pages.select("host", "html").mapInArrow(_tree_rows, "host string, node bigint, kind int, item bigint, n bigint")
    counts = written(rows.groupBy("host", "node", "kind", "item").agg(F.sum("n").alias("n")), "sst-counts")
    total = counts.groupBy("node", "kind", "item").agg(F.sum("n").alias("n"))
    everywhere = written(importance(total, ["node"]).select(
        "node", ((F.col("pages") >= min_pages) & (F.col("importance") < least)).alias("low")), "sst-all")
    own = importance(counts, ["host", "node"]).filter(F.col("pages") >= min_pages).select(
        "host", "node", (F.col("importance") < least).alias("own"))
    differ = own.join(everywhere, "node").filter("own <> low").select("host", "node", F.col("own").alias("low"))
    return everywhere.filter("low").select("node"), written(differ, "sst-differ")


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: float = 0.55,
            min_pages: int = 8, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``(key, url, text, n_chars)``: the main text of each page, its blocks joined
    by two line feeds. The verdicts on nodes are broadcast if they number at most
    ``broadcast_rows``; beyond that they are joined by host."""
    spark = df.sparkSession
    ship(spark)
    src = keep_columns(df, [key, url, html]).toDF("key", "url", "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1))
    src = src.withColumn("host", host)
    everywhere, differ = dropped_nodes(src, least, min_pages)
    everywhere = written(everywhere, "sst-low")
    small = everywhere.limit(broadcast_rows + 1).count() + differ.limit(broadcast_rows + 1).count() <= broadcast_rows
    if small:
        low = {r["node"] for r in everywhere.collect()}
        change: dict[str, tuple[set, set]] = {}
        for r in differ.collect():
            change.setdefault(r["host"], (set(), set()))[r["low"]].add(r["node"])
        shared = spark.sparkContext.broadcast((low, change))
    else:  # each page's nodes meet the verdicts on them
        path_keys = src.select(F.expr("uuid()").alias("id"), "*").transform(lambda d: written(d, "sst-pages"))
        src = path_keys
        nodes = path_keys.select("id", "host", "html").mapInArrow(_page_nodes, "id string, host string, node bigint")
        verdict = nodes.join(everywhere.withColumn("all", F.lit(True)), "node", "left").join(differ, ["host", "node"], "left")
        gone = verdict.filter(F.coalesce("low", "all", F.lit(False))).groupBy("id").agg(F.collect_set("node").alias("gone"))
        src = src.join(gone, "id", "left").drop("id")
    kind = src.schema["key"].dataType.simpleString()

    def run(batches):
        common, change = shared.value if small else (set(), {})
        for batch in batches:
            for part in slices(batch, "html"):
                hosts = part.column("host").to_pylist()
                own = part.column("gone").to_pylist() if not small else [None] * part.num_rows
                texts = []
                for page, host_, gone in zip(part.column("html").to_pylist(), hosts, own):
                    got = [(node, line) for node, _, line in blocks(page or "")]
                    keep, drop = change.get(host_, (set(), set()))
                    low = set(gone or ()) if not small else {n for n, _ in got if (n in common and n not in keep) or n in drop}
                    texts.append("\n\n".join([line for n, line in got if n not in low] or [line for _, line in got]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["key", "url", "text", "n_chars"])

    out = src.mapInArrow(run, f"key {kind}, url string, text string, n_chars bigint")
    return out.withColumnsRenamed({"key": key, "url": url})


def _page_nodes(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            rows = [(i, h, n) for i, h, page in zip(part.column("id").to_pylist(), part.column("host").to_pylist(),
                                                    part.column("html").to_pylist()) for n in {node for node, _, _ in blocks(page or "")}]
            cols = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.int64())], ["id", "host", "node"])
