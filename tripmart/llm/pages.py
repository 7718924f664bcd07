"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree.  A node is a path of elements from ``body``
down, each written as tag and classes (containers also by their place among their like); its layouts are the series of children that pages give
it, its contents the texts of its blocks.  With m pages that have the node, its layout
importance is the entropy of the layouts to the base m, and its content importance one less
the mean over its contents of log_m(pages with that content): template parts look and read
alike on every page, articles do not.  A node's composite importance mixes its own with its
children's, ``1 - DECAY`` to ``DECAY``, children weighted by their characters.  These shares
multiply along a path and cancel, so every node adds ``DECAY`` to the power of its depth below
an ancestor, times its characters, to that ancestor: one grouping for all levels.

Branches of low importance are removed from each page.  Where markup says what a branch is
(``nav``, ``footer``, ``form``, a class such as ``sidebar``), its importance is zero, and
``article`` and ``main`` are taken as the page's content if it has them: entropy cannot tell
a menu from an article on a host of few pages or in articles that were copied.  Elsewhere
containers (never paragraphs, headings or other text blocks) are removed that stand on at least
``LEAST_PAGES`` pages and ``LEAST_SHARE`` of the host's, with an importance below
``LOW`` times the best of the host's branches that hold text.

Pages are parsed where they lie, twice; only hashes of (host, path, what) with counts are
shuffled, combined in the task and before the shuffle, so a hot host is split by path and
content.  The removed paths of a host are few (each stands on ``LEAST_SHARE`` of its pages);
Spark broadcasts or shuffles them by size, and splits a skewed host.

Defined cases: null html is empty, and gives an empty text; a null url, or one without a host,
belongs to the host named by the empty string; of a page with several articles all are kept;
without ``body`` the whole page is taken; unclosed elements end where HTML ends them or with
their parent; cut references stay as they are; repeated rows are pages of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripmart.llm.common import stored

DECAY, LOW = 0.5, 0.8
LEAST_PAGES, LEAST_SHARE = 8, 0.01
#: Elements deeper than this count as their ancestor at this depth.
DEPTH = 16
#: Like containers of one parent are told apart up to this many.
ORDINALS = 8
#: Pairs of (node, what) that a task counts before it passes them on.
HELD_COUNTS = 200_000

# ---- fixed values: elements and names of HTML -----------------------------------------
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements without readable text of the page.
UNREAD = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video"
    " select datalist textarea button".split()
)
#: Elements that are not the article.
ASIDE = frozenset("nav aside footer form dialog menu".split())
MAIN = frozenset(("article", "main"))
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that hold other blocks; only these are judged by importance.
CONTAINERS = frozenset(
    "div section ul ol dl table center figure header aside details fieldset".split()
)
#: start tag -> open elements that it ends, as far as the nearest of their parents
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: Words of classes and ids that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter notice"
    " notices pager pagination popup promo promoted promotion related replies respond share"
    " sharing sidebar social sponsor sponsored subscribe toolbar topbar widget".split()
)
# ---------------------------------------------------------------------------------------
_WORDS = re.compile(r"[a-z]+")
LAYOUT, CONTENT, PRESENT, PAGE = 0, 1, 2, 3


class _Node:
    __slots__ = ("tag", "path", "noise", "main", "parent", "children")

    def __init__(self, tag: str, path: tuple, noise: bool, main: bool, parent):
        self.tag, self.path, self.noise, self.main, self.parent = tag, path, noise, main, parent
        self.children: list[str] = []


class Page(HTMLParser):
    """The elements and blocks of a page, in order.

    blocks: (node, text) with white space made single; a block's node is the nearest block
    element around it.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", (), False, False, None)
        self.nodes, self.blocks = [self.root], []
        self._node, self._open, self._text = self.root, [self.root], []
        self._unread: list[str] = []
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text = []
        if text:
            self.blocks.append((self._open[-1], text))

    def handle_data(self, data: str) -> None:
        if not self._unread:
            self._text.append(data)

    def handle_startendtag(self, tag: str, attrs) -> None:
        # A slash closes no element of HTML, but those without content are closed anyway.
        self.handle_starttag(tag, attrs)

    def handle_starttag(self, tag: str, attrs) -> None:
        if self._unread:
            if tag == self._unread[-1] and tag not in VOID:
                self._unread.append(tag)
            elif tag in BLOCKS and self._unread == ["head"]:
                # An element of the body ends a head left open.
                self._unread = []
            if self._unread:
                return
        if tag == "br":
            self._text.append("\n")
        if tag in UNREAD:
            self._unread.append(tag)
            return
        if tag not in BLOCKS:
            return
        self._flush()
        if tag == "hr":
            return
        if tag in ENDS_P:
            self._end({"p"}, CONTAINERS | MAIN | {"body", "td", "th", "li", "blockquote"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        self._start(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self._unread:
            if tag in self._unread:
                while self._unread.pop() != tag:
                    pass
            return
        if tag in BLOCKS:
            self._flush()
            if tag not in ("body", "html"):
                self._end({tag}, {"body"})

    def _start(self, tag: str, attrs) -> None:
        parent = self._open[-1]
        names = " ".join(value or "" for name, value in attrs if name in ("class", "id", "role")).lower()
        named = not NOISE_WORDS.isdisjoint(_WORDS.findall(names)) and tag not in MAIN
        noise = parent.noise or tag in ASIDE or (named and tag not in ("html", "body"))
        # A header outside the article is the site's.
        noise = noise or (tag == "header" and not parent.main)
        main = parent.main or tag in MAIN
        classes = next((value or "" for name, value in attrs if name == "class"), "")
        label = ".".join([tag, *sorted(set(classes.split()))])
        if tag in CONTAINERS:
            same = sum(child.split("#")[0] == label for child in parent.children[-ORDINALS:])
            label = f"{label}#{same + 1}"
        path = (*parent.path, label) if len(parent.path) < DEPTH else parent.path
        parent.children.append(label)
        self._open.append(_Node(tag, path, noise, main, parent))
        self.nodes.append(self._open[-1])

    def _end(self, tags: set[str], bounds) -> None:
        """Close the innermost open element of these tags, and what is open in it."""
        for place in range(len(self._open) - 1, 0, -1):
            tag = self._open[place].tag
            if tag in tags:
                del self._open[place:]
                return
            if tag in bounds:
                return


def _hash(value) -> int:
    digest = hashlib.blake2b(repr(value).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _ancestors(path: tuple) -> list[tuple]:
    return [path[:depth] for depth in range(1, len(path) + 1)]


def node_facts(html: str) -> list[tuple[tuple, int, int, int]]:
    """(path, kind, what, characters) of the page's nodes, each once."""
    page = Page(html)
    chars: Counter = Counter()
    facts = set()
    for node, text in page.blocks:
        facts.add((node.path, CONTENT, _hash(text)))
        chars[node.path] += len(text)
    for node in page.nodes[1:]:
        facts.add((node.path, LAYOUT, _hash(_collapsed(node.children))))
    found = [(*fact, 0) for fact in facts]
    found += [(path, PRESENT, 0, chars[path]) for path in {node.path for node in page.nodes[1:]}]
    return [*found, ((), PAGE, 0, 0)]


def _collapsed(children: list[str]) -> tuple:
    """Runs of like children count as one, as lists and articles differ in length."""
    return tuple(c for k, c in enumerate(children) if k == 0 or children[k - 1] != c)


def _fact_rows(schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, list[int]] = {}

        def batch() -> pa.RecordBatch:
            keys = list(counts)
            columns = list(zip(*keys, strict=True)) if keys else [[] for _ in range(4)]
            values = list(zip(*counts.values(), strict=True)) if keys else [[], []]
            host, path, kind, what = columns
            arrays = [host, [list(p) for p in path], kind, what, *values]
            return pa.RecordBatch.from_arrays(
                [pa.array(a, field.type) for a, field in zip(arrays, schema, strict=True)], schema=schema
            )

        for part in batches:
            for row in range(part.num_rows):
                host, html = part.column(0)[row].as_py(), part.column(1)[row].as_py()
                for path, kind, what, chars in node_facts(html):
                    held = counts.setdefault((host, path, kind, what), [0, 0])
                    held[0] += 1
                    held[1] += chars
                if len(counts) > HELD_COUNTS:
                    yield batch()
                    counts.clear()
        yield batch()

    return rows


def _host(url: Column) -> Column:
    """Lower-case host of the url, without port and user; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1)
    return F.lower(F.regexp_replace(authority, r"^.*@|:\d*$", ""))


def hosted(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        "url",
        _host(F.col("url").cast("string")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def style_tree(pages: DataFrame) -> DataFrame:
    """Per host and path: pages, share of the host's pages, importance (composite), chars."""
    fields = "host string, path array<string>, kind int, what long, n long, chars long"
    schema = to_arrow_schema(pages.sparkSession.createDataFrame([], fields).schema)
    counted = (
        hosted(pages)
        .select("host", "html")
        .mapInArrow(_fact_rows(schema), fields)
        .groupBy("host", "path", "kind", "what")
        .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    )
    n = F.col("n").cast("double")
    is_layout, is_content = F.col("kind") == LAYOUT, F.col("kind") == CONTENT

    def when(condition: Column, value) -> Column:
        return F.sum(F.when(condition, value).otherwise(0.0))

    nodes = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind").isin(PRESENT, PAGE), F.col("n"))).alias("pages"),
        F.sum("chars").alias("chars"),
        when(is_layout, n).alias("layouts"),
        when(is_layout, n * F.log(n)).alias("layout_logs"),
        when(is_content, 1.0).alias("contents"),
        when(is_content, F.log(n)).alias("content_logs"),
    )
    base = F.log(F.col("pages").cast("double"))
    entropy = F.log("layouts") - F.col("layout_logs") / F.col("layouts")
    layout = F.when(F.col("pages") > 1, F.least(F.lit(1.0), entropy / base)).otherwise(1.0)
    content = F.when(
        F.col("pages") > 1, 1 - F.least(F.lit(1.0), F.col("content_logs") / F.col("contents") / base)
    ).otherwise(1.0)
    own = F.when(F.col("contents") > 0, content).otherwise(layout)
    nodes = nodes.select("host", "path", "pages", "chars", own.alias("own"))
    # Each node counts in itself and in all its ancestors.
    depth = F.size("path")
    shared = nodes.select(
        "host",
        F.posexplode(F.sequence(F.lit(0), depth)).alias("level", "up_to"),
        F.slice("path", F.lit(1), F.col("level")).alias("node"),
        (F.col("level") == depth).alias("is_self"),
        "pages",
        "chars",
        "own",
        F.pow(F.lit(DECAY), depth - F.col("level")).alias("weight"),
    )
    # Without characters a node still has its layout.
    mass = F.col("weight") * (F.col("chars") + F.when(F.col("is_self"), 1).otherwise(0))
    return (
        shared.groupBy("host", F.col("node").alias("path"))
        .agg(
            F.max(F.when(F.col("is_self"), F.col("pages"))).alias("pages"),
            F.sum("chars").alias("chars"),
            (F.sum(mass * F.col("own")) / F.sum(mass)).alias("importance"),
        )
    )


def noise_paths(tree: DataFrame) -> DataFrame:
    """host and its branches (lists of labels) of low importance."""
    whole = tree.filter(F.size("path") == 0).select("host", F.col("pages").alias("all_pages"))
    last = F.element_at("path", -1)
    judged = tree.filter(F.size("path") > 0).join(whole, "host")
    frequent = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("all_pages"))
    best = judged.filter(frequent & (F.col("chars") > 0)).groupBy("host").agg(
        F.max("importance").alias("best")
    )
    is_container = F.regexp_extract(last, "^[a-z]+", 0).isin(*sorted(CONTAINERS))
    return (
        judged.filter(frequent & is_container)
        .join(best, "host")
        .filter(F.col("importance") < LOW * F.col("best"))
        .groupBy("host")
        .agg(F.collect_list("path").alias("noise"))
    )


def page_text(html: str, noise: frozenset[tuple] = frozenset()) -> str:
    """The blocks left of a page, joined by line feeds."""
    page = Page(html)
    has_main = any(node.main and not node.noise for node, _ in page.blocks)
    kept = []
    for node, text in page.blocks:
        if node.noise or has_main and not node.main:
            continue
        if noise and any(path in noise for path in _ancestors(node.path)):
            continue
        kept.append(text)
    return "\n".join(kept)


def _text_rows(schema: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for start in range(0, part.num_rows, 200):
                piece = part.slice(start, 200)
                texts = [
                    page_text(html.as_py(), frozenset(tuple(path) for path in noise.as_py() or ()))
                    for html, noise in zip(piece.column(2), piece.column(3), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        piece.column(1),
                        pa.array(texts, schema.field(2).type),
                        pa.array([len(text) for text in texts], pa.int64()),
                    ],
                    schema=schema,
                )

    return rows


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    # Stored, so that its size is known: Spark then broadcasts it, or shuffles if it is large.
    noise = stored(noise_paths(stored(style_tree(pages), "style-tree")), "page-noise")
    id_type = pages.schema["page_id"].dataType.simpleString()
    fields = f"page_id {id_type}, url string, text string, n_chars long"
    schema = to_arrow_schema(pages.sparkSession.createDataFrame([], fields).schema)
    joined = hosted(pages).join(noise, "host", "left")
    return joined.select("page_id", F.col("url").cast("string"), "html", "noise").mapInArrow(
        _text_rows(schema), fields
    )
