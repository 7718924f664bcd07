"""Main text of pages against plain extraction, and the style tree against its definition."""

import html as entities
import math
import re
from collections import Counter

import pytest

from tripmart.llm import pages
from tripmart.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def article(page: str) -> str:
    """The blocks of the generated pages' article, by pattern."""
    inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(entities.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in blocks)
    return "\n".join(text for text in texts if text)


def texts_of(spark, rows, schema=SCHEMA):
    found = pages.main_text(spark.createDataFrame(rows, schema)).collect()
    assert all(row.n_chars == len(row.text) for row in found)
    return {row.page_id: row.text for row in found}


def test_query_against_pattern(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    found = QUERIES["op13_html_extraction"](spark, folder).collect()
    assert {(r.page_id, r.url, r.text) for r in found} == {
        (r.page_id, r.url, article(r.html)) for r in rows
    }


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt; &#233;&eacute;&nbsp;&amp", "plain <text> éé &"),
        ("<p>a <b>b</b>\n\t c<br>d<p>e", "a b c d\ne"),
        ("<head><title>t</title><p>head left open", "head left open"),
        ("<body><header>h</header><main><header><h1>T</h1></header>x</main><aside>s</aside>", "T\nx"),
        ("<article>a<nav>n</nav><form>f<p>g</form><footer>x</footer>b</article>c", "a\nb"),
        ("<article>one</article><div>no</div><article>two</article>", "one\ntwo"),
        ("<article><p>x<div class='user-comments'><p>c</div><div id=related>r</div>y", "x\ny"),
        ("<div class='cookie-notice'>n</div><div>text</div>", "text"),
        ("<script>var a='<p>x</p>'</script><style>p{}</style><!-- c <p>d</p> --><p>y", "y"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<article><p>a</article></div></body></html><p>", "a"),
        ("<article>&am", "&am"),
        ("<svg><text>s</text></svg><noscript><p>n</p></noscript>t", "t"),
    ],
)
def test_page_text(html, text):
    assert pages.page_text(html or "") == text


def template_site(n: int) -> list[tuple]:
    """Pages without telling markup: a menu, a text of their own, a notice in two versions."""
    return [
        (
            k,
            f"http://user@Site.example:80/{k}",
            f"<body><div><p>home about</p><p>contact</p></div><div><p>text {k} alpha</p><p>more {k}</p>"
            f"</div><div>{'buy now' if k % 2 else 'sale today'}</div></body>",
        )
        for k in range(n)
    ]


def test_tree_removes_what_pages_share(spark):
    found = texts_of(spark, template_site(40))
    assert found == {k: f"text {k} alpha\nmore {k}" for k in range(40)}
    few = texts_of(spark, template_site(3))
    assert few[1] == "home about\ncontact\ntext 1 alpha\nmore 1\nbuy now"


def test_copied_pages_stay(spark):
    rows = [(k, "https://copies.example/", "<div><p>same text</p></div><div>more</div>") for k in range(60)]
    assert set(texts_of(spark, rows).values()) == {"same text\nmore"}


def test_importance_by_its_definition(spark):
    rows = template_site(16)
    tree = {
        tuple(row.path): row
        for row in pages.style_tree(spark.createDataFrame(rows, SCHEMA)).collect()
    }

    def content(texts_by_page):
        counts = Counter(t for texts in texts_by_page for t in set(texts))
        return 1 - sum(math.log(n, 16) for n in counts.values()) / len(counts)

    notice = ("body", "div#3")
    assert tree[notice].pages == 16
    assert math.isclose(
        tree[notice].importance, content([["buy now" if k % 2 else "sale today"] for k in range(16)])
    )
    leaf = content([[f"text {k} alpha", f"more {k}"] for k in range(16)])
    box = ("body", "div#2")
    assert math.isclose(tree[(*box, "p")].importance, leaf)
    chars = tree[(*box, "p")].chars
    mixed = (1 * 0.0 + pages.DECAY * chars * leaf) / (1 + pages.DECAY * chars)
    assert math.isclose(tree[box].importance, mixed)
    assert all(tree[p].importance < tree[box].importance for p in (notice, ("body", "div#1")))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [
        (None, None, None, "x", 1), (1, None, "<p>a", "x", 1), (1, None, "<p>a", "x", 1),
        (2, "no url", "<p>b", "x", 1), (3, "http://h", None, "x", 1),
    ]
    table = spark.createDataFrame(rows, f"{SCHEMA}, host string, noise int")
    found = sorted(tuple(r) for r in pages.main_text(table).fillna(-1).fillna("").collect())
    assert found == [(-1, "", "", 0), (1, "", "a", 1), (1, "", "a", 1), (2, "no url", "b", 1), (3, "http://h", "", 0)]
    assert texts_of(spark, []) == {}


def test_long_and_deep_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    found = texts_of(spark, [(1, "http://a", deep), (2, "http://a", long)])
    assert found[1] == "deep" and found[2] == "\n".join(["word & word"] * 60_000)
