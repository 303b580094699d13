import itertools

import numpy as np
import pytest

from lorespan.llm import html_crf
from lorespan.llm.dom import Block, leaf_blocks
from lorespan.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def field():
    return html_crf.default_field()


def texts(html):
    return [b.text for b in leaf_blocks(html)]


@pytest.mark.parametrize(
    "html, want",
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>one<p>two &amp; &lt;b&gt;<div>three<br>four</div>five", ["one", "two & <b>", "three four", "five"]),
        ("<ul><li>a<li>b <b>c</b></ul>", ["a", "b c"]),
        ("<script>var t='</p>';</script><style>p{}</style><!-- x <p> --><p>y", ["y"]),
        ("<head><title>t</title></head><body>x<script>never closed", ["x"]),
        ("<p>cut off <a href='x", ["cut off"]),
        ("<p>a < b and 1<2</p>", ["a < b and 1<2"]),
        ("<p title=\"a > b\">q</p><p class='x>y</p>z", ["q", "y", "z"]),
        ("</div><p>x</b></p></p>", ["x"]),
        ("<p>&am", ["&am"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ],
)
def test_leaf_blocks(html, want):
    assert texts(html) == want


def test_names_around():
    block = list(leaf_blocks('<div class="postContent side-bar" id=Main><p><a href=x>link</a> t'))[0]
    assert block.names == ("div", ".post", ".content", ".side", ".bar", ".main", "p") or block.names[:7] == ("div", ".post", ".content", ".side", ".bar", ".main", "p")
    assert block.tag == "p" and block.link_chars == 4


def test_viterbi_matches_all_labellings():
    draw = np.random.default_rng(0)
    for n in range(0, 7):
        names = [f"in:x{k}" for k in range(n)]
        field = html_crf.Field(dict(zip(names, draw.normal(size=n))), tuple(draw.normal(size=2)), tuple(map(tuple, draw.normal(size=(2, 2)))))
        blocks = [Block("word", (f"x{k}",), "p", 0) for k in range(n)]
        scores = {}
        for labels in itertools.product((False, True), repeat=n):
            emit = sum(field.weights[f] for f, y in zip(names, labels) if y)
            ends = (field.ends[0] * labels[0] + field.ends[1] * labels[-1]) if n else 0.0
            scores[labels] = emit + ends + sum(field.pairs[a][b] for a, b in zip(labels[:-1], labels[1:]))
        assert tuple(field.decode(blocks)) == max(scores, key=scores.get)


def test_held_out_pages(field):
    wrong = total = 0
    for blocks, labels in labelled_pages(150, first=5000):
        wrong += sum(a != b for a, b in zip(field.decode(blocks), labels))
        total += len(blocks)
    assert wrong / total < 0.01


def test_article_without_the_rest(field):
    html = (
        "<html><head><title>T</title></head><body><header><p>Site name</p></header><nav><ul><li><a href=a>Home</a></li></ul></nav>"
        '<div class="cookie-notice"><p>We use cookies.</p></div><div class="ad">Buy now.</div><article><h1>Title</h1><p>First &eacute; paragraph.</p>'
        "<p>Be.</p></article><aside class='sidebar'><p>Read more of this.</p></aside><form><p>Sign up.</p><button>Go</button></form>"
        '<section id="comments"><h3>Comments</h3><p>I liked this article very much, thank you for it.</p></section><footer>&copy; 2024 Site</footer>'
    )
    assert html_crf.main_text(html, field) == "Title\n\nFirst é paragraph.\n\nBe."


def test_tables_with_odd_rows(spark, field):
    long = "<article>" + "<p>long text</p>" * 50_000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav><a href=x>menu</a></nav>"), (4, "u", long), (None, "v", "<article><p>Be.</p></article>"), (3, "u", "<nav><a href=x>menu</a></nav>")]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = sorted((r.page_id or 0, r.url, len(r.text), r.n_chars) for r in html_crf.extract(df, field).fillna({"url": ""}).collect())
    assert got == [(0, "v", 3, 3), (1, "u", 0, 0), (2, "", 0, 0), (3, "u", 0, 0), (3, "u", 0, 0), (4, "u", 50_000 * 11 - 2, 50_000 * 11 - 2)]
    assert html_crf.extract(df.limit(0), field).collect() == []


@pytest.mark.parametrize(
    "html",
    [
        "<script>for(i=0;i<n;i++){f(i)}</script><p>Body</p>",
        "<script>if(a<b)c(\"it's\")</SCRIPT ><p>Body</p>",
        "<script>var s='<!--';</script><p>Body</p>",
        "<script>var s='</scripts>', t=1<x;</script\n><p>Body</p>",
        "<style>a::before{content:'<b'}</style><p>Body</p>",
        "<title>a<b or <!-- c</title><p>Body</p>",
        "<noscript><style>x<y{}</style></noscript><svg><script>a<b</script><title/></svg><p>Body</p>",
    ],
)
def test_markup_like_content_of_scripts_ends_at_their_end_tag(html):
    assert texts(html) == ["Body"]
