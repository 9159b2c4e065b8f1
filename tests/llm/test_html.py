"""Main text of pages, by cases and against a plain reading of the given pages."""

import html
import re
import time

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from spendtide.llm import html_blocks as h

FOLDER = "/root/testdata/sf0.01"
PROSE = "This sentence is long enough to look like a part of an article about nothing at all."
PAGE = f"""<!DOCTYPE html><html><head><title>Not text</title><style>p{{}}</style></head><body>
<header class="site"><a href="/">Home</a> Logo</header><nav><ul><li><a href=/a>A</a></ul></nav>
<div class="cookie-notice">We use cookies. {PROSE}</div><div id='ad-7'>{PROSE}</div>
<main><article><header><h1>A &lt;title&gt;</h1></header><p>One&nbsp;&amp; <b>two</b>
 three<p>{PROSE}<script>var x = "</p>";</script> More.<p>Yes.<ul><li>First</li><li>Second</li></ul>
<aside>{PROSE}</aside><form><label>{PROSE}</label><textarea>hidden</textarea></form>
<!-- <p>gone</p> --><section class="comments"><article><p>{PROSE}</p></article></section>
</article></main><aside class="sidebar"><p>{PROSE}</p></aside>
<footer>&copy; {PROSE}</footer></body></html>"""


def test_page():
    assert h.main_texts([PAGE]) == [
        f"A <title>\n\nOne & two three\n\n{PROSE} More.\n\nYes.\n\nFirst\n\nSecond"
    ]


def test_plain_pages_go_by_words_and_links():
    menu = "".join(f"<li><a href=/{k}>Entry {k}</a></li>" for k in range(5))
    page = f"<ul>{menu}</ul><div>{PROSE * 3}</div><p>{PROSE}</p><p>Short one.</p><p>{PROSE}</p><ul>{menu}</ul>"
    assert h.main_texts([page]) == [
        "\n\n".join([" ".join((PROSE * 3).split()), PROSE, "Short one.", PROSE])
    ]


def test_broken_markup():
    assert h.main_texts(["", "<", "<p", "no tags", "<article>a < b &amp; c", "</div></p>", "<!-- x"]) == [
        "", "", "", "no tags", "a < b & c", "", ""
    ]
    unclosed = f'<div class="ad"><article><p>{PROSE}</article>'
    assert h.main_texts([unclosed]) == [PROSE]
    deep = "<div>" * 3000 + f"<article><p>{PROSE}</p></article>" + "</div>" * 3000
    assert h.main_texts([deep]) == [PROSE]
    long = "<article>" + f"<p>{PROSE}</p>" * 20_000
    assert len(h.main_texts([long])[0]) == 20_000 * (len(PROSE) + 2) - 2


def test_labelled_blocks_are_learned():
    table = h.np.array(h.LABELLED)
    assert (h.decide(h.tree_of(), table[:, :-1]) == table[:, -1]).mean() >= 0.97


def test_given_pages():
    for page, in duckdb.sql(f"SELECT html FROM '{FOLDER}/pages.parquet'").fetchall():
        article = re.search("<article>(.*?)(?:</article>|$)", page, re.S)[1]
        plain = html.unescape(re.sub("<[^>]*>", " ", article))
        assert h.main_texts([page])[0].split() == plain.split()


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", PAGE * 50)]
    named = "page_id long, url string, html string, text int, n_chars string"
    pages = spark.createDataFrame([(*r, 0, "x") for r in rows], named)
    found = h.extract(pages).collect()
    assert len(found) == 5 and found[0] == found[1]
    assert all(r.n_chars == len(r.text) for r in found)
    assert found[2].text == "" and found[3].text == "" and found[2].page_id is None
    assert h.extract(pages.limit(0)).isEmpty()


def test_classes_of_body_article_and_main_do_not_hide_them():
    for page in (
        f"<body class='single comments-open'><article><p>{PROSE}</p></article></body>",
        f"<body><article class='post comments-open'><p>{PROSE}</p></article></body>",
        f"<body><main class='has-sidebar'><p>{PROSE}</p></main></body>",
        f"<body class='no-sidebar'><p>{PROSE}</p><p>{PROSE}</p></body>",
        f"<body id=comments><article id=reply><p>{PROSE}</p></article></body>",
    ):
        assert set(h.main_texts([page])[0].split("\n\n")) == {PROSE}, page
    for mark in ("<div class='comments'>", "<section id='replies'>", "<ul class='comment-list'>"):
        page = f"<body><article class='post'><p>{PROSE}</p>{mark}<article class='comment'><p>Mine.</p></article>"
        assert h.main_texts([page]) == [PROSE], mark


def test_pages_that_hide_their_article():
    two = f"<p>{PROSE}</p><p>{PROSE}</p>"
    for page in (
        f"<body><article><video-player src='a'></video-player><svg-icon></svg-icon>{two}</article>",
        f"<body><article><button>Go{two}</article><footer><button>Other</button></footer>",
        f"<body><div id=page class=has-sidebar>{two}</div>",
        f"<body><div class='content no-ads'>{two}</div>",
        f"<body><form action=x><nav><a href=/>Home</a></nav><div>{two}</div></form>",
        f"<body><article><p>{PROSE}</p><section class='related-work'><p>{PROSE}</p></section></article>",
        f"<body><article>{two}<p class='ad'>{PROSE}</p><p class=newsletter>Join</p></article>",
        f"<body><nav><ul><li><a href=/>Home</a></ul><article>{two}</article>",
        f"<body><article>{two}</article><aside><article><p>{PROSE} Other.</p></article></aside>",
        f"<body><article>{two}</article><svg><title>Not text",
    ):
        assert h.main_texts([page]) == [f"{PROSE}\n\n{PROSE}"], page


def test_marked_lines_and_cells():
    page = (
        "<article><p>It is <span class='ad'>buy <span>me</span> now</span>so.</p><ul><li>One<li class=ad>Buy<li>Two</ul>"
        "<table><tr><td>a<td class=ad>b<td>c</table><p><b class=sponsored>Paid.</article>"
    )
    assert h.main_texts([page]) == ["It is so.\n\nOne\n\nTwo\n\na\n\nc"]


def test_short_pages():
    assert h.main_texts(["<p>Hello world, a short page.</p>"]) == ["Hello world, a short page."]
    assert h.main_texts(["<h1>News</h1><p>It rained.</p><p>It stopped.</p>"]) == ["News\n\nIt rained.\n\nIt stopped."]


def test_stray_quotes_in_tags():
    page = "<article><p data-x=it's>a</p><p class=\"x\"\">b</p><p title='it's'>c</p><p/>d<br/>e<img alt='>'>f</article>"
    assert h.main_texts([page]) == ["a\n\nb\n\nc\n\nd e f"]


def test_any_bytes_in_linear_time():
    for part in ("<svg ", "<svg>", "x <b ", "<div>", "<button>", "<!--", '<a b="', "</p>", "<p><span class=ad>", "<li>",
                 "<td>", "<svg></svg", "<title>", "< ", "<script>", "<form class=ad><p>x", "<b class=ad>"):
        start = time.perf_counter()
        h.main_texts([part * (1_000_000 // len(part))])
        assert time.perf_counter() - start < 6, part


SIDE = [
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav>",
    "<div class='cookie-banner'>We use cookies. {p}</div>", "<aside class='sidebar'><h3>More</h3><p>{p}</p></aside>",
    "<footer><p>{p}</p></footer>", "<form><label>Name</label><input name=x><p>{p}</p></form>",
    "<section id=comments><h2>Comments</h2><div class=comment><p>{p}</p></div></section>",
    "<div class='ad'>{p}</div>", "<script>if (a < b) document.write('<p>{p}</p>')</script>",
    "<style>p > a {{ color: red }}</style>", "<!-- <p>{p}</p> -->", "<noscript><p>{p}</p></noscript>",
    "<ul class='share-buttons'><li><a href=/s>Share</a></ul>", "<template><p>{p}</p></template>",
]
INNER = [
    ("<p>{w}</p>", "{w}"), ("<p>{w}", "{w}"), ("<h2>{w}</h2>", "{w}"), ("<ul><li>{w}<li>{w}</ul>", "{w}\n\n{w}"),
    ("<p>{w} <a href=/x>{w}</a>\n\t{w}.</p>", "{w} {w} {w}."), ("<p>{w}<br>{w}</p>", "{w} {w}"),
    ("<blockquote><p>{w}</p></blockquote>", "{w}"), ("<p><em>{w}</em>&nbsp;&lt;b&gt;</p>", "{w} <b>"),
    ("<table><tr><td>{w}</td><td>{w}</td></tr></table>", "{w} {w}"),
    ("<figure><img src=x><figcaption>{w}</figcaption></figure>", "{w}"),
]
FRAMES = [
    "<body>{b}<article>{a}</article>{c}</body>", "<body>{b}<main id=content>{a}</main>{c}",
    "<body class='has-sidebar'>{b}<div id=wrap><article class='post comments-open'>{a}</article></div>{c}</body>",
    "<body><div class='page with-sidebar'>{b}<main><article>{a}</article></main>{c}</div></body>",
    "<body>{b}<div role=main>{a}</div>{c}</body>",
]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from(SIDE), max_size=5), st.lists(st.sampled_from(SIDE), max_size=5),
    st.lists(st.tuples(st.sampled_from(INNER), st.integers(1, 30)), min_size=1, max_size=9), st.sampled_from(FRAMES),
)
def test_generated_layouts(before, after, inner, frame):
    """The article of a page put together from known parts, by its own words."""
    side = "Nothing of this belongs to the text at all, however long it is and whatever it says."
    made, want = "", []
    for k, ((tags, text), size) in enumerate(inner):
        words = " ".join(f"w{k}x{n}" for n in range(size))
        made += tags.format(w=words)
        want.append(text.format(w=words))
    page = frame.format(a=made, b="".join(b.format(p=side) for b in before), c="".join(c.format(p=side) for c in after))
    assert h.main_texts([page]) == ["\n\n".join(want)]
