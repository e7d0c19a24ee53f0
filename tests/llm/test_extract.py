"""HTML extraction on hand-made pages and on generated sites with templates."""

import random

import pytest

from wordloom.llm.extract import extract, main_text, parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head>
<body class="has-sidebar"><header class="site"><h1>Site</h1></header>
<div id="cookie-notice">We use cookies</div><nav><a>Home</a></nav>
<main><article class="post"><header><h1>Title &amp; more</h1><span>By me</span></header>
<p>One <b>bo</b>ld<br>two<p>Three &lt;3 &nbsp; x<!-- gone --><div class="advert">Buy</div>
<ul><li>a<li>b</ul><form><input>Subscribe</form><table><tr><td>c1<td>c2</table>
<section class="comments"><article class="comment"><p>Nice!</p></article></section>
<script>if (a < b) { "</p>" }</script></article><aside>side</aside></main>
<div role="contentinfo">imprint</div><footer>f</footer>"""


@pytest.mark.parametrize(
    "html,text",
    [
        (PAGE, "Title & more\nOne bold two\nThree <3 x\na\nb\nc1 c2"),
        ("", ""),
        ("plain < text &amp; more", "plain < text & more"),
        ("<p>a<p>b</div>c", "a\nbc"),
        ("<article><p>1 &#49; &eacute;t&eacute; &copy</article>", "1 1 été ©"),
        ("<article><p>a</p><!-- never closed <p>b", "a"),
        ("<article><p>a</p><script>var t='</p>'", "a"),
        ("<p>x<p class='a>b'>y", "x\ny"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
        ("<article><p>long long text</p></article><article>teaser</article>", "long long text"),
        ("<div class='article-content'><p>a</p></div><div>other</div>", "a"),
        ("<div class='Sidebar'>no</div><div class='no-sidebar'>yes</div>", "yes"),
        ("<main><h1>H</h1>\n<p> a \t b\r\nc </p></main><div>rest</div>", "H\na b c"),
        ("<article>a<![CDATA[b]]></article>", "ab"),
        ("<pre>x  y\nz</pre>", "x y z"),
        ("<p", ""),
        ("<article><blockquote>q</blockquote><dl><dt>t<dd>d</dl></article>", "q\nt\nd"),
    ],
)
def test_pages(html, text):
    assert main_text(html) == text


def test_broken_markup_is_read_once():
    html = "<a " + '"' * 3001 + "<b" * 3000 + "<p>" * 500 + "end"
    assert parse(html) is not None


@pytest.fixture(scope="module")
def site():
    """Pages of two hosts: a banner and a link list on all pages of one, articles with a
    paragraph that many share, and one article copied to many pages."""
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgh", k=7))
    body = lambda n: " ".join(word() for _ in range(n))
    shared, copied = body(12), body(60)
    banner = "<div class='top'><p>Best site of all</p><span>since 1999</span></div>"
    links = "<div><a href='/a'>One more</a> <a href='/b'>Two more</a></div>"
    rows, want = [], {}
    for i in range(90):
        own = copied if i < 30 else body(40)
        if i % 3 == 0:  # no element names the article
            html = f"<body>{banner}<div class=x><p>{own}</p></div>{links}</body>"
            want[i] = own
        else:
            html = f"<body>{banner}<article><h2>{shared}</h2><p>{own}</p>{links}</article>"
            want[i] = f"{shared}\n{own}"
        rows.append((i, f"https://user@Big.example.com:80/{i}?x#y", html))
    for i in range(90, 94):  # on few pages the same parts are no template
        rows.append((i, "http://small.example.org", f"<body>{banner}<p>{i}</p></body>"))
        want[i] = f"Best site of all\nsince 1999\n{i}"
    return rows, want


def test_templates(spark, frame, site):
    rows, want = site
    rows = rows + [(200, None, None), (201, None, "<p>x"), (201, None, "<p>x"), (None, "u", "<p>n")]
    want = list(want.items()) + [(200, ""), (201, "x"), (201, "x"), (None, "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = extract(pages).collect()
    assert sorted(((r.page_id, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in got)


def test_boxes_in_marked_articles(spark, frame):
    """A box on many pages goes also from inside the article, a shared paragraph stays."""
    r = random.Random(3)
    body = lambda n: " ".join("".join(r.choices("abcdefgh", k=7)) for _ in range(n))
    shared = body(10)
    box = "<div class='club'><h3>Join our club</h3><p>Ten letters a year</p></div>"
    author = "<section><ul><li>Staff</li><li>Writes about towns</li></ul></section>"
    rows, want = [], {}
    for i in range(40):
        a, b = body(20), body(30)
        html = f"<main><article><p>{a}</p>{box}<div><p>{b}</p></div><p>{shared}</p>{author}</article></main>"
        rows.append((i, "http://h.example.org/", html))
        want[i] = f"{a}\n{b}\n{shared}"
    for i in range(40, 44):  # on few pages of its host a box is text
        rows.append((i, "http://few.example.org/", f"<article><p>{i}</p>{box}</article>"))
        want[i] = f"{i}\nJoin our club\nTen letters a year"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in extract(pages).collect()} == want


def test_empty(spark, frame):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(pages).collect() == []


@pytest.mark.parametrize("tag", ["div", "b", "p", "section"])
def test_deep_markup(tag):
    deep = "".join(f"<{tag}>" for _ in range(50_000)) + "inner text" + f"</{tag}>" * 50_000
    page = f"<body><article><p>first</p>{deep}<p>last</p></article><footer>no</footer></body>"
    text = main_text(page)
    assert text.split("\n")[0] == "first" and text.split("\n")[-1] == "last"
    assert "inner text" in text and "no" not in text.split()
