import random

import pytest

from stratalake.llm.html_text import extract, main_text, measure, parse, select

SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, and a long text of the law says that we must tell you so at length, really at length.</div>
{body}
<aside>Sidebar with a fairly long text that nobody wants to read in the middle of an article.</aside>
<form><label>Mail</label><input name=q><button>Go</button></form>
<div id="comments"><div class="comment"><p>A reader says that the article is wrong in every single one of its points.</p></div></div>
<footer>&copy; Site</footer></body></html>"""
ARTICLE = "<h1>Title &amp; more</h1><p>First   <b>bold</b>\n words,&nbsp;long enough to be a paragraph of text.</p><p>Short.</p><ul><li>one<li>two</ul>"
TEXT = "Title & more\nFirst bold words, long enough to be a paragraph of text.\nShort.\none\ntwo"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "<div class=wrap><section>{}</section></div>", "<div><div role=main>{}</div></div>"])
def test_article_without_the_rest(wrap):
    assert main_text(SITE.format(body=wrap.format(ARTICLE))) == TEXT


def test_truncated_page():
    page = SITE.format(body=f"<article>{ARTICLE}<p>Last &am")
    assert main_text(page[: page.index("Last &am") + 8]) == TEXT + "\nLast &am"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("<nav>Menu</nav>", ""), ("plain <3 text & co", "plain <3 text & co"),
        ("<p>a<p>b", "a\nb"), ("<p>a<br>b</p>", "a b"), ("<p>x &lt;b&gt; y</p>", "x <b> y"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<p don't>kept</p>", "kept"), ('<p title="a>b">kept</p>', "kept"), ("</div></p><p>ok</b></p>", "ok"),
        ("<script>alert('x')", ""), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"), ("<p>ab<i>c</i>d</p>", "abcd"), ("a\x00b", "a\x00b"),
    ],
)
def test_defined_results(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 30_000 + "deep") == "deep"
    words = "word " * 200_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()
    assert len(main_text("<p>x" * 50_000).split("\n")) == 50_000


def test_densities():
    root = parse("<div><p>" + "a" * 100 + "</p><p><a href=x>" + "b" * 50 + "</a></p></div>")
    nodes = {n.tag: n for n in measure(root)}
    assert nodes["div"].chars == 150 and nodes["div"].link_chars == 50
    text, link = [n for n in measure(root) if n.tag == "p"]
    assert text.density == 100 and link.density < 1
    assert [n.tag for n in select(root)] == ["div"]


def test_table(spark):
    rows = [(1, "u", "<p>a</p>", "own", 5), (1, "u", "<p>a</p>", "own", 5), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _text int")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "html", "_text", "text"]
    assert sorted((r["page_id"] or 0, r["text"], r["_text"] or 0) for r in got.collect()) == [(0, "", 0), (1, "a", 5), (1, "a", 5)]
    assert extract(pages.limit(0)).count() == 0


LONG = "A sentence of the main text that is long enough to be dense and goes on for a while, as sentences do. "


def test_a_teaser_article_does_not_replace_the_text():
    paragraphs = [f"{i} {LONG * 3}".strip() for i in range(8)]
    body = "<div id=content>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"
    page = SITE.format(body=f"<article><h3>More</h3><p><a href=/x>Read it</a></p></article>{body}")
    assert main_text(page) == "\n".join(paragraphs)


def test_sibling_articles_are_all_kept():
    entries = [[f"{k}.{i} {LONG * 2}".strip() for i in range(4)] for k in range(4)]
    articles = "".join("<article><h2>Title</h2>" + "".join(f"<p>{p}</p>" for p in e) + "</article>" for e in entries)
    articles += "<article><p><a href=/x>Older</a></p></article>"
    assert main_text(SITE.format(body=articles)) == "\n".join("\n".join(["Title", *e]) for e in entries)


@pytest.mark.parametrize("wrap", ["{bare}<div>{text}</div>", "<div>{bare}<section>{text}</section></div>", "<span>{bare}<section>{text}</section></span>"])
def test_bare_text_on_the_path_is_judged(wrap):
    paragraphs = [f"{i} {LONG * 2}".strip() for i in range(12)]
    text = "".join(f"<p>{p}</p>" for p in paragraphs)
    bare, plain = f"{LONG * 3}with <b>bold</b> words", f"{LONG * 3}with bold words"
    assert main_text(wrap.format(bare=bare, text=text)) == "\n".join([plain, *paragraphs])
    assert main_text(wrap.format(bare="Skip", text=text)) == "\n".join(paragraphs)


def test_a_paragraph_is_not_cut_within():
    lines = "<br>".join([LONG] * 30)
    page = f"<div>Bare words before. <span>{lines}</span> And after.</div>"
    assert main_text(page) == " ".join(["Bare words before.", *[LONG.strip()] * 30, "And after."])


WRAPS = [
    '<div class="content has-sidebar">{}</div>', '<div class="layout no-sidebar">{}</div>', '<article class="post no-comments">{}</article>',
    '<main class="with-banner">{}</main>', '<div class="post side-padding">{}</div>', "<form action=/x>{}</form>", '<div class="plain">{}</div>',
    '<main class="search">{}</main>',
]


@pytest.mark.parametrize("wrap", WRAPS)
def test_names_of_layout_cut_nothing(wrap):
    paragraphs = [f"{i} {LONG}".strip() for i in range(8)]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    assert main_text(SITE.format(body=wrap.format(body))) == "\n".join(paragraphs)


@pytest.mark.parametrize("name", ['id="search-algorithms"', 'class="share-price-table"', 'class="related-work"', 'id="menu-of-the-day"'])
def test_names_of_topics_cut_nothing(name):
    part = f"Within. {LONG}".strip()
    body = f"<article><p>{LONG}</p><section {name}><p>{part}</p></section><p>{LONG}</p></article>"
    assert part in main_text(SITE.format(body=body)).split("\n")


@pytest.mark.parametrize(
    "name",
    ["ad", "sidebar", "widget-area", "post-comments", "comment-list", "cookie-notice", "social share-buttons", "site-footer", "newsletter-signup-box", "top-ad x1"],
)
def test_names_of_boilerplate_cut(name):
    body = f"<div><p>{LONG}</p><p>{LONG}</p><div class='{name}'><p>Unwanted. {LONG}</p></div><p>{LONG}</p></div>"
    assert main_text(SITE.format(body=body)) == "\n".join([LONG.strip()] * 3)


def test_a_form_of_the_page_is_cut_even_if_it_is_long():
    body = f"<article><p>{LONG * 3}</p></article><form><p>Write to us. {LONG * 2}</p><input name=a></form>"
    assert main_text(SITE.format(body=body)) == (LONG * 3).strip()


def plain_densities(node):
    """Densities and sums by recursion: tag, chars, density, total in page order."""
    import html
    import math

    kids = lambda n: [x for x in n.children if not isinstance(x, str) and not x.cut]

    def chars(n):
        return sum(len(" ".join(html.unescape(x).split())) for x in n.children if isinstance(x, str)) + sum(map(chars, kids(n)))

    def tags(n):
        return sum((x.tag != "") + tags(x) for x in kids(n))

    def links(n):
        return (chars(n), 1 + sum(links(x)[1] for x in kids(n))) if n.tag == "a" else tuple(map(sum, zip((0, 0), *map(links, kids(n)))))

    share = links(node)[0] / chars(node) if chars(node) else 0

    def density(n):
        c, t, (lc, lt) = chars(n), max(tags(n), 1), links(n)
        if not c or not lc:
            return c / t
        return max(0.0, c / t * math.log(max(c / lc * t / max(lt, 1), 1.0)) / math.log(c / max(c - lc, 1) * lc + share * c + math.e))

    def total(n):
        own = sum(len(x.strip()) for x in n.children if isinstance(x, str)) if n.tag != "a" else 0
        return own + sum(total(x) if x.tag == "" else density(x) for x in kids(n))

    def walk(n):
        return [(n.tag, chars(n), density(n), total(n)), *(y for x in kids(n) for y in walk(x))]

    return walk(node)


def test_densities_as_by_recursion():
    rng = random.Random(4)

    def part(depth):
        tag = rng.choice(["div", "p", "a", "span", "ul", "section", "b", "nav"])
        inner = "".join(rng.choice([part(depth - 1) if depth else "x", f"word {rng.randint(0, 999)} &amp; ", " "]) for _ in range(rng.randint(0, 5)))
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(200):
        root = parse(part(5))
        got = [(n.tag, n.chars, n.density, n.total) for n in measure(root)]
        want = plain_densities(root)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(a - b) < 1e-9 * max(1, abs(b)) for g, w in zip(got, want) for a, b in zip(g[2:], w[2:]))
