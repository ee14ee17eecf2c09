"""Main text of pages: the given pages by a plain reading of their one article, and written pages."""

import html
import re
import time

import pytest

from costalloc.llm import extract
from tests.conftest import SMALL


def plain(page):
    """These pages hold one article of blocks; its tags are read off."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)[^>]*>", article)
    told = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks)
    return "\n\n".join(t for t in told if t)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    assert {p: r.text for p, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


LONG = "This is a sentence of some length that tells the reader something about the matter at hand. " * 3
AROUND = (
    "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>{}<aside><p>" + LONG + "</aside>"
    "<div class='cookie-notice'><p>" + LONG + "</div><form><p>Write <input name=x> to us</form>"
    "<section id=comments><article><p>" + LONG + "</article></section><footer>&copy; us</footer>"
)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("<p>", ""),
        ("a &amp; b &lt;c&gt; &#233;&nbsp;&#x4e2d; &unknown; &am", "a & b <c> é 中 &unknown; &am"),
        (AROUND.format("<main><h2>T</h2><p>A\n b<br>c</p><p>x</p></main>"), "T\n\nA b c\n\nx"),
        (AROUND.format(f"<div class='content'><h2>Head</h2><p>{LONG}<p>Short.<p>{LONG}</div>"), f"Head\n\n{LONG.strip()}\n\nShort.\n\n{LONG.strip()}"),
        (f"<body class='has-sidebar'><article><header><h1>T</h1></header><p>{LONG}<div class=ad>Buy</div><p>b</article>", f"T\n\n{LONG.strip()}\n\nb"),
        (f"<article><p>{LONG}</p><noscript><div>x</div></noscript><script>var a='<p>'</script><style>p{{}}</style><p>end</article>", f"{LONG.strip()}\n\nend"),
        (f"<form id=all><div><p>{LONG}</p><p>{LONG}</p></div></form>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<head><title>t</title><p>{LONG}", LONG.strip()),
        ("<ul><li>one<li>two</ul>", "one\n\ntwo"),
        ("<article><section><p>" + LONG + "</section><section><p>short</section></article>", LONG.strip() + "\n\nshort"),
        ("<!-- c --><article><p>a<!-- x -->b</p><![CDATA[z]]></article>", "ab"),
    ],
)
def test_written_pages(page, want):
    assert extract.main_text(page) == want


def test_odd_rows(spark):
    rows = [(1, None, None, "t"), (None, "u", "", "t"), (2, "v", "<p>x", "t"), (2, "v", "<p>x", "t"), (3, "w", "<p>" + "long text " * 50_000, "t"),
            (4, "d", "<div>" * 3000 + "deep", "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 1, 1, 4, 499_999]
    assert extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "wrapper",
    ["<div class='elementor-widget-container'>{}</div>", "<div id=header-fixed-layout>{}</div>", "<article class='post category-legal'>{}</article>",
     "<article class=tag-promo>{}</article>", "<section id=related-work>{}</section>", "<div class=site-banner><article>{}</article></div>",
     "<p>By <span class=ad>us</span> and more</p><div>{}</div>", "<div class=promo><div class=social-box>{}</div></div>"],
)
def test_names_do_not_shut_the_main_text(wrapper):
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    got = extract.main_text(f"<body><nav><a href=/>Home</a></nav>{wrapper.format(body)}<div class=cookie-notice>{LONG}</div></body>")
    assert got.endswith(f"{LONG.strip()}\n\n{LONG.strip()}") and got.count(LONG.strip()) == 2


def test_a_page_of_shut_elements_only():
    assert extract.main_text(f"<div class=comments><p>{LONG}</p></div>") == LONG.strip()


def test_unmarked_menus_in_the_region_go():
    menu = "<div><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div>"
    body = f"<h2>Head</h2><p>{LONG}</p><p>{LONG} with <a href=/x>a link</a></p><p>{LONG}</p>"
    want = f"Head\n\n{LONG.strip()}\n\n{LONG.strip()} with a link\n\n{LONG.strip()}"
    assert extract.main_text(f"<body><div>{menu}{body}{menu}</div></body>") == want
    teaser = f"<div><p><a href=/t>Read this:</a> {LONG}</p><div><a href=/a>one</a> <a href=/b>two</a></div></div>"
    assert "one two" not in extract.main_text(f"<body><article>{body}</article>{teaser}</body>")


@pytest.mark.parametrize("part", ["<p id=share-prices>{}</p>", "<section id=copyright-law><p>{}</p></section>", "<section id=discussion><p>{}</p></section>", "<div class=notice-text>{}</div>"])
def test_parts_of_an_article_with_names_like_those_of_notices(part):
    text = "Something of this part that matters."
    assert text in extract.main_text(f"<article><p>{LONG}</p>{part.format(text)}<p>{LONG}</p></article>")


def test_broken_pages_take_linear_time():
    def took(n):
        start = time.perf_counter()
        got = extract.main_text("<article><p>" + "<font>" * n + LONG + "</b>" * n + "<p>end")
        assert got == f"{LONG.strip()}\n\nend"
        return time.perf_counter() - start

    took(100)
    assert took(32_000) < 20 * max(took(4_000), 0.02)


@pytest.mark.parametrize(
    ("page", "parts"),
    [
        ("<main><p>{0} a</p><article><p>{0} b</p><p>{0} c</p></article></main>", "abc"),
        ("<main><article><p>{0} a</p><p>{0} b</p><p>{0} c</p></article><article><p>{0} d</p><p>{0} e</p></article></main>", "abcde"),
        ("<article><p>{0} a</p><article><p>{0} b</p><p>{0} c</p></article><p>{0} d</p></article>", "abcd"),
        ("<div><div><p>{0} a</p></div><div><p>{0} b</p>" + "".join(f"<p>{{0}} {c}</p>" for c in "cdefghijklm") + "</div></div>", "abcdefghijklm"),
    ],
)
def test_all_content_lines_are_in_the_text(page, parts):
    around = "<nav><a href=/>Home</a></nav>{}<div class=cookie-notice><p>" + LONG + "</div><footer>us</footer>"
    got = extract.main_text(around.format(page.format(LONG)))
    assert got.split("\n\n") == [f"{LONG.strip()} {c}" for c in parts]
