import html
import math
import re

import pytest

from stellate.llm.html_text import extract_pages, main_text, path_scores, steps
from tests.llm.helpers import frame, prose

LONG = "A sentence with several words, and a clause; it goes on. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var x='</p><p>no';</script></head><body>{body}</body></html>"


def test_article_of_a_usual_page():
    body = f"<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy, now.</div><article><h1>Title</h1><p><b>One &lt; two<br>three</p><p>{LONG}</p></article><aside>More</aside><footer>&copy; x</footer>"
    assert main_text(page(body)) == f"Title One < two three {LONG.strip()}"


@pytest.mark.parametrize("junk", [
    "<div class='comments'><p>Nice post, I liked it. Really, very much.</p></div>", "<section id='comment-list'><article class='comment'><p>First, and so on. And on.</p></article></section>",
    "<div class='cookie-notice'><p>We use cookies, as all do. Accept?</p></div>", "<form><p>Your name, please.</p><textarea>text, text.</textarea></form>",
    "<div role='complementary'><p>Related things, many. Others too.</p></div>", "<div class='sidebarBox sidebar'><p>Latest, news. Items.</p></div>",
    "<!-- a comment, with. punctuation --><script>if (a < b) { c(); }</script><style>.x{}</style><noscript>Enable, please.</noscript>", "<aside><p>Aside, from that.</p></aside>",
    "<div hidden><p>Not, shown. At all.</p></div>", "<div style='display: none'><p>Not, shown. At all.</p></div>", "<ul class='share-buttons'><li><a href='#'>Share</a></li></ul>",
])
@pytest.mark.parametrize("inside", [True, False])
def test_what_is_not_the_article_goes(junk, inside):
    text = f"<h2>Head</h2><p>{LONG}</p>{junk if inside else ''}<p>{LONG * 2}</p>"
    assert main_text(page(f"<div><article>{text}</article>{'' if inside else junk}</div>")) == f"Head {LONG.strip()} {(LONG * 2).strip()}"


def test_layout_classes_do_not_drop_the_article():
    assert main_text(page(f"<div class='layout has-sidebar no-header'><article class='post'><p>{LONG}</p></article><div class='commentlist'><p>{LONG}</p></div></div>")) == LONG.strip()


@pytest.mark.parametrize("junk", ["sidebar no-print", "ad no-mobile", "comments with-avatars", "no-print sidebar", "sidebar-no-print"])
def test_layout_words_cancel_only_the_word_after_them(junk):
    assert main_text(page(f"<article><div class='has-sidebar'><p>{LONG}</p></div><div class='{junk}'><p>Latest, news. Items.</p></div></article>")) == LONG.strip()


@pytest.mark.parametrize("part", [
    "<div class='elementor-widget'>{}</div>", "<div id='cookie-recipe'>{}</div>", "<div class='commentary'>{}</div>", "<section class='elementor-widget-wrap share-price'>{}</section>",
])
def test_weak_marks_do_not_drop_content(part):
    for outer in ("<article>{}</article>", "<div class='page'>{}</div>"):
        assert main_text(page(outer.format(part.format(f"<h2>Head</h2><p>{LONG}</p><p>{LONG * 2}</p>")))) == f"Head {LONG.strip()} {(LONG * 2).strip()}"


def test_parts_of_an_article_stay():
    for name in ("entry-header", "post-header"):
        assert main_text(page(f"<article><h1 class='{name}'>Title</h1><div class='{name}'><h2>Second</h2></div><p>{LONG}</p></article>")) == f"Title Second {LONG.strip()}"
    table = "".join(f"<tr><td>Firm {i}</td><td>{i}.50</td></tr>" for i in range(40))
    cells = " ".join(f"Firm {i} {i}.50" for i in range(40))
    assert main_text(page(f"<article><p>{LONG * 3}</p><table class='share-price'>{table}</table><p>{LONG}</p></article>")) == f"{(LONG * 3).strip()} {cells} {LONG.strip()}"
    assert main_text(page(f"<article><header><h1>T</h1><p>What follows, in one sentence.</p><p class='byline'>By Jo Doe</p></header><p>{LONG}</p></article>")) == f"T What follows, in one sentence. {LONG.strip()}"


@pytest.mark.parametrize("junk", [
    "<span style='display:none'>gone, all. of it</span>", "<span class='ad'>Buy <span>this</span>, now.</span>", "<ins class='adsbygoogle'>Ad, text.</ins>",
    "<b hidden>gone</b>", "<cookie-banner>We use cookies.</cookie-banner>", "<span class='ad'><br>cut <i>in</i> <img src='x'></span>",
])
def test_marks_on_inline_elements(junk):
    assert main_text(page(f"<article><p>One {junk}two.</p><p>{LONG}</p></article>")) == f"One two. {LONG.strip()}"


def test_teasers_beside_an_article_go():
    card = "<article class='card'><h3><a href='/x'>Other story</a></h3><p>Its first words, in short.</p></article>"
    for wrap in ("<div>{}</div>", "<main>{}</main>"):
        assert main_text(page(wrap.format(f"<article class='post'><h1>T</h1><p>{LONG * 5}</p></article>{card * 6}"))) == f"T {(LONG * 5).strip()}"
    assert main_text(page(card * 3)) == " ".join(["Other story Its first words, in short."] * 3)


def test_link_lists_in_an_article_go_by_score():
    assert main_text(page(f"<article><p>{LONG} <a href='/s'>source</a></p><ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul><h2><a href='#h'>Head</a></h2><p>{LONG}</p></article>")) == f"{LONG.strip()} source Head {LONG.strip()}"


def test_every_content_root_is_kept():
    two = f"<div><article class='post-1'><p>One. {LONG * 3}</p></article><article class='post-2'><h2>Two</h2><p>{LONG}</p></article></div>"
    assert main_text(page(two)) == f"One. {(LONG * 3).strip()} Two {LONG.strip()}"
    lead = f"<main><h1>Title</h1><p>Lead. {LONG}</p><article><p>{LONG * 2}</p></article></main>"
    assert main_text(page(lead)) == f"Title Lead. {LONG.strip()} {(LONG * 2).strip()}"


def test_without_article_all_content_is_kept():
    body = f"<div class='a'>{f'<p>{LONG * 2}</p>' * 20}</div><div class='b'><p>Last, {LONG * 2}</p></div>"
    assert main_text(page(body)) == " ".join([(LONG * 2).strip()] * 20 + [f"Last, {(LONG * 2).strip()}"])


def test_without_article_element():
    body = f"<div class='top'><a href='/a'>One</a> <a href='/b'>Two</a></div><div class='content'><h1>Title</h1><p>{LONG}</p><ul><li>an item, too</li></ul><p>{LONG * 3}</p></div><div class='links'><a href='/x'>Read this</a></div>"
    assert main_text(page(body)) == f"Title {LONG.strip()} an item, too {(LONG * 3).strip()}"


def test_odd_markup():
    assert main_text("plain text &lt; 5 < 6 &am &amp") == "plain text < 5 < 6 &am &"
    assert main_text("<p>a<p>b <!-- cut") == "a b"
    assert main_text("<article><p>a&nbsp;\n\t b</p><p cut") == "a b"
    assert main_text("<article><table><tr><td>c1<td>c2</table><p>x<i>y</i>z</article>") == "c1 c2 xyz"
    assert main_text(None) == main_text("") == main_text("<html><body><nav>x</nav></body></html>") == ""
    assert main_text("<article><header><h1>T</h1><p>By me</p></header><p>Text one.</p></article>") == "T Text one."


def test_very_long_page():
    text = prose(1, 60000)
    assert main_text(page(f"<article><p>{html.escape(text)}</p></article>")) == text
    assert len(main_text("<div>" * 3000 + "deep" + "</div>" * 3000)) == 4


def test_scores_prefer_long_punctuated_paths():
    assert steps(("a", "b", "c"), ("a", "b", "d")) == 2 and steps(("a",), ("a", "b")) == 1
    scores = path_scores([(("body", "div", "p"), LONG * 3, 0, "p"), (("body", "div", "p"), LONG, 0, "p"), (("body", "ul", "li"), "Home", 4, "li"), (("body", "div", "h1"), "Title", 0, "h1")])
    assert scores["body", "div", "p"] > scores["body", "div", "h1"] > scores["body", "ul", "li"] == 0


def test_all_paths_smooth():
    """Brute force over all pairs of paths, on a page with a class of its own for each paragraph."""
    blocks = [(("body", f"div.s{i % 7}", f"p.c{i}"), LONG * (1 + i % 5) + "x" * i, i % 3, "p") for i in range(600)] + [(("body", "ul", "li"), "Home", 4, "li"), (("body",), "a, b", 0, "body")]
    scores = path_scores(blocks)
    for p, t, link, _ in blocks[::50] + blocks[-2:]:
        weight = [math.exp(-steps(p, q) ** 2 / 2) for q, *_ in blocks]
        size, marks = (sum(w * f(x) for w, (_, x, *_) in zip(weight, blocks, strict=True)) / sum(weight) for f in (len, lambda x: len(re.findall("[.,;]", x))))
        assert math.isclose(scores[p], size * (1 + marks) * (1 - link / len(t)), rel_tol=1e-9, abs_tol=1e-9)


def test_given_pages_against_their_markup(spark):
    """Brute force for the given tables' pages: whatever stands inside the article element."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r["page_id"]: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        body = r["html"][r["html"].index("<article>") + 9 : r["html"].rindex("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        expect = " ".join(b for b in blocks if b)
        assert (rows[r["page_id"]]["text"], rows[r["page_id"]]["n_chars"], rows[r["page_id"]]["url"]) == (expect, len(expect), r["url"])


def test_rows(spark):
    rows = extract_pages(frame(spark, [(1, None, None), (None, "u", "<p>é</p>"), (1, None, None)], "page_id bigint, url string, html string")).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in rows) == [("1", "", 0), ("1", "", 0), ("None", "é", 1)]
    assert extract_pages(frame(spark, [], "page_id bigint, url string, html string")).count() == 0
