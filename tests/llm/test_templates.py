"""Template deduction: equivalence classes, extraction, hostile markup."""

import html as entities
import re
import time

import pyarrow.parquet as pq
import pytest

from numprof.llm import queries, templates

SF = "/root/testdata/sf0.01"


def page(body, title="T", article=True):
    inner = f"<article>{body}</article>" if article else f'<div class="content">{body}</div>'
    return (f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
            f'<header>Site name</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy {title}</div>{inner}'
            f'<aside>More</aside><div id="comments"><p>First!</p></div><footer>&copy; us</footer></body></html>')


@pytest.mark.parametrize("body,text", [
    ("<h1>A &amp; B</h1><p>one  two\n three</p><p>four<b>five</b></p>", "A & B\none two three\nfourfive"),
    ("<p><b>open<br><p>next", "open\nnext"),
    ("<div>x<nav>menu</nav>y</div><form>sign<input> up</form><p>z</p>", "x\ny\nz"),
    ('<p>keep</p><div class="cookie-notice">We use</div><section class="comments"><p>hi</p></section>', "keep"),
    ("<p>1 < 2 &lt;b&gt; &#x41;&#66;</p>", "1 < 2 <b> AB"),
    ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<script>if (a < b) {}</script><style>x</style><p hidden>no</p><p>yes</p>", "yes"),
    ('<p title="a > b" class="x">q</p>', "q"),
    ("", ""),
])
@pytest.mark.parametrize("copies", [1, 3, 6])
def test_article_pages(body, text, copies):
    pages = [page(body, f"t{k}") for k in range(copies)]
    assert templates.extract(pages) == [text] * copies


def test_without_a_main_element_template_words_go():
    pages = [page(f"<p>Share this page</p><p>story {k} has its words {'x' * k}</p>", article=False) for k in range(8)]
    got = templates.extract(pages)
    assert got == [f"story {k} has its words {'x' * k}".strip() for k in range(8)]


def test_text_shared_by_all_pages_stays_inside_the_article():
    assert templates.extract([page("<p>same words</p>")] * 9) == ["same words"] * 9


@pytest.mark.parametrize("text", ["<" * 20000, "<!--" * 5000, "<script>" * 3000, "<p>" * 20000 + "x", "<div>" * 5000 + "x" + "</div>" * 5000,
                                  "&" * 20000, "<b" * 5000, "</x>" * 9000, "<a b='" * 2000])
def test_hostile_markup_stays_fast(text):
    t = time.time()
    templates.extract([text, text])
    assert time.time() - t < 5


def brute(page_html):
    """The article of a page of the test tables, by plain text replacement."""
    article = page_html.split("<article>")[1].split("</article>")[0]
    cut = re.sub(r"</?(?:h1|p|br)>", "\n", article).replace("<b>", "")
    lines = [" ".join(entities.unescape(x).split()) for x in cut.split("\n")]
    return "\n".join(x for x in lines if x)


def test_query_against_brute_force(spark):
    rows = {r["page_id"]: r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = queries.op6_template_text(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == brute(rows[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == rows[r["page_id"]]["url"]


def test_groups_and_edges(spark, frame):
    rows = [(k, f"http://one.example/{k}", page(f"<p>story {k}</p>"), "x") for k in range(40)]
    rows += [(None, None, None, "x"), (50, "no url", "", "x"), (51, "http://two.example", "plain text", "x"), (51, "http://two.example", "plain text", "x")]
    out = templates.main_text(frame(rows, "page_id bigint, url string, html string, text string"), group_pages=4)
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["text"]) for r in out.collect())
    assert got == [(-1, "")] + [(k, f"story {k}") for k in range(40)] + [(50, ""), (51, "plain text"), (51, "plain text")]
    assert templates.main_text(frame([], "page_id bigint, url string, html string")).collect() == []


def mixed(k, wrap='<div id="wrap">'):
    """A page whose story is in a div, with framework text around it."""
    story = f"<h1>Headline {k}</h1><p>Story {k} tells at length of the {k} things that happened on day {k} of the year.</p>"
    return (f'<html><body><header>Site</header>{wrap}<div><p>You are reading the Daily</p><p>Written by our staff</p></div>'
            f'<div>{story}</div></div><footer>Us</footer></body></html>')


def test_texts_of_most_pages_are_the_template():
    """One odd page in twenty takes nothing from the classes of the others."""
    pages = [mixed(k) for k in range(19)] + ["<html><body><div><p>Not found 404</p></div></body></html>"]
    got = templates.extract(pages)
    assert got == [f"Headline {k}\nStory {k} tells at length of the {k} things that happened on day {k} of the year." for k in range(19)] + ["Not found 404"]


def test_texts_as_frequent_as_their_element_are_the_template():
    items = ["".join(f'<div class="item"><i>{j} of {k}</i><b>Read more</b><br></div>' for j in range(k % 3 + 1)) for k in range(9)]
    got = templates.extract([f"<html><body><div class='list'>{x}<div><u>Read more</u></div></div></body></html>".replace("</i><b>", "</i><br><b>") for x in items])
    assert got == ["\n".join(f"{j} of {k}" for j in range(k % 3 + 1)) for k in range(9)]


def test_template_text_counts_in_the_choice_of_slots():
    """A long constant text beside the article does not open the page up, nor
    does an article of constant text hide what varies beside it."""
    constant = "<div><p>" + "This notice of the house stands on every page. " * 20 + "</p></div>"
    pages = [f"<body>{constant}<article><p>Short {k}</p></article></body>" for k in range(6)]
    assert templates.extract(pages) == [f"Short {k}" for k in range(6)]
    pages = [f"<body><article><p>Subscribe to our letter</p></article><div><p>Story number {k}</p></div></body>" for k in range(6)]
    assert templates.extract(pages) == [f"Story number {k}" for k in range(6)]


@pytest.mark.parametrize("wrap", ['<div class="content no-comments">', '<div class="social-layout">', '<form id="login">', '<div class="has-sidebar">'])
@pytest.mark.parametrize("copies", [1, 8])
def test_wrappers_are_no_frames(wrap, copies):
    pages = [mixed(k, wrap).replace("<body>", "<body class='home has-sidebar'>") for k in range(copies)]
    for k, text in enumerate(templates.extract(pages)):
        assert text.endswith(f"Headline {k}\nStory {k} tells at length of the {k} things that happened on day {k} of the year.")


@pytest.mark.parametrize("copies", [1, 8])
def test_reader_comments_in_articles_are_left_out(copies):
    pages = [page(f"<p>Story {k}</p>").replace("<aside>", '<section class="comments">' + "".join(
        f'<article class="comment"><p>I think that {j} is more than {k}</p></article>' for j in range(9)) + "</section><aside>") for k in range(copies)]
    assert templates.extract(pages) == [f"Story {k}" for k in range(copies)]
    nested = [x.replace("<article>", "<div>").replace("</article><section", "</div><section") for x in pages]
    assert all(text.splitlines()[-1] == f"Story {k}" for k, text in enumerate(templates.extract(nested)))


@pytest.mark.parametrize("copies", [1, 8])
@pytest.mark.parametrize("around", ["aside", "div"])
def test_teaser_articles_do_not_hide_the_story(copies, around):
    cards = "".join(f"<article><p>Teaser {j} with a number of words of its own</p></article>" for j in range(8))
    pages = [mixed(k).replace("<footer>", f"<{around}>{cards.replace('Teaser', f'Teaser {k}')}</{around}><footer>") for k in range(copies)]
    for k, text in enumerate(templates.extract(pages)):
        assert f"Headline {k}\nStory {k} tells at length" in text
        assert ("Teaser" in text) == (around == "div")


def test_template_is_that_of_the_whole_host(spark, frame):
    """However few pages or bytes a step takes, the result is the host's; a group of two deduced nothing."""
    pages = [mixed(k) for k in range(10)]
    rows = [(k, f"http://one.example/{k}", x) for k, x in enumerate(pages)] + [(90, "http://two.example/", pages[0])]
    want = sorted([*enumerate(templates.extract(pages)), (90, templates.extract(pages[:1])[0])])
    assert "staff" not in want[0][1] and "staff" in want[-1][1]
    for options in ({}, {"group_pages": 2}, {"group_bytes": 500}):
        out = templates.main_text(frame(rows, "page_id bigint, url string, html string").repartition(5), **options)
        assert sorted((r["page_id"], r["text"]) for r in out.collect()) == want


RECIPE = "<h1>Cake {k}</h1><p>It is cake number {k} of the house.</p><h2>Ingredients</h2><p>{k} eggs and {k} apples</p>"


@pytest.mark.parametrize("others", [0, 1, 9])
def test_equal_pages_do_not_empty_each_other(spark, frame, others):
    pages = [mixed(0)] * 5 + [mixed(k) for k in range(1, others + 1)]
    want = templates.extract(pages)
    assert want[:5] == [want[0]] * 5 and want[0].endswith("Headline 0\nStory 0 tells at length of the 0 things that happened on day 0 of the year.")
    assert ("staff" in want[0]) == (others < 3)  # a host of under 4 distinct pages deduces no texts
    rows = [(k, f"http://one.example/{k}", x) for k, x in enumerate(pages)]
    out = templates.main_text(frame(rows, "page_id bigint, url string, html string").repartition(3))
    assert [r["text"] for r in out.orderBy("page_id").collect()] == want


def test_a_constant_heading_between_own_texts_stays():
    pages = [f'<body><header>Site</header><div class="content">{RECIPE.format(k=k)}</div><div><h3>About us</h3><p>We bake.</p></div></body>' for k in range(2, 9)]
    assert templates.extract(pages) == [f"Cake {k}\nIt is cake number {k} of the house.\nIngredients\n{k} eggs and {k} apples" for k in range(2, 9)]


def test_a_page_of_template_texts_alone_is_not_empty():
    same = "<body><div><p>Closed for the day</p></div></body>"
    pages = [same.replace("</body>", f"<div class=x><b>{k}</b></div></body>") for k in range(6)] + [same]
    assert templates.extract(pages)[-1] == "Closed for the day"


@pytest.mark.parametrize("name,frame_", [("social-history", False), ("legal-analysis", False), ("notice-of-death", False), ("social-links", True), ("comment-list", True),
                                         ("cookie-notice", True), ("site-footer", True), ("ad-slot-2", True), ("no-comments", False), ("related", True)])
@pytest.mark.parametrize("copies", [1, 6])
def test_compound_names_are_read_by_what_they_name(name, frame_, copies):
    pages = [page(f'<p>Before {k}</p><div class="{name}"><p>Inner words {k}</p></div><p>After {k}</p>') for k in range(copies)]
    want = [f"Before {k}\n" + ("" if frame_ else f"Inner words {k}\n") + f"After {k}" for k in range(copies)]
    assert templates.extract(pages) == want


def test_generated_ids_do_not_grow_a_host(spark, frame, monkeypatch):
    """Elements of one page each are folded into those around them; what a
    task gets of a host does not grow with its pages."""
    monkeypatch.setattr(templates, "ELEMENT_SHARE", 0.2)
    letters = ["".join(chr(97 + int(d)) for d in f"{k:03d}") for k in range(60)]
    pages = [mixed(k).replace("<div><h1>", f'<div id="{x}"><span class="q{x}"><h1>') for k, x in enumerate(letters)]
    rows = [(k, f"http://one.example/{k}", x) for k, x in enumerate(pages)]
    df = frame(rows, "page_id bigint, url string, html string")
    sizes = []
    fold = templates._folded
    monkeypatch.setattr(templates, "_folded", lambda e: (sizes.append((e.count(), fold(e).count(), e.agg({"chars": "sum"}).first()[0], fold(e).agg({"chars": "sum"}).first()[0])), fold(e))[1])
    out = {r["page_id"]: r["text"] for r in templates.main_text(df).collect()}
    before, after, chars, chars_after = sizes[0]
    assert before > 200 and after < 20 and chars == chars_after
    assert out == {k: f"Headline {k}\nStory {k} tells at length of the {k} things that happened on day {k} of the year." for k in range(60)}


def test_clashing_columns_and_empty_url(spark, frame):
    rows = [(1, None, "<p>a</p>", "h", 1), (2, "", "<p>b</p>", "h", 1), (2, "", "<p>b</p>", "h", 1), (3, None, None, "h", 1)]
    out = templates.main_text(frame(rows, "page_id int, url string, html string, host string, uid int"))
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(1, "a", 1), (2, "b", 1), (2, "b", 1), (3, "", 0)]
