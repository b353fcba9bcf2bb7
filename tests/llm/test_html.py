from hypothesis import given, settings
from hypothesis import strategies as st

from streamlens.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body class="page comments-open"><header><h1>Site name, the best, of all sites</h1></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, many of them, and more than you like, yes.</p></div>
<div id="main-content"><h2>Title &amp; more</h2><p>First paragraph, with commas, and&nbsp;enough length to count.
<p>Second <b>one, <i>unclosed</b> here, that goes on for some more words.<br>And a break.
<ul><li>one<li>two</ul><div class="ad-box">Buy, buy, buy this now, it is really cheap today</div>
<form><p>Your name, your mail, your life, please, it is only a form</p></form>
<blockquote>Quoted, said someone.</blockquote></div>
<aside><p>Sidebar, with, lots, of, commas, and a good length to be scored</p></aside>
<section class="comments"><p>Nice post, thanks, I like it, and so do all of my friends!</p></section>
<footer>&copy; us</footer></body></html>"""


def test_article_without_the_rest():
    assert html.main_text(PAGE).split("\n\n") == [
        "Title & more",
        "First paragraph, with commas, and enough length to count.",
        "Second one, unclosed here, that goes on for some more words. And a break.",
        "one",
        "two",
        "Quoted, said someone.",
    ]


def test_article_in_sections_is_one():
    page = "<article><h1>T</h1><section><p>%s</p></section><section><p>Short.</p></section></article>"
    assert html.main_text(page % ("word, " * 30)).endswith("word,\n\nShort.")


def test_links_do_not_make_an_article():
    links = "".join(f"<p><a href=x>Link, with commas, and a fairly long text number {i}</a></p>" for i in range(20))
    page = f"<div>{links}</div><div><p>{'Real words, here. ' * 5}</p><p>{'More words, there. ' * 5}</p></div>"
    assert "Link" not in html.main_text(page)


def test_names_of_parts():
    text = "Enough words, of some length, to be a paragraph of its own."
    for name in ("comment-content", "post-comments", "main-menu", "sidebarRight", "related_posts", "x ad-slot-3", "Cookie-Notice"):
        for attr in ("class", "id"):
            page = f"<body><p>{text}</p><div {attr}='{name}'><p>{text.upper()}</p></div></body>"
            assert html.main_text(page) == text, name
    for name in ("content with-sidebar", "no-comments", "article-header", "main", "adele", "readable", "thread"):
        page = f"<body><div class='{name}'><p>{text}</p></div></body>"
        assert html.main_text(page) == text, name


def test_broken_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<!-- x") == ""
    assert html.main_text("just text") == "just text"
    assert html.main_text("<p>cut <b>off in the mid") == "cut off in the mid"
    assert html.main_text("a < b && c &lt; d") == "a < b && c < d"
    deep = "<div>" * 20_000 + "the bottom of it, at last" + "</div>" * 10
    assert html.main_text(deep) == "the bottom of it, at last"
    long = "<p>" + "x, " * 500_000 + "</p>"
    assert html.main_text(long).count("x,") == 500_000


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/ap div='\"&!-#;li", max_size=60))
def test_no_page_breaks_it(page):
    text = html.main_text(page)
    assert text == text.strip() and "  " not in text


def test_operator(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extract(pages).collect()
    assert sorted((r.page_id or 0, r.url, r.n_chars) for r in found if r.url) == [
        (0, "v", 0), (1, "u", len(html.main_text(PAGE))), (1, "u", len(html.main_text(PAGE)))
    ]
    assert all(r.n_chars == len(r.text) for r in found) and len(found) == 4
    assert html.extract(pages.limit(0)).count() == 0


def tag_end(page, at):
    """Where a tag that starts at ``at`` ends, read sign by sign."""
    i = at + 1
    while i < len(page) and page[i] not in " \t\n\f\r\v/>":
        i += 1
    while i < len(page) and page[i] != ">":
        if page[i] == "=":
            j = i + 1
            while j < len(page) and page[j].isspace():
                j += 1
            if j < len(page) and page[j] in "\"'":
                close = page.find(page[j], j + 1)
                if close > 0 and (close + 1 == len(page) or page[close + 1] in "/>" or page[close + 1].isspace()):
                    i = close + 1
                    continue
        i += 1
    return min(i + 1, len(page))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab=\"'> /\n<", max_size=30))
def test_a_tag_ends_where_a_plain_reading_ends_it(rest):
    page = "<p" + rest
    assert html._TOKEN.match(page).end() == tag_end(page, 0)


def test_odd_quote_signs_in_tags():
    text = "Enough words, of some length, to be a paragraph of its own."
    for tag in ("<p title=\"abc>", "<p title=it's>", "<p it's class=x>", "<p \">", "<p a='b' c=\"d>", "<p a=\"x > y\">", "<p a = 'it\"s > b' >"):
        page = f"<body>{tag}{text} <a title=it's href=x>Don't</a> lose it.</p><p class=\"z\">{text}</p></body>"
        assert html.main_text(page).split("\n\n") == [f"{text} Don't lose it.", text], tag
