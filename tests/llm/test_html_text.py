import pytest

from kerbcast.llm.html_text import BAD, GOOD, OPEN, main_text, main_texts, second_pass

BODY = "This is the text of the article and it is as long as an article would be, with all that one needs to read in it. " * 2


def page(inside, head="<title>T</title><style>p{}</style><script>var a='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{inside}</body></html>"


@pytest.mark.parametrize("outside", [
    "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav>", "<header><p>Site name and motto of the site</p></header>",
    "<footer>&copy; all rights of the site</footer>", "<aside><p>Also read this and that of ours</p></aside>",
    "<div class='ad'>Buy this now</div>", "<div id=cookie-banner>We use cookies and the like on this site</div>",
    "<form><label>Your name</label><input name=x><button>Send</button></form>", "<script>if (a < b) { x('<p>') }</script>",
    "<section class=\"comments\"><p>I think that this is the best of all the articles I have read in a long time.</p></section>",
    "<div style='display:none'>hidden words</div>", "<!-- <p>a comment</p> -->", "<noscript>No script here</noscript>",
])
def test_only_the_article_remains(outside):
    text = f"<h1>A title</h1><p>{BODY}</p><p>Short.</p>"
    pages = [page(f"{outside}<article>{text}</article>"), page(f"<article>{text}</article>{outside}")]
    if "<header" not in outside:  # a header inside an article holds its title
        pages.append(page(f"<article>{text}{outside}</article>"))
    for html in pages:
        assert main_text(html) == f"A title {BODY.strip()} Short."


def test_without_article_element_the_rules_decide():
    links = "".join(f"<li><a href='/{i}'>Place {i}</a></li>" for i in range(9))
    html = page(f"<ul>{links}</ul><div><p>{BODY}</p><p>Short one.</p><p>{BODY}</p></div><div><a href='/'>Back to the top</a></div>")
    assert main_text(html) == f"{BODY.strip()} Short one. {BODY.strip()}"


def test_references_space_and_broken_markup():
    html = page(f"<article><p>a &lt; b&amp;c &#233;&nbsp;&#x4e2d;\n\t d<p>un<b>closed <i>tags<br>here<p>{BODY}</article> & < after", head="")
    assert main_text(html) == f"a < b&c é 中 d unclosed tags here {BODY.strip()}"
    assert main_text("<article><p title='a > b'>text 1 < 2 and <3") == "text 1 < 2 and <3"
    assert main_text("<article>cut off <p") == "cut off"


def test_layout_names_are_not_boilerplate():
    assert main_text(page(f"<div class='has-sidebar'><main><p>{BODY}</p></main></div>")) == BODY.strip()


@pytest.mark.parametrize("start", [
    "<html><head><meta charset=utf-8><title>T</title><body>", "<head><title>T</title><link rel=x href=y>",
    "<head><noscript><style>p{}</style></noscript><script>x</script><body class='a'>", "<head><noscript><body>",
    "<head><title>T</title><img src=x>", "<html><head><title>T</title></head><body>"])
def test_a_head_left_open_ends_where_the_body_begins(start):
    assert main_text(f"{start}<div><p>{BODY}</p></div>") == BODY.strip()
    assert main_text(f"{start}{BODY}") == BODY.strip()


def test_attribute_values_of_any_length():
    for value in ("a > b " * 5_000, "x" * 5_000 + ">" + "y" * 90_000):
        for quote in "\"'":
            assert main_text(page(f"<article><p data-x={quote}{value}{quote} id=p>{BODY}</p></article>")) == BODY.strip()
    assert main_text(page(f"<article><p title=don't>{BODY}</p><p>It's all.</p></article>")) == f"{BODY.strip()} It's all."
    assert main_text(page(f"<article><p>{BODY}</p><p title=\"never closed>It is all.</p></article>")).endswith("It is all.")


def test_tags_take_linear_time():
    for part in ("<a b=\">\"", "<a b='>' c=\"", "<a b=", "<a =\"", "<head>"):
        main_text(part * 60_000)


PROSE = "The text of this page is not in an article, and it is what one would read if one came to the page for it. " * 5


def test_text_outside_a_short_article():
    card = f"<article><h3>Card</h3><p>{BODY}</p></article>"
    for html in (page(f"<div><p>{PROSE}</p></div>{card}"), page(f"{card}<div><p>{PROSE}</p></div>")):
        assert PROSE.strip() in main_text(html)
    comment = f"<article class='comment'><p>{BODY}</p></article>"
    assert main_text(page(f"<div><p>{PROSE}</p></div>{comment}")) == PROSE.strip()
    assert PROSE.strip() in main_text(page(f"<div><p>{PROSE}</p></div><article><p>{BODY * 9}</p></article>"))


def test_unmarked_boilerplate_inside_main():
    menu = "<div>Home News Sport Weather Travel Culture Business Opinion Video Podcasts Shop Jobs Archive</div>"
    listed = "<p>Apples, pears, plums, cherries, quinces, apricots, peaches, medlars, walnuts, hazelnuts.</p>"
    html = page(f"<main>{menu}<div>Shop Jobs</div><h1>A title</h1><p>{BODY}</p>{listed}<p>Short.</p></main>")
    assert main_text(html) == f"A title {BODY.strip()} {listed[3:-4]} Short."


def test_pages_without_stop_words_keep_their_article():
    text = "日本語の文章です。" * 12
    assert main_text(page(f"<div>メニュー</div><article><p>{text}</p><p>短い。</p></article>")) == f"{text} 短い。"


def test_open_blocks_take_the_nearest_label():
    assert second_pass([GOOD, OPEN, OPEN, BAD, OPEN], [9] * 5) == [GOOD, GOOD, BAD, BAD, BAD]
    assert second_pass([GOOD, OPEN, BAD], [9, 1, 5]) == [GOOD, GOOD, BAD]
    assert second_pass([OPEN, OPEN], [100, 10]) == [GOOD, BAD]


def test_tables(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", page(f"<article>{BODY}</article>"), "x"), (3, "u", "<" * 20_000, "x"),
            (3, "u", "<" * 20_000, "x"), (4, "u", "<a b='" * 3_000, "x"), (5, "u", "<article>" + "<p>x " * 30_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_texts(pages).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[None] == BODY.strip()
    assert {r.page_id: r.n_chars for r in got}[5] == 59_999
    assert main_texts(pages.limit(0)).count() == 0


PROSE = ("The harbour was quiet when the boats came in, and the men who had been out all night said that they had seen "
         "nothing of the storm. It had passed to the north, as it often does in that part of the year, and by noon the "
         "market was open again. Nobody there would have known that it had been so near, but for the wind.")


@pytest.mark.parametrize("before, after", [
    ('<body class="overflow-hidden">', "</body>"), ('<div class="overflow-hidden">', "</div>"),
    ('<article data-state="not hidden">', "</article>"), ('<form id="aspnetForm">', "</form>"),
    ('<div class="search-result">', "</div>"), ('<div class="legal-news">', "</div>"),
    ('<div class="page-menu">', "</div>"), ('<div hidden="until-found">', "</div>")])
def test_wrappers_keep_their_text(before, after):
    page = f"<html><nav><a href=x>Home</a></nav>{before}<p>{PROSE}</p>{after}<footer>Imprint</footer></html>"
    assert main_text(page) == PROSE


@pytest.mark.parametrize("before, after", [
    ("<div hidden>", "</div>"), ('<div style="color:red; display : none">', "</div>"), ('<div aria-hidden=true>', "</div>"),
    ('<div class="cookie-box">', "</div>"), ('<div id="page-sidebar">', "</div>"), ('<div class="comments">', "</div>"),
    ("<form>", "</form>"), ('<div class="newsletter-signup">', "</div>")])
def test_marked_elements_beside_the_text_go(before, after):
    note = "You can read more of this if you leave us your address, and we will write to you when there is news."
    page = f"<html><body><p>{PROSE}</p>{before}<p>{note}</p>{after}</body></html>"
    assert main_text(page) == PROSE


def test_long_comments_are_no_wrapper():
    note = "I was there as well, and what the paper says of it is not what the men told us on the quay that day. "
    page = f"<html><body><p>{PROSE}</p><div class='comments'><p>{note * 20}</p></div></body></html>"
    assert main_text(page) == PROSE
