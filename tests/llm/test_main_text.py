import pytest

from labrelay.llm.main_text import extracted, main_text

LONG = "A sentence of the article that goes on for quite a while, so that it is text and nothing else."


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words", "plain words"),
    ("<html><head><title>T</title><script>var t='</p>x';</script><style>p{}</style></head><body><nav><a href=/a>a</a></nav>"
     f"<!-- ad --><div class='ad'>Buy</div><article><h1>Head &amp; more</h1><p><b>{LONG}<br>next<p>Two\n  words</p></article>"
     "<footer>&copy; x</footer>", f"Head & more\n{LONG} next\nTwo words"),
    (f"<body><header>Site</header><main><header><h1>Title</h1></header><p>{LONG}</p><aside>Side</aside><form>f</form>"
     f"<div class='cookie-notice'>Cookies</div><section id='comments'><p>{LONG}</p></section></main></body>", f"Title\n{LONG}"),
    (f"<div class=sidebar><p>{LONG}</p></div><div id=story><p>{LONG}</p><p>End.</p></div>"
     "<div><a href=1>x</a><a href=2>y</a><a href=3>z</a></div>", f"{LONG}\nEnd."),
    (f"<nav><a>m</a><article><p>{LONG}</p></article>", LONG),  # a menu that was never closed
    (f"<article><p>{LONG}</div> on</p></article>", f"{LONG}\non"),
    (f"<article><p>{LONG}</p><p>cut off &am", f"{LONG}\ncut off &am"),
    (f"<head><title>T</title><p>{LONG}", LONG),
    # layout classes, an article's own head, names in camel case and of single paragraphs
    (f"<div class='wrap has-sidebar'><article><div class='entry-header'><h1>T</h1></div><p>{LONG}</p><p class=advert>Buy</p>"
     f"<p>End.</p><div class=userComments><p>{LONG}</p></div></article><div class=sidebar>x</div></div>", f"T\n{LONG}\nEnd."),
    # paragraphs in regions of their own, inside one that also holds links
    (f"<body><div id=wrapper><div><a href=1>Home</a> <a href=2>About us</a></div><div><h1>T</h1><p>{LONG * 2}</p></div>"
     f"<div><p>Short.</p></div><div><p>{LONG * 2}</p></div></div></body>", f"T\n{LONG * 2}\nShort.\n{LONG * 2}"),
])
def test_main_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("block,text", [
    (f"<section id=related-work><h2 id=related>Related work</h2><p>{LONG}</p></section>", f"Related work\n{LONG}\n"),
    (f"<section id=search><h2>Search</h2><p>{LONG}</p></section>", f"Search\n{LONG}\n"),
    (f"<div id=socialHistory><div id=notices-and-forms><p>{LONG}</p></div></div>", f"{LONG}\n"),
    ("<h2 id=search>Search</h2>", "Search\n"), ("<h2 id=comments-in-code>On comments</h2>", "On comments\n"),
    ("<h2 id=social-history><a href=#s>Social</a> history</h2>", "Social history\n"), ("<h1 class=page-header>Title</h1>", "Title\n"),
    ("<p id=share-of-voters>Shares.</p>", "Shares.\n"),
    # still left out: links, form controls, ids that are nothing but names, classes, roles
    ("<div id=related-reading><a href=1>One more</a> <a href=2>Another</a></div>", ""),
    ("<div id=search-the-site><label>Find</label> <input name=q></div>", ""),
    (f"<section id=comments><h2>Comments</h2><div><p>{LONG}</p></div></section>", ""), (f"<div id=comment-12><p>{LONG}</p></div>", ""),
    (f"<div id=sidebar><p>{LONG}</p></div>", ""), (f"<div id=talk class=user-comments><p>{LONG}</p></div>", ""),
    (f"<div id=related-work role=complementary><p>{LONG}</p></div>", ""), ("<p class=advert>Buy</p>", ""),
])
def test_ids_inside_an_article(block, text):
    assert main_text(f"<body><article><p>{LONG}</p>{block}<p>{LONG}</p></article></body>") == f"{LONG}\n{text}{LONG}"


def test_ids_of_headings_and_articles():
    assert main_text(f"<body><div><h2 id=search>Search</h2><p>{LONG * 2}</p></div></body>") == f"Search\n{LONG * 2}"
    assert main_text(f"<main><article id=comments-in-code><p>{LONG}</p></article><article id=comment-3><p>x</p></article></main>") == LONG


P = f"<p>{LONG * 3}</p>"
ITEMS = [f"A short list item {k}." for k in range(5)]
NESTED = [
    ("<ul>" + "".join(f"<li>{i}</li>" for i in ITEMS) + "</ul>", ITEMS),
    ("<ol><li>One<ul><li>Two</li></ul></li></ol>", ["One", "Two"]),
    ("<table><tr><th>Name</th><th>Size</th></tr><tr><td><a href=1>Linked</a></td><td>12</td></tr></table>", ["Name", "Size", "Linked", "12"]),
    ("<table><tbody><tr><td><p>One</p><p>Two</p></td><td>x</td></tr><tr><td>y</td></tr></tbody></table>", ["One", "Two", "x", "y"]),
    ("<blockquote><p>Quoted.</p></blockquote>", ["Quoted."]),
    ("<figure><img src=x><figcaption>A figure.</figcaption></figure>", ["A figure."]),
    ("<ul><li><a href=1>Home</a></li><li><a href=2>About us</a></li></ul>", []),  # mostly links
]


@pytest.mark.parametrize("block,inner", NESTED)
@pytest.mark.parametrize("page", ["<body><div id=content>{}</div><div><a href=1>x</a> <a href=2>y</a></div></body>", "<body>{}</body>", "{}"])
def test_lists_tables_quotes_and_figures_stay_with_the_region_around_them(page, block, inner):
    assert main_text(page.format(P + P + block + P)) == "\n".join([LONG * 3, LONG * 3, *inner, LONG * 3])


def test_a_long_quote_stands_for_the_region_around_it():
    html = f"<body><div><a href=1>x</a></div><div><p>Short.</p><blockquote>{LONG * 3}</blockquote><p>End.</p></div><div><a href=2>y</a></div>"
    assert main_text(html) == f"Short.\n{LONG * 3}\nEnd."


def test_cells_of_a_page_laid_out_by_a_table_count_for_themselves():
    html = f"<body><table><tr><td><a href=1>Home</a> <a href=2>News</a></td><td>{P}<p>Short.</p>{P}</td><td>Ad</td></tr></table></body>"
    assert main_text(html) == f"{LONG * 3}\nShort.\n{LONG * 3}"


def test_very_deep_pages():
    depth = 30_000
    html = "<body>" + "".join(f"<div><p>{LONG}</p>" for _ in range(depth)) + "</div>" * depth + "</body>"
    assert main_text(html) == "\n".join([LONG] * depth)


def test_every_page_gives_a_row(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "u", ""), (1, "u", f"<article><p>{LONG}</p></article>"),
            (3, "u", "<article><p>" + "word " * 100000 + "</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = extracted(pages).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", len(LONG)), (2, None, 0), (None, "u", 0), (1, "u", len(LONG)),
                                                            (3, "u", 499999)]
    assert extracted(pages.limit(0)).count() == 0


A = f"<article><p>{LONG}</p>{{}}<p>End.</p></article>"


@pytest.mark.parametrize("html,inner", [
    # a form around the page is none; small ones are, and controls never are text
    (f"<body><form id=aspnet><div><input name=q><button>Go</button><label>Find</label></div><div>{A}</div></form></body>", ""),
    (f"<body><form><div id=content><p>{LONG}</p><p>End.</p></div><fieldset><legend>Search</legend>words</fieldset></form><div>x</div></body>", ""),
    (f"<body><form><label>Find</label><input></form>{A}<form><p>Subscribe here.</p><button>OK</button></form></body>", ""),
    (A.format("<form><p>Your mail.</p><input></form>"), ""),
    (A.format("<div role=form><p>Your mail.</p></div>"), ""),
    # foreign markup closes itself
    (A.format("<p>a <svg/> b</p><svg viewBox=0><path d=1 /><title/></svg><math/><p>c</p>"), "a b\nc"),
    (A.format("<p>a <svg><text>x</text><g/></svg> b</p>"), "a b"),
    # controls, hidden elements and adverts within lines
    (A.format("<button>Share</button><p>Z</p>"), "Z"), (A.format("<p>Hello <button>Go</button> there</p>"), "Hello there"),
    (A.format("<p>a <button>Go<p>b</p>"), "a\nb"), (A.format("<textarea>x</textarea><p><select><option>1<option>2</select>b</p>"), "b"),
    (A.format("<select><option>1<option>2<p>b</p>"), "b"),
    (A.format("<p hidden>x</p><p style='color:red; DISPLAY : none'>x</p><div style=display:none><p>x</p></div><p role=alert>x</p><p>b</p>"), "b"),
    (A.format("<p>a <span class=ad>Buy <span>now</span> this</span> b <i hidden>x</i></p>"), "a b"),
    (A.format("<span class='ad-box'><p>Buy</p><p>this</p></span><p>b</p>"), "b"), (A.format("<p>a <span class=ad>Buy</p><p>b</p>"), "a\nb"),
    (A.format("<ul><li hidden><p>x</p><li>b</ul>"), "b"), (A.format("<p>the <b class=search-term>word</b></p>"), "the word"),
    (A.format("<h2 hidden>x</h2>b"), "b"), (f"<body style='visibility:hidden'>{A}</body>", ""),
    # classes around and inside an article
    (f"<div class=comment-policy>{A}</div>", ""), (f"<div class='page widget-area'>{A}</div>", ""), (f"<div id=related>{A}</div>", ""),
    (f"<div class=related-posts><article><p>Teaser.</p></article></div>{A}", ""), (f"<section class=comments>{A}</section>{A}", ""),
    *[(A.format(f"<section class={c}><p>Kept.</p></section>"), "Kept.") for c in ("related-work", "share-price", "social-history", "comment-policy", "noticed")],
    *[(A.format(f"<section class='{c}'><p>Gone.</p></section>"), "") for c in ("related", "share-buttons", "user-comments", "x cookie-notice", "left-sidebar")],
    (A.format("<section class=related-reading><a href=1>One more</a></section><p class=share-price>Up.</p><p class=ads>x</p>"), "Up."),
])
def test_markup_around_and_inside_the_text(html, inner):
    import re

    assert main_text(re.sub("{}", "", html)) == f"{LONG}\n{inner}\nEnd.".replace("\n\n", "\n")


def test_named_articles_do_not_win_over_more_text():
    assert main_text(f"<div id=content><p>{LONG * 3}</p><p>End.</p></div><div class=sidebar><article><p>{LONG}</p></article></div>") == f"{LONG * 3}\nEnd."


def test_given_pages_equal_a_plain_restatement(spark, sf):
    """The given pages mark their article and name what is none of it by tag or class."""
    import html
    import re

    gone = re.compile(r"<!--.*?-->|<(script|style|nav|aside|footer|form|header)\b.*?</\1>|<div class=\"ad\">.*?</div>", re.S)
    blocks = re.compile(r"</?(?:p|h[1-6]|div|li|ul|ol|table|tr|td|th|section|blockquote|pre|article)\b[^>]*>")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()
    for (page,) in pages:
        found = re.search(r"<article[^>]*>(.*?)</article>", gone.sub("", page or ""), re.S)
        lines = blocks.sub("\n\0", found[1]).split("\0") if found else []
        text = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", x))).split()) for x in lines]
        assert main_text(page) == "\n".join(x for x in text if x)
    assert len(pages) > 1000
