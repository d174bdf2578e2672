"""Main text of pages."""

import html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from learnertrace.llm.html_text import extract, main_text

A = "A first paragraph of the story, long enough to count, with commas, and words."
B = "A second paragraph follows, and it says more, much more, about the same thing."
C = "The third, and last, paragraph of this text is here, as one would expect of it."


def page(body, head="<title>T</title><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


PAGES = {
    "plain article": (page(f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{A}</p><p>{B}</p></article>"
                           "<footer>&copy; me</footer>"), ["Title", A, B]),
    "divs without article": (page(f"<div id=header><p>Site, name, of, this, and, that, and more</p></div>"
                                  f"<div class=content><p>{A}<p>{B}<p>{C}</div><div class='sidebar'><p>{A}</p></div>"),
                             [A, B, C]),
    "split containers": (page(f"<div><div class=part><p>{A}</p><p>{B}</p></div><div class=part><p>{C}</p><p>{A}</p>"
                              "</div></div>"), [A, B, C, A]),
    "boilerplate inside": (page(f"<article><header><h1>Head</h1></header><p>{A}</p><div class=ad><p>{B}</p></div>"
                                f"<form><p>{B}</p><input></form><p>{C}</p><section class='comments'><p>{B}</p>"
                                "</section></article>"), ["Head", A, C]),
    "references and space": (page(f"<article><p>a&nbsp;&amp;\n\t b &lt;i&gt; &#233; {html.escape(A)}</p></article>"),
                             [f"a & b <i> é {A}"]),
    "unclosed": (f"<body><article><p><b>{A}<br><p>{B}<script>var t='</p>';</script><ul><li>one<li>two</ul>",
                 [A, B, "one", "two"]),
    "cut short": (f"<article><p>{A}</p><p>{B}</p><a hre", [A, B]),
    "only short": (page("<main><p>Hi.</p><p>Yo, ok</p></main><footer>f</footer>"), ["Hi.", "Yo, ok"]),
    "table": (page(f"<nav>n</nav><table><tr><td><p>{A}</p><p>{B}</p></td><td><a href=x>{C}</a></td></tr></table>"),
              [A, B]),
    "hidden and commented": (page(f"<article><p>{A}</p><!-- <p>{B}</p> --><p hidden>{B}</p><p>{C}</p>"
                                  f"<div role=dialog>{B}</div></article>"), [A, C]),
    "nothing": (page("<nav>a</nav><footer>b</footer>"), []),
    "no markup": (A, [A]),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    got, want = PAGES[name]
    assert main_text(got) == "\n".join(want)


WRAPPED = {
    "content with": (f"<div class='content with-sidebar'><p>{A}</p><p>{B}</p></div><div class=sidebar>{C}</div>", [A, B]),
    "content beside": (f"<div id=content class=sidebar><p>{A}</p><p>{B}</p></div><p class=share>{C}</p>", [A, B]),
    "row without": (f"<div class='row no-sidebar'><div><p>{A}</p><p>{B}</p></div></div>", [A, B]),
    "article that has": (f"<article class='post has-comments'><p>{A}</p><p>{B}</p>"
                         f"<div class=comments><p>{C}</p></div></article>", [A, B]),
    "article by name": (f"<div><article class=related><p>{A}</p></article></div>", [A]),
    "most of the text": (f"<div class='widget'><div class='notice'><p>{A}</p><p>{B}</p><p>{C}</p></div>"
                         f"<div class=sidebar><p>{A}</p></div></div><div class=ad><p>{C}</p></div>", [A, B, C]),
    "inline wrapper": (f"<span class='widget'><p>{A}</p><p>{B}</p></span>", [A, B]),
    "article in an unwanted wrapper": (f"<div class=widget-area><article><p>{A}</p></article></div>", [A]),
    "most, but links": (f"<div class=menu><a href=x>{A}</a> <a href=y>{B}</a></div><div><p>{C}</p></div>", [C]),
    "content, but links": (f"<article><p>{A}</p><div class='content share'><a href=x>{B}</a></div></article>", [A]),
    "not most": (f"<div><p>{A}</p><p>{B}</p></div><div class=post-comments><p>{C}</p></div>", [A, B]),
}

def several(n, text=B, tag="p"):
    return f"<{tag}>{text}</{tag}>" * n


COMMENTED = {
    "more comments than post": (f"<div class=post>{several(3, A)}</div><div id=comments>{several(10)}</div>", [A] * 3),
    "more comments than article": (f"<article>{several(3, A)}</article><div id=comments>{several(10)}</div>", [A] * 3),
    "comments as articles": (f"<article>{several(6, A)}</article><section>" + "".join(
        f"<article class='comment'><p>{B}</p></article>" for _ in range(4)) + "</section>", [A] * 6),
    "comments as articles inside": (f"<article>{several(6, A)}" + "".join(
        f"<article class='comment'><p>{B}</p></article>" for _ in range(4)) + "</article>", [A] * 6),
    "comment named content": (f"<article>{several(3, A)}</article><div class='comment content'>{several(2)}</div>", [A] * 3),
    "comment named text": (f"<article>{several(3, A)}<div class='comment text'>{several(9)}</div></article>", [A] * 3),
    "long sidebar": (f"<div>{several(2, A)}</div><div class=sidebar>{several(8)}</div>", [A] * 2),
    "short page, cookie notice": (f"<p>Short.</p><div class='cookie-notice'>{several(3)}</div>", ["Short."]),
    "short page, notice": (f"<p>Short.</p><div class='notice'>{several(3)}</div>", ["Short."]),
    "short page in a widget": (f"<h1>T</h1><div class='widget'>{several(3, A)}</div>", [A] * 3),
    "only comments": (f"<div class=comments>{several(3)}</div>", []),
    "comments are open": (f"<div class='entry comments-open'>{several(3, A)}</div>", [A] * 3),
}


@pytest.mark.parametrize("name", COMMENTED)
def test_no_size_makes_comments_text(name):
    got, want = COMMENTED[name]
    assert main_text(page(got)) == "\n".join(want)


SHORT = {
    "divs": ("<div><p>Hi.</p></div><div><p>Yo.</p></div>", ["Hi.", "Yo."]),
    "divs at depths": ("<h1>T</h1><div><div><p>Hi.</p></div></div><div>Yo.<ul><li>a<li>b</ul></div><nav>n</nav>",
                       ["T", "Hi.", "Yo.", "a", "b"]),
    "article beside divs": ("<div><p>Hi.</p></div><article><div><p>Yo.</p></div><p>Ok.</p></article>", ["Yo.", "Ok."]),
    "articles of main": ("<main><article><p>Hi.</p></article><article><p>Yo.</p></article></main>", ["Hi.", "Yo."]),
    "nothing wanted": ("<nav>n</nav><div hidden>x</div>", []),
}


@pytest.mark.parametrize("name", SHORT)
def test_pages_too_short_to_score(name):
    got, want = SHORT[name]
    assert main_text(page(got)) == "\n".join(want)


@pytest.mark.parametrize("name", WRAPPED)
def test_names_alone_do_not_drop_content(name):
    got, want = WRAPPED[name]
    assert main_text(page(got)) == "\n".join(want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='ad'>", "</div>", "<b", "<!--", "-->", "<a href=\"x>", "text, more", "&amp", "&#0;",
     "<script>", "</script", "<table>", "<td>", "<li>", "</ul>", "<br/>", "\"", "'", ">", "<", "é", "<article>",
     "<textarea>", "</b>", "<![CDATA[", "<?x", "</article>", "<h1>", "\n "]), max_size=40).map("".join))
def test_any_markup_is_read(text):
    assert "\n\n" not in main_text(text)


def test_rows(spark):
    long = page("<article>" + f"<p>{A}</p>" * 20_000 + "</article>")
    rows = [(1, "u", PAGES["table"][0], "x"), (1, "u", PAGES["table"][0], "x"), (None, None, None, "x"),
            (2, "v", "", "x"), (3, "w", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract(pages).collect()}
    assert got[1, "u"] == (f"{A}\n{B}", len(A) + len(B) + 1)
    assert got[None, None] == got[2, "v"] == ("", 0)
    assert got[3, "w"][1] == 20_000 * (len(A) + 1) - 1
    assert extract(pages).count() == 5 and extract(pages.limit(0)).count() == 0


def test_depth_is_no_trouble():
    assert main_text("<div>" * 20_000 + f"<p>{A}") == A
    assert main_text("</p>" * 20_000 + "<b>" * 20_000 + A) == A
