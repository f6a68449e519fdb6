"""Main text of the given pages, and of pages with other layouts."""

import html
import re

import pytest

from gustgrid.llm.html_tree import extract_main_text, main_text

LONG = "A sentence, with commas, that is long enough to count as a paragraph of its own here."


def test_given_pages_whole(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(rows).collect()}
    for r in rows.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<(b|br)>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page,text", [
    ("", ""), (None, ""), ("<p>a", "a"), ("plain &amp; simple", "plain & simple"), ("1 < 2 and a<b", "1 < 2 and a<b"),
    (f"<div id=x><div class='content'><p>{LONG}<p>{LONG}</div><div class='sidebar'><p>{LONG}</div><div id=comments><p>{LONG}</div></div>", f"{LONG}\n{LONG}"),
    (f"<nav><a href=/>{LONG}</a></nav><main><h1>T</h1><p>{LONG}</p><aside>{LONG}</aside><form>x</form><ul><li>one<li>two</ul></main><footer>{LONG}</footer>", f"T\n{LONG}\none\ntwo"),
    (f"<article><h2>T &ldquo;q&rdquo;</h2><p>x&nbsp;&nbsp; y<br>z\n</p><script>var a='</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}</p></article>", f"T “q”\nx y z\n{LONG}"),
    (f"<body><div class='cookie notice'>{LONG}</div><section><p>{LONG}</p><p>{LONG}</p></section><div class=ad>buy</div></body>", f"{LONG}\n{LONG}"),
    ("<table><tr><td>" + LONG + "<td>b</table>", LONG + "\nb"),
    ("<p title='a>b'>ok, fine</p><p class=\"x>", "ok, fine\n<p class=\"x>"),
    (f"<div><p>{LONG}</p><p>{LONG}</p></div><script>never closed <p>{LONG}</p>", f"{LONG}\n{LONG}"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_layouts(page, text):
    assert main_text(page) == text


def test_long_link_menu_is_left_out():
    menu = "".join(f"<li><a href=/{i}>Entry, number {i}, of the long list</a></li>" for i in range(60))
    assert main_text(f"<body><div><ul>{menu}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("sizes", [[1, 1, 1], [5, 1, 1, 9, 2], [1, 12]])
def test_nested_sections_without_an_article(sizes):
    texts = [[f"Row {r}, part {k}: {LONG}" for k in range(n)] for r, n in enumerate(sizes)]
    rows = "".join(f"<div class=row><div class=col>{'<h2>Head</h2>' + ''.join(f'<p>{t}</p>' for t in own)}</div></div>" for own in texts)
    menu = "".join(f"<li><a href=/{i}>Entry, number {i}, of the list</a></li>" for i in range(9))
    page = (f"<body><div><ul>{menu}</ul></div><div class=page><div class=content>{rows}<div class=row><ul>{menu}</ul></div></div>"
            f"<div class=sidebar><p>{LONG}</p></div></div><footer>{LONG}</footer></body>")
    assert main_text(page) == "\n".join("\n".join(["Head", *own]) for own in texts)


THREAD = f"<p>{LONG}</p>" * 40


@pytest.mark.parametrize("page,text", [
    (f"<article><p>{LONG}</p></article><section id='comments'>{THREAD}</section>", LONG),
    (f"<body><div><p>Short, but the article.</p></div><div class='comment'>{LONG * 40}</div></body>", "Short, but the article."),
    (f"<body><div class='cookie notice'>{THREAD}</div><article><p>Short, but the article.</p></article></body>", "Short, but the article."),
    (f"<body><div class='page banner'><div class=content><p>{LONG}</p></div><div class=comments>{THREAD}</div></div></body>", LONG),
    (f"<body><div class='content with-sidebar'><p>{LONG}</p></div><div><span>x</span></div></body>", LONG),
    (f"<body><div class=search><main><p>{LONG}</p></main></div><div><p>{LONG}</p></div></body>", LONG),
    (f"<h1>Title</h1><div id=comments>{THREAD}</div>", "\n".join(["Title"] + [LONG] * 40)),
])
def test_hints_hold_whatever_the_length(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page,text", [
    # Names of an article's own parts.
    (f"<article><h2 id=discussion>Discussion</h2><p>{LONG}</p><h2 id='search-and-sharing'>Search</h2><section id='related-work'><p>R.</p></section>"
     f"<section id=discussion><p>D.</p></section><div class='alert alert-info'>Note.</div><div id='comment-on-method'><p>M.</p></div></article>",
     f"Discussion\n{LONG}\nSearch\nR.\nD.\nNote.\nM."),
    # Parts that do not belong to it.
    (f"<article><p>{LONG}</p><div class='share-buttons'>Share this</div><div class=related><a href=/1>One more</a></div><div id=comments><p>{LONG}</p></div>"
     f"<div class='comment-list'><p>{LONG}</p></div><div class='ad-slot-300'>Buy</div><p hidden>x</p></article>", LONG),
    ("<html><body><div><h1>Title</h1><p>Hello.</p><p>World.</p></div><div>Copyright 2024 by a company, all rights reserved, do not copy this page.</div></body></html>",
     "Title\nHello.\nWorld.\nCopyright 2024 by a company, all rights reserved, do not copy this page."),
    ("<h1>Title</h1><p>Hello.</p><p>World.</p><div>A sentence of some length, which stands at the end of the page.</div>",
     "Title\nHello.\nWorld.\nA sentence of some length, which stands at the end of the page."),
    (f"<main><article><p>{LONG}</p></article><section><p>P.</p></section><nav>x</nav></main><div><p>{LONG}</p></div>", f"{LONG}\nP."),
    # Points reach all ancestors: four columns, each paragraph three levels below the container.
    ("<body><div class=widget-area><p>Aside, short.</p></div><div class=text>" + f"<div><div><div><p>{LONG}</p></div></div></div>" * 4 + "</div></body>", "\n".join([LONG] * 4)),
])
def test_names_and_short_pages(page, text):
    assert main_text(page) == text


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, None, ""), (None, "u", f"<p>{LONG}</p>"), (2, "u", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")]
    got = extract_main_text(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, len(LONG), 3000 * len(LONG) + 2999]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
