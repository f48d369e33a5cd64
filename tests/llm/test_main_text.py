"""Pages on which main text was lost."""

import html
import re
import time

import pytest
from odd_rows import prose

from boardweave.llm import extract

LONG = [prose(k, 60).capitalize() + ", and so on." for k in range(4)]


@pytest.mark.parametrize("script", ["<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b)x='<p>'</Script >", "<style>a<b{}</style>", "<script>a<b</scripts>c</script>", "<textarea>x<y</textarea/>"])
def test_sign_less_in_a_script(script):
    body = f"<body><article><h1>Head</h1><p>{LONG[0]}</p>{script}<p>{LONG[1]}</p></article></body>"
    assert extract.main_text(f"<html><head>{script}<title>No</title></head>{body}") == "\n\n".join(["Head", LONG[0], LONG[1]])


def test_text_outside_article_elements():
    cards = "".join(f"<article><h3><a href='/{i}'>Card {i}</a></h3><p>Teaser number {i}.</p></article>" for i in range(5))
    text = "".join(f"<p>{x}</p>" for x in LONG)
    for page in (f"<body><div class=story><h1>Head</h1>{text}</div><div class=more>{cards}</div></body>",
                 f"<body><div class=more>{cards}</div><div class=story><h1>Head</h1>{text}</div></body>"):
        assert extract.main_text(page) == "\n\n".join(["Head", *LONG])


def test_blocks_of_an_article_beside_other_text():
    text = "".join(f"<p>{x}</p>" for x in LONG)
    page = f"<body><div class=top><p>Site.</p></div><main><article><header><h1>Head</h1></header><div class=body>{text}<p>Tiny.</p></div></article></main><div class=low><p>Short line.</p></div></body>"
    assert extract.main_text(page) == "\n\n".join(["Head", *LONG, "Tiny."])


def test_scores_decide_within_main():
    text = "".join(f"<p>{x}</p>" for x in LONG)
    teasers = "".join(f"<div class=item><h4>Item {i}</h4><span>Some more words of item number {i} without any end and so forth</span></div>" for i in range(12))
    page = f"<body><main><div class=story><h1>Head</h1>{text}</div><div class=grid>{teasers}</div></main></body>"
    assert extract.main_text(page) == "\n\n".join(["Head", *LONG])


@pytest.mark.parametrize("name", ["class='content has-sidebar'", "class=no-sidebar", "class='page-header-fixed'", "id='social-article'", "class=widget", "id=comments"])
def test_wrappers_with_a_word_of_furniture(name):
    text = "".join(f"<p>{x}</p>" for x in LONG)
    page = f"<body><div {name}><h1>Head</h1>{text}<div class='main-sidebar'><p>Aside, here.</p></div></div></body>"
    assert extract.main_text(page) == "\n\n".join(["Head", *LONG])


def test_names_of_furniture_beside_the_text():
    text = "".join(f"<p>{x}</p>" for x in LONG[:2])
    talk = "".join(f"<p>{x}</p>" for x in LONG[1:] * 2)
    page = f"<body><div class=story><h1>Head</h1>{text}<div class='ad-slot top'><p>Buy, now.</p></div></div><div id='comment-list'>{talk}</div><div class=site-footer><p>{LONG[3]}</p></div></body>"
    assert extract.main_text(page) == "\n\n".join(["Head", *LONG[:2]])


def test_linked_blocks_of_the_article():
    menu = "".join(f"<li><a href='/{i}'>Number {i}</a></li>" for i in range(4))
    page = (f"<body><article><h1><a href=/>Head</a></h1><p>{LONG[0]}</p><ul>{menu}</ul><p><a href=x>A linked sentence, all of it.</a></p><p>{LONG[1]}</p>"
            "<h2>Sources</h2><ul><li><a href=s>First source</a></li><li><a href=t>Second source</a></li></ul></article></body>")
    assert extract.main_text(page) == "\n\n".join(["Head", LONG[0], "A linked sentence, all of it.", LONG[1], "Sources", "First source", "Second source"])


def plain_article(page):
    """The article of a page of the given tables: its blocks without tags."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p|ul|li|div)>", article.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def given(llm):
    return [r.html for r in llm.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]


def test_given_pages_against_a_plain_version(given):
    assert [extract.main_text(h) for h in given] == [plain_article(h) for h in given]


def test_scores_decide_on_given_pages(given, monkeypatch):
    """With a constant score for every path, menus are content where the article is short."""
    monkeypatch.setattr(extract, "path_scores", lambda nodes: dict.fromkeys((n.element.path for n in nodes), 1.0))
    assert sum(extract.main_text(h) != plain_article(h) for h in given) >= 3


def test_formulas_stay_in_their_paragraph():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding=tex>x = 1</annotation></semantics></math>"
    assert extract.main_text(f"<article><p>We know that {formula} holds, {LONG[0]}</p></article>") == f"We know that x=1 holds, {LONG[0]}"


def test_menus_within_the_article():
    links = "".join(f"<li><a href='/{i}'>Part number {i}</a></li>" for i in range(6))
    page = f"<article><h1>Head</h1><nav><p>Parts</p><ul>{links}</ul></nav><p>{LONG[0]}</p><p>{LONG[1]}</p></article>"
    assert extract.main_text(page) == "\n\n".join(["Head", LONG[0], LONG[1]])


@pytest.mark.parametrize("open_", ["<div>x", "<div class=ad>x", "<div><b hidden>x", "<div class=a id=b>x<p>y"])
def test_time_grows_with_the_page_and_not_with_its_depth(open_):
    took = []
    for n in (10_000, 100_000):
        begun = time.perf_counter()
        extract.main_text(open_ * n + "</span2>" * n)
        took.append(time.perf_counter() - begun)
    assert took[1] < 30 * took[0] + 1


def test_no_pages(llm):
    found = extract.main_texts(llm.createDataFrame([], "page_id long, url string, html string"))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.collect() == []
