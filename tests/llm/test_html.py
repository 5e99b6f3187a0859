import html
import re

import pytest

from terrarium.llm import html_pages, html_text, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return html_text.fit()


def test_forward_backward_and_viterbi_against_enumeration():
    import itertools
    import math

    m = html_text.Model({}, [[0.3, -0.7], [0.1, 0.9]], [0.2, -0.4])
    scores = [0.5, -1.2, 0.3, 2.0]

    def value(labels):
        v = m.start[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
        return v + sum(m.moves[a][b] for a, b in zip(labels, labels[1:]))

    paths = list(itertools.product((0, 1), repeat=4))
    total = math.log(sum(math.exp(value(p)) for p in paths))
    ones, pairs, z = html_text.marginals(m, scores)
    assert abs(z - total) < 1e-9
    for k in range(4):
        assert abs(ones[k] - sum(math.exp(value(p) - total) for p in paths if p[k])) < 1e-9
    assert abs(pairs[1][1][0] - sum(math.exp(value(p) - total) for p in paths if p[1] == 1 and p[2] == 0)) < 1e-9
    assert tuple(html_text.viterbi(m, scores)) == max(paths, key=value)


def test_held_out_pages(model):
    wrong = n = 0
    for feats, labels in html_text.labelled(html_pages.labelled_pages(200, seed=77)):
        got = html_text.viterbi(model, [sum(model.weights.get(f, 0) for f in own) for own in feats])
        wrong += sum(a != b for a, b in zip(got, labels))
        n += len(labels)
    assert wrong / n < 0.02


def test_blocks():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts(None) == texts("") == texts("<p> </p>") == []
    assert texts("<p>a<p>b<br>c</p>d") == ["a", "b c", "d"]
    assert texts("<p>1 &lt; 2&nbsp;&amp;\n 3 <b>x</b>y</p>") == ["1 < 2 & 3 xy"]
    assert texts("<script>var a='<p>x</p>';</script><style>p{}</style><p>y</p><!-- <p>z</p> -->") == ["y"]
    assert texts("<p>a</p><script>open") == ["a"] and texts("<p>a</p><!-- open") == ["a"]
    assert texts('<p title="a > b">t</p><ul><li>1<li>2</ul>') == ["t", "1", "2"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts("<head><title>t</title></head><body>free text<div>x</div>") == ["free text", "x"]
    assert texts("&lt;p&gt; 5 < 6 and <") == ["<p> 5 < 6 and <"]


def test_open_heads_and_embedded_content(model):
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts("<html><head><title>x</title><p>a b<p>c") == ["a b", "c"]
    assert texts("<head><meta charset=u><style>p{}</style>free <b>text</b><p>x") == ["free text", "x"]
    assert texts("<head><title>x</title><noscript><link></noscript></head><p>y") == ["y"]
    assert texts("<head><title>only</title>") == [] and texts("<head>bare text") == ["bare text"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so x=2 holds"]
    assert texts("<p>a <svg><text>label</text></svg> b <object>other</object> c") == ["a label b other c"]
    assert texts("<p>a</p><noscript><p>shown without scripts</p></noscript>") == ["a", "shown without scripts"]
    body = "<article><h1>Title</h1><p>A first paragraph with <math><mn>3</mn></math> words.</p></article>"
    for head in ("<html><head><title>x</title>", "<html><title>x</title>", "<html><head><meta charset=utf-8>"):
        assert html_text.main_text(model, head + body) == "Title\n\nA first paragraph with 3 words."


def test_main_text_of_a_page_with_all_parts(model):
    page = """<html><head><title>t</title></head><body><div class="cookie-notice"><p>We use cookies for all of it.</p></div>
    <header><h1>The Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
    <article><h1>The title of it</h1><p>First paragraph of the article, which has some length.</p>
    <div class="ad">Buy this now for less money.</div><p>Short.</p><p>Tom &amp; Ann said it.</p></article>
    <aside class="sidebar"><h3>Related</h3><p>Other story of the day that is long enough.</p></aside>
    <form><label>Name</label><input><button>Send</button></form>
    <section class="comments"><div class="comment"><p>I liked this story very much, thank you all.</p></div></section>
    <footer><p>&copy; The Site</p></footer></body></html>"""
    assert html_text.main_text(model, page) == (
        "The title of it\n\nFirst paragraph of the article, which has some length.\n\nShort.\n\nTom & Ann said it.")


@pytest.mark.parametrize("page, text", [
    ("<body><header><h1>Site</h1></header><main><h1>T</h1><p>One two three four five.</p><aside><h3>More</h3>"
     "<p>Other stories to read now.</p></aside><p>Last one here.</p></main><footer>x</footer></body>",
     "T\n\nOne two three four five.\n\nLast one here."),
    ("<body><div class='site-header'>Site</div><div class='article__body'><h2>Title</h2><p>Para one is here.</p><p>No.</p>"
     "</div><div class='sidebar-right'><p>Related story is here and it is long.</p></div><div id='cookie-bar'>We use it."
     "<button>OK</button></div></body>", "Title\n\nPara one is here.\n\nNo."),
    ("<html><body><p>Just a paragraph with several words in it.</p><p>Another paragraph follows.</p></body></html>",
     "Just a paragraph with several words in it.\n\nAnother paragraph follows."),
    ("<article><p>Body of this text.</p></article><section id='comments'><h2>Comments</h2><article class='comment'>"
     "<p>First! I was here before all of you.</p></article></section>", "Body of this text."),
    ("<body><div class='inhalt'><h1>Ein Titel</h1><p>Der erste Absatz mit einigen Worten.</p></div><footer>x</footer></body>",
     "Ein Titel\n\nDer erste Absatz mit einigen Worten."),
    ("<article><h1>T</h1><p>a b c.</p><div class=ad>Buy.</div><p>d e f.</p><div class='share'><a href=x>Share</a></div>"
     "<p>g.</p></article>", "T\n\na b c.\n\nd e f.\n\ng."),
])
def test_main_text_of_odd_pages(model, page, text):
    assert html_text.main_text(model, page) == text


def test_query_against_the_article_element(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op5_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n\n".join(p for p in parts if p)
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_edge_rows(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>" + "Long text here. " * 20_000 + "</p></article>"),
            (3, "u", "<article><p>x y</p></article>"), (None, "u", "no markup at all")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS main_text", "1 AS n_chars")
    got = html_text.extract(df, model, ["page_id", "url"]).collect()
    assert len(got) == 5 and [r["main_text"] for r in got[:2]] == ["", ""]
    assert len(got[2]["main_text"]) == 16 * 20_000 - 1
    assert html_text.extract(df.filter("false"), model, ["page_id"]).count() == 0
