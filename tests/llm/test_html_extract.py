import html
import re

import numpy as np
import pytest

from strata.llm import html_extract as q
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(80).collect()
    return q.train(marked=[r.html for r in pages])


def test_blocks():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><script>var a='</p>';</script>"
            "<!-- <p>no</p> --><div class='side-Bar' id=x1>a&nbsp;&amp; <b>b</b>\n c<br>d<p>e<p>f</div>"
            "tail<ul><li>one<li><a href='/q?a>b'>two</a> three</ul><img src=x>end <i>of</i> it")
    found = q.blocks(page)
    assert [b.text for b in found] == ["a & b c d", "e", "f", "tail", "one", "two three", "end of it"]
    assert found[0].path[-4:] == ("div", "side", "bar", "x1")[-4:] or "side" in found[0].path
    assert found[5].link_chars == 3 and found[4].path[-2:] == ("ul", "li")


@pytest.mark.parametrize("page, want", [
    ('<article><svg class="i"/><p>Long article text one.</p><p>two</p></article>', ["Long article text one.", "two"]),
    ('<article><svg/><p>a</p><svg><text>no</text></svg><p>b</p></article>', ["a", "b"]),
    ('<p>a <svg class="x>y"><path d="M0"/></svg>b</p><p>c</p>', ["a b", "c"]),
    ("<p>a</p><svg><p>b</p><p>c</p><svg><title>no</title></svg>", ["a", "b", "c"]),
    ("<svg-icon>a</svg-icon><p>b</p>", ["a", "b"]),
    ("<p>a</p><select><p>b</p><select><option>no</select><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><textarea><p>b</p>", ["a", "b"]), ("<p>a</p><iframe src='x'/><p>b</p>", ["a", "b"]),
    ("<p>a</p><iframe><p>b</p><iframe>no</iframe><p>c</p>", ["a", "b", "c"]),
    ("<p>a</p><template><p>b</p>", ["a", "b"]), ("<p>a</p><template><p>no</p></template>b", ["a", "b"]),
    ("<p>a</p><noscript><p>b</p>c", ["a", "b", "c"]), ("<p>a</p><noscript>b</noscript><p>c</p>", ["a", "b", "c"]),
    ("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><math/><p>b</p>", ["If x = 2 holds", "b"]),
    ("<p>a</p><script src='x' /><p>b</p><script>no</script>", ["a", "b"]),
    ("<p>one</p><!--><p>two</p><p>three</p>", ["one", "two", "three"]), ("<p>a</p><!---><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- no --!><p>b</p>", ["a", "b"]), ("<p>a</p><!----><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- no > -- > no --><p>b</p>", ["a", "b"]), ("<p>a</p><!-- no <p>no", ["a"]),
    ("<p>a</p><script>no<p>no", ["a"]), ("<p>a</p><style>no", ["a"]),
    ("<html><head><title>no</title><meta charset=x><p>a</p><p>b", ["a", "b"]),
    ("<head><title>no</title><style>no</style>a<p>b", ["a", "b"]),
    ("<head><title>no</title><a href=x>a</a> b<div>c</div>", ["a b", "c"]),
    ("<head><title>no <p> no</title><noscript><img src=x>no</noscript></head><body><p>a", ["a"]),
    ("<head><title>no<meta x><noscript><p>a</noscript><p>b", ["a", "b"]),
    ("<head><title>no</head><body><p>a</p><title>no</title>", ["a"])])
def test_no_text_is_lost(page, want):
    assert [b.text for b in q.blocks(page)] == want


def test_many_unclosed_elements_are_read_once():
    page = "<svg><select><iframe><template><textarea>x " * 40_000
    assert q.blocks(page)[0].text.count("x") == 40_000


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<p class=\"x", "a < b > c", "<!--", "<script>x",
                                  "&", "&#xZ;", "<p>" * 3000 + "x", "text only", "<td>x<tr><td>y", "<!doctype"])
def test_broken_markup_does_not_crash(page):
    for b in q.blocks(page):
        assert b.text and b.text == " ".join(b.text.split())


def test_features_read_the_whole_path_and_block():
    page = "<div>" * 20 + "<div class=comments>" + "<div>" * 20 + "<p>" + "x" * 300 + "1" * 100
    rows = q.featurize(q.blocks(page), memo := {})
    assert memo["<comments"] % q.PATH_ROWS in rows.path[0]
    assert rows.numbers[0, 6] == pytest.approx(0.25)


def test_gradients_are_right():
    rows, labels = q.training_rows(3, 1)
    net = q.Labeller(hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads, _ = net.gradients(rows, labels)
    rng = np.random.default_rng(0)
    for name in ("wxf", "whb", "bbf", "wo", "ep"):
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for i in [int(np.abs(g).argmax()), *rng.integers(0, len(flat), 2)]:
            old, loss = flat[i], []
            for step in (1e-3, -1e-3):
                flat[i] = old + step
                loss.append(net.gradients(rows, labels)[1])
            flat[i] = old
            assert (loss[0] - loss[1]) / 2e-3 == pytest.approx(g[i], abs=2e-4)


def test_held_out_layouts(model):
    rows, labels = q.training_rows(200, 99)
    found = model.main_blocks(rows)
    right = np.concatenate(found) == np.concatenate(labels).astype(bool)
    assert right.mean() >= 0.985


def test_driver_pages_match_their_articles(spark, model):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in q.main_text(pages, model=model).collect()}
    wrong = 0
    for r in pages.collect():
        body = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split())
                 for x in re.split("</?(?:p|h1)>", body))
        wrong += got[r.page_id].text != "\n".join(x for x in parts if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert wrong <= 0.01 * len(got)


def test_other_page_layouts(model):
    body = "".join(f"<p>This paragraph number {i} tells the story, and it goes on for a while.</p>" for i in range(5))
    side = "<div class='sidebar'><h4>Related</h4><ul><li><a href=/a>Popular posts</a></li></ul></div>"
    talk = "<section class='comments'><h3>3 comments</h3><div class='comment'><p>I like it, thanks a lot.</p></div></section>"
    page = ("<body><header><h2>Site name</h2></header><nav><a href=/>Home</a> <a href=/b>Blog</a></nav>"
            "<div class='cookie-notice'>We use cookies. Accept</div>" + side
            + f"<div class='post-content'><h1>The title of the story</h1>{body}</div>" + talk
            + "<form class='newsletter'><label>Email</label><button>Subscribe</button></form>"
              "<footer>&copy; all rights reserved</footer></body>")
    found = q.blocks(page)
    keep = model.main_blocks([q.featurize(found, {})])[0]
    text = [b.text for b, k in zip(found, keep, strict=True) if k]
    assert text[0] == "The title of the story" and len(text) == 6


def test_edge_rows(spark, model):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "<nav>Home</nav>"),
            (3, "w", "<article><p>" + "Long words of a text. " * 20_000 + "</p></article>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id int, url string, html string, text int")
    got = q.main_text(pages, model=model).collect()
    assert len(got) == 5 and sum(r.text == "" and r.n_chars == 0 for r in got) >= 3
    assert next(r for r in got if r.page_id == 3).n_chars == len("Long words of a text. ") * 20_000 - 1
    empty = spark.createDataFrame([], "page_id int, url string, html string")
    assert q.main_text(empty).count() == 0


def test_sample_pages_counts_copies_once(spark):
    rows = [(k, f"u{k % 5}", f"<p>{k % 5}</p>" * 50) for k in range(400)] + [(900, "u", None), (901, None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = q.sample_pages(pages, 3)
    assert len(got) == 3 == len(set(got)) and got == q.sample_pages(pages.orderBy("url"), 3)
    assert len(q.sample_pages(pages, 50)) == 6
    assert q.sample_pages(pages.where("false"), 50) == []
