import html as entities
import re

import numpy as np
import pytest

from nestdoc.llm import pages as P
from nestdoc.llm._recurrent import F32, lstm, lstm_back, lstm_weights

from ..conftest import SF01


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet(f"{SF01}/pages.parquet"))


def article(page):
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    texts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(t for t in texts if t)


def test_main_text_of_the_tables(spark, model):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in P.extract(pages, model).collect()}
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


LAYOUTS = {
    "names": "<div class='sidebar'><p>Other stories, of this and that, and more.</p></div><div class='content'><h1>T</h1><p>A first paragraph, of some words.</p>"
    "<p>And &lt;more&gt;\n of  it, here.</p></div><div class='comments'><div class='comment'><p>A reader says so, and so, here.</p></div></div>",
    "tags": "<nav><a href=/x>Home</a></nav><main><article><h1>T</h1><p>A first paragraph, of some words.<script>x('</p>')</script></p><aside class=promo>Buy it</aside>"
    "<form><label>Mail</label><button>Go</button></form><p>And &lt;more&gt; of it, here.</article></main><section id='comments'><p>A reader says so.</p></section><footer>&copy; me",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_other_layouts(model, name):
    page = P.blocks(LAYOUTS[name])
    scores = model.scores([P.encode(page)])[0]
    assert [b.text for b, s in zip(page, scores) if s >= 0.5] == ["T", "A first paragraph, of some words.", "And <more> of it, here."]


def test_reading_markup():
    texts = [b.text for b in P.blocks("a<!-- <p>no</p> -->b<br>c<p>d <b>e</b>f<li>g<li>h &amp i<style>p{}</style><td>j<unknown x='a>b'>k</p>&notanentity; &#233;")]
    assert texts == ["ab c", "d ef", "g", "h & i", "j", "k", "¬anentity; é"] or texts == ["ab c", "d ef", "g", "h & i", "jk", "¬anentity; é"]
    assert P.blocks("") == [] and P.blocks("<p> \n </p>") == []
    assert [b.text for b in P.blocks("<head><title>x</title><body>y")] == ["y"]
    assert len(P.blocks("<p>x" * 20_000)) == 20_000


def test_odd_rows_and_empty_table(spark, model):
    df = spark.createDataFrame([(1, "u", None, 1), (1, "u", "", 2), (2, None, "<nav><a>x</a></nav>", 3), (None, "v", "<article>" + "<p>Words, and words.</p>" * 3000, 4)], "page_id long, url string, html string, score int")
    out = P.extract(df, model).collect()
    assert [r["text"] == "" for r in sorted(out, key=lambda r: r["score"])] == [True, True, True, False]
    assert P.extract(df.limit(0), model).count() == 0
    assert P.train(df.limit(0)).scores([]) == []


def test_lstm_gradient():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in lstm_weights(rng, 3, 4).items()}
    x, mask = rng.normal(size=(5, 2, 3)), np.array([[1, 1], [1, 1], [1, 1], [1, 0], [1, 0]], bool)
    up = rng.normal(size=(5, 2, 4))
    out, saved = lstm(w, x, mask, True)
    dw, dx = lstm_back(w, saved, up.astype(F32))
    for k in w:
        i = tuple(rng.integers(s) for s in w[k].shape)
        w[k][i] += 1e-4
        more = (lstm(w, x, mask, True)[0] * up).sum()
        w[k][i] -= 2e-4
        less = (lstm(w, x, mask, True)[0] * up).sum()
        w[k][i] += 1e-4
        assert abs((more - less) / 2e-4 - dw[k][i]) < 2e-2


def test_elements_that_hold_text_or_have_no_end():
    def texts(page):
        return [b.text for b in P.blocks(page)]

    assert texts("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p>") == ["a x=1 b"]
    assert texts("<p>a <object data=f><p>fallback</p></object></p><canvas>drawn</canvas>") == ["a", "fallback", "drawn"]
    for tag in ("svg", "object", "noscript", "template", "select", "canvas", "math"):
        assert texts(f"<p>one</p><{tag} x=y><p>two</p><p>three 1 < 2</p>")[:2] == ["one", "two"], tag
    assert texts("<p>one</p><svg><text>skip</text></svg><select><option>no</select><p>two") == ["one", "two"]
    assert texts("<p>one</p><script>var two = '<p>'; ") == ["one"]


def test_long_pages_train_and_names_may_clash(spark, monkeypatch):
    monkeypatch.setattr(P, "SAMPLE_BYTES", 400)
    monkeypatch.setattr(P, "MADE_PAGES", 3)
    monkeypatch.setattr(P, "EPOCHS", 1)
    seen = []
    real = P.fit
    monkeypatch.setattr(P, "fit", lambda pages, seed=0: seen.extend(pages) or real(pages, seed))
    rows = [(k % 9, f"<article><p>{'word ' * (200 + k % 9)}</p></article>", "t", "u", None) for k in range(30)]
    df = spark.createDataFrame(rows, "page_id int, html string, text string, `a.b` string, main_text string")
    model = P.train(df)
    assert len(seen) == 9 and all(len(p) == 400 for p in seen)
    out = P.extract(df, model)
    assert out.columns == ["page_id", "text", "a.b", "main_text", "_text"]
    assert out.count() == 30 and {r["text"] for r in out.collect()} == {"t"}
