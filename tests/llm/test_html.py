import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows
from tidemark.llm import html_extract as H


def blocks(html):
    p = H.Page(html)
    return [t for t in p.text if t]


@pytest.mark.parametrize("html, expected", [
    ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p>a <b>b</b>\n\t c</p>", ["a b c"]),
    ("<p><b>a<br><p>b", ["a", "b"]), ("x<br>y", ["x y"]), ("a&amp;b &lt;i&gt; &eacute;&#8364;&nbsp;z", ["a&b <i> é€ z"]),
    ("<div>a<div>b</div>c</div>d", ["a", "b", "c", "d"]), ("<script>if (a<b) '</p>'</script>t", ["t"]),
    ("<style>p{}</style><!-- <p>no</p> -->t<!-- open", ["t"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("</p></div>a</b>b", ["ab"]),
    ("<a title=\"x > y\">t</a>", ["t"]), ("a < b <3 <p>c", ["a < b <3", "c"]), ("<p", ["<p"]),
    ("<title>no</title><textarea><p>no</textarea>t", ["t"]), ("<script>never closed <p>a", []),
    ("<P CLASS=x>A</P><BR>B", ["A", "B"]), ("<![CDATA[ no ]]><?php no ?>t", ["t"]),
    ("<a href='x'y\">t</a>", ["t"]), ("\x00a\x0bb", ["\x00a b"]),
])
def test_blocks(html, expected):
    assert blocks(html) == expected


def test_shape_of_odd_trees():
    deep = H.Page("<div>" * 5000 + "x" + "</div>" * 5000 + "y")
    assert [t for t in deep.text if t] == ["x", "y"] and max(deep.depth) <= H.MAX_DEPTH + 1
    for html in ("<div>" * 3000 + "x", "</div>" * 3000, "<a " * 5000, "<b>" * 3000 + "<p>" * 3000 + "t",
                 "<p class='" * 2000, "&amp;" * 50_000):
        p = H.Page(html)
        assert all(q < k for k, q in enumerate(p.parent))


def small_model(seed):
    rng = np.random.default_rng(seed)
    m = H.Model()
    m.unary, m.edge = rng.normal(size=H.N_FEATURES), rng.normal(size=m.edge.shape)
    return m


def all_states(m, p):
    f = H.features(p)
    own = [sum(m.unary[i] for i in x) for x in f]
    kinds = [H.TAGS.get(t, H.TAGS["#other"]) for t in p.tag]
    for s in itertools.product((0, 1), repeat=len(own)):
        score = sum(u for u, x in zip(own, s) if x)
        score += sum(m.edge[kinds[k], s[p.parent[k]], s[k]] for k in range(1, len(s)))
        yield s, score


PAGE = "<div class='post'><h1>a b</h1><p>c <a href=x>d</a></p><ul><li>e</ul></div><nav>f</nav>"


@pytest.mark.parametrize("seed", range(4))
def test_marginals_by_enumeration(seed):
    m, pages = small_model(seed), [H.Page(PAGE), H.Page("x"), H.Page("")]
    f = H.Forest(pages)
    node, both = m.marginals(f)
    for p, base in zip(pages, f.first):
        n = len(p.parent)
        weight = {s: np.exp(x) for s, x in all_states(m, p)}
        total = sum(weight.values())
        for k in range(n):
            assert np.isclose(node[base + k, 1], sum(w for s, w in weight.items() if s[k]) / total)
            for a, b in itertools.product((0, 1), repeat=2):
                if k:
                    assert np.isclose(both[base + k, a, b], sum(
                        w for s, w in weight.items() if s[p.parent[k]] == a and s[k] == b) / total)


def test_gradient_by_differences():
    m, p = small_model(9), H.Page(PAGE)
    f = H.Forest([p])
    state = np.array([k % 2 for k in range(len(p.parent))])

    def value():
        scores = dict(all_states(m, p))
        return (scores[tuple(state)] - np.log(sum(np.exp(x) for x in scores.values()))) / f.n

    unary, edge = m.gradient(f, state)
    for array, grad in ((m.unary, unary), (m.edge, edge)):
        for at in [tuple(x) for x in np.argwhere(grad != 0)[:12]]:
            array[at] += 1e-5
            up = value()
            array[at] -= 2e-5
            down = value()
            array[at] += 1e-5
            assert np.isclose((up - down) / 2e-5, grad[at], atol=1e-6)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return H.train(pages, n_pages=100)


def marked(html):
    p = H.Page(html)
    s = H.states(p)
    return "\n".join(t for t, x in zip(p.text, s) if t and x)


def test_held_out_pages(pages, model):
    """Pages as they are, other layouts of them, and pages without any mark."""
    held = [r["html"] for r in pages.orderBy(F.desc(F.xxhash64("html"))).limit(100).collect()]
    assert [marked(h) for h in held] == H.texts(model, held)
    rng = random.Random(2)
    contents = [[t for t, s in zip(p.text, H.states(p)) if t and s] for p in map(H.Page, held)]
    others = [t for b in contents for t in b]
    made = [H.variant(rng, b, others) for b in contents]
    exact = sum(marked(h) == t for h, t in zip(made, H.texts(model, made)))
    assert exact >= 90
    plain = [h.replace("<article", "<div class='post'").replace("</article", "</div") for h in held]
    assert sum(marked(h) == t for h, t in zip(held, H.texts(model, plain))) >= 97


def test_parts_that_go(model):
    text = "The long and winding words of this page go on, and on, until they end. " * 6
    html = (f"<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class=cookie-notice>"
            f"We use cookies.</div><article><h1>Title</h1><p>{text}</p><div class=ad>Buy!</div>"
            f"<p>{text}</p><section class=comments><div class=comment><p>Nice words, thanks.</p></div>"
            f"</section></article><aside class=sidebar><p>More to read here</p></aside>"
            f"<form><label>Mail</label><button>Send</button></form><footer>&copy; Site</footer></body>")
    assert H.texts(model, [html]) == ["\n".join(["Title", text.strip(), text.strip()])]


def test_odd_rows(spark, pages, model):
    odd = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "u", "<article>" + "<p>x y z.</p>" * 40), (3, "u", " \n "),
         (3, "u", " \n "), (4, "u", "<html><head><title>t"), (5, "u", "<p>" + "w " * 200_000)],
        "page_id long, url string, html string")
    got = rows(H.extract(odd.withColumns({"text": F.lit("clash"), "tag": F.lit(1)}), model))
    assert len(got) == 7 and all(t is not None for _, _, t in got)
    assert [t for i, _, t in got if i in (1, 2, 3)] == ["", "", "", ""]
    assert rows(H.extract(odd.limit(0), model)) == []
    assert H.train(odd.where("page_id = 5")) is None
    kept = {r[0]: r[2] for r in rows(H.extract(odd, None))}
    assert len(kept[5]) == 399_999 and kept[None].count("\n") == 39
