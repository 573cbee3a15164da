import itertools
import random
import time

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from skyphrase.llm import html_blocks as hb
from skyphrase.llm import layouts
from skyphrase.llm import main_text as mt
from skyphrase.llm.queries import op12_main_text

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def given():
    return [r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]


@pytest.fixture(scope="module")
def field(given):
    return mt.fit(layouts.composed(given[:150], mt.LAYOUTS))


def texts(html):
    return [b.text for b in hb.blocks(html)]


@pytest.mark.parametrize(
    "html, found",
    [
        (None, []), ("", []), (" \n\t", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<p>b</p>c", ["a", "b", "c"]), ("x <b>bo</b>ld<br>y", ["x bold y"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]), ("<table><tr><td>1<td>2<tr><td>3</table>4", ["1", "2", "3", "4"]),
        ("a<!-- <p>b --><!--> c <!-->d", ["a c d"]), ("a<!-- never closed <p>b", ["a"]), ("<script>if (a<b) '</p>'</script>t<STYLE>p{}</style >u", ["tu"]), ("<script>open <p>x</p>", []),
        ("<title>T</title><textarea><p>x</textarea>y", ["y"]), ("1 < 2 & 3 &lt; 4 &copy &am", ["1 < 2 & 3 < 4 © &am"]), ("<p title='a>b' class=\"x>y\">z</p>", ["z"]), ("a <p class=\"un", ["a"]),
        ("<?php x ?>a<!DOCTYPE html>b</>c</ p>d", ["abcd"]), ("</p></div>a</section>b", ["a", "b"]), ("<div>a<hr>b</div>", ["a", "b"]), ("nb&nbsp;sp   z&#x41;&#0;", ["nb sp zA�"]), ("<DIV>Ü&uuml;</DiV>", ["Üü"]),
        ("<h1>a<h2>b</h2>c", ["a", "b", "c"]), ("<p><div>a</div>b</p>c", ["a", "b", "c"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("<a href=x>l</a> t", ["l t"]),
    ],
)
def test_blocks(html, found):
    assert texts(html) == found


def test_blocks_know_what_is_around_them():
    nav, body = hb.blocks("<div class='siteNav main-menu' id=n1><ul><li><a href=/>Home</a></ul></div><article><p>Some text</article>")
    assert {"in:li", "in:ul", "in:div", "word:site", "word:nav", "word:menu", "stem:site", "in:body"} <= set(nav.node.path)
    assert nav.linked == 4 and body.linked == 0 and "in:article" in body.node.path and "in:div" not in body.node.path
    assert hb.blocks("<div class=a1b><p class=zz>x", known={"in:p"})[0].node.path == ("in:p",)


def test_awkward_pages_take_linear_time():
    for one in ("<div>", "<p", "<a href='", '<a b="', "<!-", "&", "<li>", "<div class=x{}>y", "</p>", "<b>x", "<table><tr><td>z", "<", "x ", "<!-- ", "<script>", "<blockquote>q"):
        began = time.perf_counter()
        page = "".join(one.replace("{}", str(k)) for k in range(40_000))
        hb.blocks(page, {"in:div"})
        assert time.perf_counter() - began < 8, one


def small():
    rng = np.random.default_rng(0)
    emit, kind = rng.normal(size=(3, 5)), rng.integers(0, 3, (3, 5))
    held = np.arange(5) < np.array([5, 3, 1])[:, None]
    gold = (rng.random((3, 5)) < 0.5) * held.astype(float)
    return emit * held, gold, kind, held, rng.normal(size=(3, 2, 2)), rng.normal(size=2)


def plain(emit, gold, kind, held, edges, start):
    """Log-likelihood by adding up all state sequences."""
    total = 0.0
    for e, g, k, h in zip(emit, gold, kind, held, strict=True):
        n = int(h.sum())
        score = lambda s, n=n, e=e, k=k: start[s[0]] + sum(e[t] * s[t] for t in range(n)) + sum(edges[k[t]][s[t - 1]][s[t]] for t in range(1, n))
        total += score([int(x) for x in g[:n]]) - np.log(sum(np.exp(score(s)) for s in itertools.product((0, 1), repeat=n)))
    return total


def test_likelihood_and_slopes_against_plain_sums():
    args = small()
    value, by_block, by_edge, by_start = mt.likelihood(*args)
    assert np.isclose(value, plain(*args))
    for which, slope in ((0, by_block), (4, by_edge), (5, by_start)):
        for at in np.ndindex(args[which].shape):
            if which == 0 and not args[3][at]:
                continue
            step = [a.copy() for a in args]
            step[which][at] += 1e-5
            assert np.isclose((plain(*step) - plain(*args)) / 1e-5, slope[at], atol=1e-3)


def test_viterbi_against_all_sequences():
    rng = random.Random(3)
    page = "<nav><p>a b<p>c</nav><div><h1>Head</h1><p>text one, two.<p>more</div>x<aside><p>side</aside><footer>© foot</footer>"
    found = hb.blocks(page)
    for _ in range(30):
        names = {f for b in found for f in (*b.node.path, *mt.features(b))}
        own = mt.Field({f: rng.gauss(0, 0.4) for f in names}, np.array([[[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)] for _ in range(3)]), np.array([rng.gauss(0, 1), 0.0]))
        score, kinds = own.scores(found), [mt.edge(a.node, b.node) for a, b in zip(found, found[1:], strict=False)]
        value = lambda s: own.start[s[0]] + sum(a * b for a, b in zip(score, s, strict=True)) + sum(own.edges[k][a][b] for k, a, b in zip(kinds, s, s[1:], strict=False))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(found)), key=value)
        assert own.main(found) == [bool(x) for x in best]


def test_labels_are_matched_in_order():
    found = hb.blocks("<p>a<p>b<p>a<p>c<p>a b")
    assert mt.matched(found, "a c") in ([1, 0, 0, 1, 0], [0, 0, 1, 1, 0]) and mt.matched(found, "") == [0] * 5
    assert mt.matched(found, "a b a c a b") == [1] * 5 and mt.matched(found, "c b") is None and mt.matched(found, "a bb") is None
    assert mt.fit([]).text("<p>x") == mt.fit([("<p>x", "other")]).text("<p>x")


def test_held_out_layouts(given, field):
    right = total = exact = 0
    pages = list(layouts.composed(given[150:], 250, seed=77))
    for html, text in pages:
        found = hb.blocks(html)
        gold = mt.matched(found, text)
        right += sum(int(a) == b for a, b in zip(field.main(found), gold, strict=True))
        total += len(found)
        exact += field.text(html) == text
    assert right / total > 0.985 and exact / len(pages) > 0.88


LOREM = "The river rose in the night, and by morning the lower streets were under water. People carried what they could to the school on the hill."
ODD = [
    (f"<body><div class='c-masthead'><a href=/>The Gazette</a></div><div class='c-nav'><a href=/a>World</a> <a href=/b>Sport</a></div><div class='c-article__body'><h1>Flood</h1><p>{LOREM}</p><p>It rained.</p><p>{LOREM}</p></div><div class='c-sidebar'><h3>Related</h3><p><a href=/x>Another story that is linked here</a></p></div><div class='c-footer'>© 2023 The Gazette</div>", f"Flood {LOREM} It rained. {LOREM}"),
    (f"<main><p>{LOREM}</p><aside class=promo><p>Subscribe now</p></aside><p>Short one.</p><form><label>Email</label><button>Go</button></form><p>{LOREM}</p></main><section id=comments><h2>2 comments</h2><div class=comment><p>{LOREM}</p></div></section>", f"{LOREM} Short one. {LOREM}"),
    (f"<table><tr><td class=menu><a href=/>Home</a><a href=/2>Two</a></td><td class=content><h1>Head</h1>{LOREM}<p>{LOREM}</p></td></tr></table><div class=footer>Copyright</div>", f"Head {LOREM} {LOREM}"),
    (f"<div class='cookie-consent-bar'><p>We use cookies to make this site better for you.</p><button>Accept</button></div><article><h2>Title here</h2><p>{LOREM}</p><ul><li>one<li>two</ul><p>{LOREM}</p></article><footer><p>{LOREM}</p></footer>", f"Title here {LOREM} one two {LOREM}"),
]


@pytest.mark.parametrize("k", range(len(ODD)))
def test_pages_written_by_hand(field, k):
    assert field.text(ODD[k][0]) == ODD[k][1]


def pages_table(spark, rows):
    df = spark.createDataFrame(rows, PAGES)
    for name in ("text", "n_chars", "p", "h", "a.b"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = op12_main_text(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(mt.oracle()).fetchall())
    assert "Exchange" not in got._jdf.queryExecution().toString()


def test_awkward_rows(spark, field):
    body = "<nav><a href=/>Home</a></nav><article><h1>T&amp;T</h1>" + "".join(f"<p>{LOREM} {k}</p>" for k in range(30_000)) + "</article><footer>© x</footer>"
    deep = "<div>" * 5000 + "<article><p>" + LOREM
    rows = [(1, "u", None), (2, None, ""), (3, "u", " "), (3, "u", " "), (None, "u", f"<article><p>{LOREM}</article>"), (4, "u", body), (5, "u", deep), (6, "u", "<script>x"), (7, "u", "x" * 300_000)]
    got = {(r["page_id"], r["url"]): r for r in mt.extract(pages_table(spark, rows), field).collect()}
    assert mt.extract(pages_table(spark, rows), field).count() == len(rows)
    for key in ((1, "u"), (2, None), (3, "u"), (6, "u")):
        assert got[key]["text"] == "" and got[key]["n_chars"] == 0
    assert got[(None, "u")]["text"] == LOREM and got[(5, "u")]["text"] == LOREM
    assert got[(4, "u")]["text"] == " ".join(["T&T"] + [f"{LOREM} {k}" for k in range(30_000)])


@pytest.mark.parametrize("rows", [[], [(1, "u", None)]], ids=["empty", "null"])
def test_tables_without_text(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(mt, "LAYOUTS", 5)
    pages_table(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    assert [tuple(r) for r in op12_main_text(spark, str(tmp_path)).collect()] == [(1, "u", "", 0)] * len(rows)
