"""URL filter, top-k search, page extraction, the registry and the pipeline."""

import itertools
import math
import random

import duckdb
import numpy as np
import pytest

from textkiln.llm import html_extract, html_tree, topk_search, url_filter
from textkiln.llm.page_labels import labelled_pages
from textkiln.llm.url_labels import labelled_urls

# --- 8 ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.fit(labelled_urls(spark))


def test_url_parts_rules_and_model(spark, url_model):
    urls = [
        (1, "http://A.Example.ORG/es/1"), (2, "https://example.org/en/12"), (3, "https://x.example.org/en/2"), (4, "ftp://b.com/fr/x?y#z"), (5, "http://b.com/de/"),
        (6, None), (7, "no scheme"), (8, ""), (9, "http://notorg/es/"), (10, "http://h?q=http://u/v"), (11, "https://free-casino-bets.example.net/en/7"),
        (12, "https://quiet-garden.example.net/en/7"), (12, "https://quiet-garden.example.net/en/7"), (None, "http://org/"), (13, "a://b://c/d"),
        (14, "http://long.example.net/" + "a" * 20_000), (15, "http://example.org"), (16, "line\nbreak://Host/Path\nmore#x"),
    ]
    df = spark.createDataFrame([(*u, "clash") for u in urls], "page_id long, url string, host string")
    rows = url_filter.judge(df, url_model).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls)
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3][2:] == ("org/", "allow") and got[4] == ("b.com", "/fr/x", "com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6][:3] == got[7][:3] == got[8][:3] == ("", "", None) and got[9][2] is None
    assert got[10][:2] == ("h", "") and got[13][:2] == ("b:", "//c/d") and got[15][:3] == ("example.org", "", None)
    assert got[16][:2] == ("host", "/Path\nmore")
    assert got[11][3] == "block" and got[12][3] == "allow"
    assert url_filter.judge(df.limit(0), url_model).count() == 0


def test_url_parts_and_rules_equal_sql(spark, url_model):
    """Host, path, rule and the rules' verdicts of all pages against DuckDB; the method decides the rest."""
    sf = "/root/testdata/sf0.01/pages.parquet"
    rules = ", ".join(f"('{d}', '{r}')" for d, r in url_filter.RULES)
    want = duckdb.sql(f"""
        WITH parts AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM read_parquet('{sf}')),
        cut AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        named AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM cut),
        rules(decision, rule) AS (VALUES {rules}),
        fits AS (
          SELECT page_id, rule, decision, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place
          FROM named JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
            AND starts_with(path, substr(rule, strpos(rule, '/'))))
        SELECT n.page_id, host, path, rule, decision FROM named n LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)""").fetchall()
    got = url_filter.judge(spark.read.parquet(sf), url_model).collect()
    assert len(got) == len(want) and any(w[3] for w in want)
    own = {r.page_id: r for r in got}
    for page_id, host, path, rule, decision in want:
        r = own[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (decision or ("block" if r.score >= 0.5 else "allow"))


# --- 9 ---------------------------------------------------------------------


def brute_top(rows, is_query, k=5):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in sound:
        if is_query(q):
            best = sorted(((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in sound if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1 + (i % 7), 8).round(2)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(6)]  # ties
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * 6), (2100, [math.nan] * 8), (2150, [math.inf] + [0.0] * 7), (2200, []), (2250, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    for block in (4096, 3):
        got = sorted(map(tuple, topk_search.top_k(df, topk_search.F.col("vec_id") % 50 == 0, block=block).collect()))
        assert got == brute_top(rows, lambda q: q % 50 == 0)
    assert topk_search.top_k(df.limit(0), topk_search.F.col("vec_id") % 50 == 0).count() == 0
    few = df.filter("vec_id IN (50, 51)")
    assert [tuple(r)[:3] for r in topk_search.top_k(few, topk_search.F.col("vec_id") % 50 == 0).collect()] == [(50, 1, 51)]


# --- 10 --------------------------------------------------------------------


@pytest.fixture(scope="module")
def page_model():
    return html_extract.fit(labelled_pages())


def test_messages_give_exact_marginals():
    """Against the sum over all labelings of a small tree."""
    page = '<div class="menu"><p>a</p></div><article><h1>b</h1><p>c c c.</p><ul><li>d</ul></article>'
    nodes, _ = html_tree.parse(page)
    x, parent = html_extract._forest([nodes])
    rng = np.random.default_rng(3)
    model = html_extract.Model(rng.normal(0, 0.5, x.shape[1]), rng.normal(0, 0.5, (html_extract.EDGES, 2, 2)))
    p, pairs, log_z = html_extract.marginals(model, x, parent)
    theta, psi = x @ model.unary, np.einsum("ne,eab->nab", html_extract._edge_features(x, parent), model.pair)
    total, each = 0.0, np.zeros(len(x))
    for y in itertools.product((0, 1), repeat=len(x)):
        s = sum(theta[i] * y[i] for i in range(len(x))) + sum(psi[i, y[parent[i]], y[i]] for i in range(len(x)) if parent[i] >= 0)
        total += math.exp(s)
        each += math.exp(s) * np.array(y)
    assert np.allclose(p, each / total) and math.isclose(log_z, math.log(total))
    assert np.allclose(pairs[1:].sum(axis=(1, 2)), 1) and np.allclose(pairs[1:, :, 1].sum(1), p[1:])


def test_held_out_layouts(page_model):
    s = "The old mill turned slowly, and nobody in the village knew why it had not stopped years before."
    pages = {
        f"<body><nav><ul><li><a href=x>a</a></ul></nav><article><h1>T</h1><p>{s}</p><ul><li>x one</li></ul></article><aside><p>{s}</p></aside><footer><p>{s}</p></footer>": f"T\n{s}\nx one",
        f'<div class="cookie-banner"><p>{s}</p></div><main><article><h1>T</h1><p>{s}</p><aside class="related"><p>{s}</p></aside><p>end</p></article><section class="comments"><p>{s}</p></section></main>': f"T\n{s}\nend",
        f'<article><h1>A &amp; B&nbsp;C &#8364;</h1><p>one\n two <b>three</b><i>four</i></p><pre>a\n  b</pre><script>if(a<b)"</p>"</script></article><div class="notice">{s}</div>': "A & B C €\none two threefour\na b",
        f"<nav><li>x</nav><div class=ad>{s}</div><article><h1>T<p>one {s}<p>two</article><footer>&copy; {s}": f"T\none {s}\ntwo",
    }
    assert html_extract.texts(page_model, list(pages)) == list(pages.values())


def test_extract_odd_pages(spark, page_model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>a <b>b</i></p"), (3, "u", "<article><p>a <b>b</i></p"), (None, "u", "<!-- open <p>x</p>"), (5, "u", deep),
            (6, "u", "<article><h1>T</h1>" + "<p>word word, word.</p>" * 5000 + "</article>"), (7, "u", '<p title="a>b">q<br>r</p><a href="'), (8, "u", "<" * 2000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extract(df, page_model).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[None].text == "" and by[6].text.count("\n") == 5000
    assert html_extract.extract(df.limit(0), page_model).count() == 0


def test_marked_text_never_leaks_markup():
    rng = random.Random(0)
    bits = ["<p>", "</p>", "<div class='x'>", "</div>", "1 &lt;", "<b>", "</b>", "<script>var a='<p>'</script>", "<!-- c -->", "<ul><li>", "<table><tr><td>", "</table>", "<", ">", "&", "<br/>"]
    for _ in range(300):
        page = "".join(rng.choice(bits) for _ in range(30))
        nodes, segments = html_tree.parse(page)
        assert all(n.parent < i for i, n in enumerate(nodes)) and all("var a" not in t for _, t in segments)


# --- registry and pipeline -------------------------------------------------


def test_registered(spark):
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_pipeline_stages(spark):
    import corpus_pipeline
    from textkiln.llm import decontaminate
    from textkiln.llm.common import table, written

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    left = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), f"test-{name}")
        left.append(docs.count())
        if name != "mix":
            assert docs.columns == columns
    assert left[0] > left[1] > left[2] >= left[3] > left[4]
    hits = decontaminate.report(docs, table(spark, sf, "benchmark"))
    assert hits.filter("contaminated").count() == 0
    assert docs.groupBy("doc_id").count().filter("count > 2").count() == 0
    again = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_letters_that_change_length_and_pictures_inside_words():
    from textkiln.llm import html_tree

    for pad in (1, 40_000):
        page = "<p>" + "İ" * 120 * pad + "</p><SCRIPT>x</Script><p>next paragraph stays</p><style>y</STYLE><p>foo<img>bar</p>"
        texts = [t for _, t in html_tree.parse(page)[1]]
        assert texts[1:] == ["next paragraph stays", "foobar"]
    assert [t for _, t in html_tree.parse("<b>" * 100_000 + "x" + "</i>" * 100_000 + "</b>" * 100_000)[1]] == ["x"]
