import pytest
from pyspark.sql import functions as F

from conftest import SF01
from textkiln.functions.html_blocks import extract_blocks
from textkiln.operators import html_text as H
from textkiln.sources.tables import load


@pytest.mark.parametrize("html, expected", [
    ("<p>one<p>two <b>x</b></p>three</p>", ["one two x three", "two x"]),
    ("<ul><li>a<p>b</p></li></ul>", ["a b", "b"]),
    ("<nav><li>q</li></nav><p>a&amp;b<!-- c -->d</p>", ["a&b d"]),
    ('<p>x<script>var t="</p>";</script>y</p>', ["x y"]),
    ("<h1> Title </h1><h2>t2</h2><h3>t3</h3><h4>no</h4>", ["Title", "t2", "t3"]),
    ("<p>a<br>b<br/>c</p>", ["a b c"]),
    ("<footer><p>gone</p></footer><header><h1>gone</h1></header><p>kept</p>", ["kept"]),
    ("<noscript><p>n</p></noscript><style>p{}</style><p>s</p>", ["s"]),
    ("<p>unclosed <nav>inside</nav> after", ["unclosed after"]),
    ("</p><p>  </p>", [""]),
])
def test_block_semantics(html, expected):
    assert [t for _, t in extract_blocks(html)] == expected


def test_min_length_is_inclusive(spark):
    p39, p40 = "a" * 39, "b" * 40
    pages = spark.createDataFrame([(1, "u", f"<p>{p39}</p><p>{p40}</p>")], "page_id long, url string, html string")
    row = H.page_text(pages).first()
    assert row["text"] == p40 and row["n_blocks"] == 1


def test_bad_page_is_quarantined(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "v", "<p>" + "x" * 50 + "</p>")], "page_id long, url string, html string")
    assert H.page_quarantine(pages).count() == 1
    assert [r["page_id"] for r in H.page_text(pages).collect()] == [2]


def test_sf001_counts_and_no_shuffle(spark):
    pages = load(spark, SF01, "pages")
    blocks = H.page_blocks(pages)
    assert blocks.count() == 2608
    assert blocks.where("kept").count() == 2282
    text = H.page_text(pages)
    assert text.count() == 250
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_page_text_matches_python(spark):
    pages = load(spark, SF01, "pages").orderBy("page_id").collect()
    got = {r["page_id"]: r["text"] for r in H.page_text(load(spark, SF01, "pages")).collect()}
    for p in pages[:60]:
        expect = "\n".join(t for _, t in extract_blocks(p["html"]) if len(t) >= 40)
        assert got[p["page_id"]] == expect


def test_cdata_is_text():
    assert extract_blocks("<p>a<![CDATA[b]]>c</p>") == [("p", "a b c")]


def test_large_batches_are_parsed_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(H, "PART_BYTES", 100)
    html = ["<p>" + "x" * n + "</p>" for n in (10, 10, 300, 10, 70, 70)] + [None, ""]
    n = len(html)
    batch = pa.record_batch({"page_id": pa.array(range(n), pa.int64()), "url": pa.array(["u"] * n), "html": pa.array(html)})
    out = list(H._parse_batches([batch]))
    assert [len(b) for b in out] == [2, 1, 2, 3]
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["page_id"] for r in rows] == list(range(n))
    assert [r["blocks"] and [b["text"] for b in r["blocks"]] for r in rows] == [["x" * k] for k in (10, 10, 300, 10, 70, 70)] + [None, []]
    assert rows[6]["error"]
