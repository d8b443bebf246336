import pytest
from pyspark.sql import functions as F

from textkiln.functions.text import py_nonblank, py_splitlines, py_strip, seed_item_array, strip_reference_sections

EDGE = ["", " ", "\t a \t", " x ", "\x1cy\x1f", "　z ", "a b", "\n\n", "\x85q", "ß  "]


def test_strip_and_blank_like_python(spark):
    df = spark.createDataFrame([(s,) for s in EDGE], "s string")
    rows = df.select("s", py_strip("s").alias("t"), py_nonblank("s").alias("nb")).collect()
    for r in rows:
        assert r["t"] == r["s"].strip()
        assert r["nb"] == bool(r["s"].strip())


def test_splitlines_like_python(spark):
    texts = ["a\nb", "a\r\nb\rc", "x\x0by\x0cz", "p\x1cq\x1dr\x1es", "u\x85v w ", "end\n"]
    df = spark.createDataFrame([(s,) for s in texts], "s string")
    for r in df.select("s", py_splitlines("s").alias("l")).collect():
        s = r["s"]
        trailing = [""] if s and (s + "x").splitlines()[-1] == "x" and s.splitlines() else []
        assert list(r["l"]) == s.splitlines() + trailing


CUT = [
    ("a\nLiteratur\nb\nQuellen\nc", "a"),
    ("Literatur\nb", "Literatur\nb"),
    ("a\nLiteratur", "a\nLiteratur"),
    ("a\n== Literatur ==\nb", "a\n== Literatur ==\nb"),
    ("\U0001F600ß\nSiehe auch\nz\n", "\U0001F600ß"),
    ("x\nWeblinks  \n\ny", "x"),
    ("x\nFußnoten\t\ny", "x"),
    ("no headings\nat all", "no headings\nat all"),
    ("t\nEinzelnachweise\n", "t"),
    ("a\nAnmerkungen\nb\nLiteratur\nc", "a"),
]


@pytest.mark.parametrize("text, expected", CUT)
def test_reference_cut(spark, text, expected):
    import re

    py = re.compile(r"\n(?:Einzelnachweise|Weblinks|Siehe auch|Literatur|Anmerkungen|Fußnoten|Quellen)\s*\n")
    m = py.search(text)
    assert (text[: m.start()] if m else text) == expected
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strip_reference_sections("t")).first()[0] == expected


def test_strip_passes_inner_blanks_once(spark):
    import time

    long = "a" + " " * 1_000_000 + "b"
    df = spark.createDataFrame([(long,), (" " + long + " \n",)], "s string")
    began = time.time()
    assert [r[0] for r in df.select(py_strip("s")).collect()] == [long, long]
    assert time.time() - began < 20


BREAKS = "one\rtwo \x0b # no\x0cthree#\x1c\x1d\x1e four\x1f\x85\u2028\t#no\u2029 five \u3000\r\n\n  \nsi x\n#\nend\xa0"


def _by_rule(text):
    return [s.strip() for s in text.splitlines() if s.strip() and not s.strip().startswith("#")]


def test_seed_rule_in_one_pattern(spark):
    import random

    rnd = random.Random(5)
    texts = [BREAKS, "", "#", "x", *("".join(rnd.choices("ab# \t\n\r\x0b\x1c\x1f\x85\xa0\u2028", k=rnd.randint(0, 40))) for _ in range(300))]
    df = spark.createDataFrame([(s,) for s in texts], "s string")
    for r in df.select("s", seed_item_array("s").alias("i")).collect():
        assert list(r["i"]) == _by_rule(r["s"]), r["s"]


def test_seed_file_and_table_agree(spark, tmp_path):
    from textkiln.sources.seeds import read_seed_file, text_seed_items

    text = BREAKS * 50
    (tmp_path / "list.txt").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = [r["item"] for r in read_seed_file(spark, str(tmp_path / "list.txt")).orderBy("seed_pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    table = text_seed_items(spark.createDataFrame([(1, text)], "k int, text string"), "k").orderBy("seed_pos").collect()
    assert found == [r["item"] for r in table] == _by_rule(text) and [r["seed_pos"] for r in table] == list(range(1, len(table) + 1))
