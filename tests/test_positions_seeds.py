import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from textkiln.operators.positions import group_offsets, ordered_offsets, row_index
from textkiln.sources.seeds import EmptyInputError, read_seed_file, require_nonempty, seed_items


def test_offsets_equal_unpartitioned_window(spark):
    df = spark.range(0, 20000).withColumn("w", F.col("id") * 7 % 13).withColumn("k", F.sha2(F.col("id").cast("string"), 256))
    got = ordered_offsets(df, ["k"], "w", "off", num_partitions=7)
    ref = df.withColumn("ref", F.coalesce(F.sum("w").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert got.join(ref.select("id", "ref"), "id").where("off != ref").count() == 0


def test_group_offsets_with_a_hot_group(spark):
    # Group "hot" holds a third of the rows; it must spread over partitions
    # and still give the per-group running sum of a partitioned window.
    df = spark.range(0, 9000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 17).cast("string"))).alias("g"),
        (F.col("id") * 5 % 11).alias("w"),
    )
    got = group_offsets(df, ["g"], [F.col("id").desc()], "w", "off", num_partitions=6)
    w = Window.partitionBy("g").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("ref", F.coalesce(F.sum("w").over(w), F.lit(0)))
    assert got.count() == 9000
    assert got.join(ref.select("id", "ref"), "id").where("off != ref").count() == 0
    ranks = group_offsets(df, ["g"], ["id"], out="r", num_partitions=6)
    hot = ranks.where("g = 'hot'").orderBy("id").select("r").collect()
    assert [r["r"] for r in hot] == list(range(3000))


def test_row_index_descending_keys(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "t string, c long")
    got = {r["t"]: r["i"] for r in row_index(df, [F.col("c").desc(), F.col("t").asc()], "i").collect()}
    assert got == {"c": 0, "a": 1, "b": 2, "d": 3}


LINES = ["# c", "  # c", "", "   ", "\titem1", "dup", "dup", "a # b", "  ÜberSeite  ", "https://x.example/y"]


def test_seed_rule(spark):
    lines = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "line_no long, line string")
    got = [(r["seed_pos"], r["item"]) for r in seed_items(lines, ["line_no"]).orderBy("seed_pos").collect()]
    expect = [l.strip() for l in LINES if l.strip() and not l.strip().startswith("#")]
    assert got == list(enumerate(expect, 1))


def test_seed_file(spark, tmp_path):
    p = tmp_path / "seeds.txt"
    p.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    got = [r["item"] for r in read_seed_file(spark, str(p)).orderBy("seed_pos").collect()]
    assert got == [l.strip() for l in LINES if l.strip() and not l.strip().startswith("#")]


def test_empty_guard(spark):
    with pytest.raises(EmptyInputError):
        require_nonempty(spark.createDataFrame([], "x int"), "seed list")
    assert require_nonempty(spark.range(1), "x").count() == 1


def test_seed_file_missing_or_without_items(spark, tmp_path):
    with pytest.raises(EmptyInputError):
        read_seed_file(spark, str(tmp_path / "absent.txt"))
    p = tmp_path / "only_comments.txt"
    p.write_text("# a\n\n   \n  # b\n", encoding="utf-8")
    with pytest.raises(EmptyInputError):
        read_seed_file(spark, str(p))


def test_empty_corpus_stops_training_and_stream(spark):
    from textkiln.operators import bpe as B
    from textkiln.operators import token_stream as S

    empty = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(EmptyInputError):
        B.train_bpe(empty, vocab_size=260)
    with pytest.raises(EmptyInputError):
        S.pretoken_stream(empty)
