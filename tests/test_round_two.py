"""Ties in quantiles, hot keys, single plans, whole crosstabs, logged flows."""

import pytest
from pyspark.sql import functions as F

from recensio.operators import rarity, scale, summary, translate
from recensio.plans import flows
from recensio.sources import readers, writers


@pytest.mark.parametrize("n", [21, 42])
def test_equal_idf_values_are_not_rare(spark, n):
    shared = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    rows = [(i, shared) for i in range(5)] + [(5 + i, "zz yy") for i in range(n)]
    got = rarity.rare_token_ratio(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
    assert {r["rare_token_ratio"] for r in got} == {0.0}


def test_quantiles_of_equal_values_are_exact(spark):
    rows = [("a", 0.1 + 0.2)] * 7 + [("a", 1.0)] * 3
    df = spark.createDataFrame(rows, "g string, v double")
    points = {f"p{i}": i / 37 for i in range(24)}
    row = scale.exact_quantiles(df, "g", "v", points).first()
    assert all(row[p] == 0.1 + 0.2 for p in points)


def test_hot_key_that_the_table_lacks(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    facts = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    dim = spark.range(1, 3_000, 3).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    joined = scale.lookup_join(facts, dim, ["k"], rows=0)
    assert joined.count() == 3_000
    assert joined.filter("v is not null").count() == joined.filter("v = id * 2 and id % 3 = 1").count() == 1_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_hot" in plan
    assert scale.lookup_join(facts, dim, ["k"], "inner", rows=0).count() == 1_000


def test_measuring_needs_no_single_partition_limit(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"))
    assert scale.fits_broadcast(df) and not scale.fits_broadcast(df, rows=9) and not scale.fits_broadcast(df, size=5)


def test_numbers_in_order(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 5).alias("n"))
    got = {r["id"]: r["pos"] for r in scale.number_in_order(df, [F.desc("n"), F.asc("id")], "pos").collect()}
    want = sorted(range(500), key=lambda i: (-(i * 7 % 5), i))
    assert [got[i] for i in want] == list(range(500))


def test_translation_plans_its_input_once(spark):
    texts = spark.createDataFrame([(1, "hello there", "en"), (2, "bonjour", "fr"), (3, None, None)], "review_id long, review string, lang string")
    input_once = texts.withColumn("detected_lang", F.concat("lang", F.lit("")))
    table = spark.createDataFrame([("fr", "bonjour", "hello")], "lang string, source_text string, target_text string")
    out = translate.translate(input_once, table, home="en")
    assert {r["review_id"]: r["final_text"] for r in out.collect()} == {1: "hello there", 2: "hello", 3: None}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_crosstab_of_all_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 9), ("b", 2)], "r string, c int")
    assert set(summary.crosstab(df, "r", "c").columns) == {"r", "1", "2", "9"}
    share = summary.crosstab_shares(df, "r", "c", [1]).filter("r = 'a'").first()
    assert abs(share["1"] - 1 / 3) < 1e-12


def test_malformed_rows(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"review_id": 1, "rating": "many"}\n{"review_id": 2, "rating": 3.5}\n')
    path = str(tmp_path / "x.json")
    assert readers.load_table(spark, path).count() == 2
    assert [r["review_id"] for r in readers.load_table(spark, path, malformed="drop").collect()] == [2]
    with pytest.raises(Exception, match="(?i)malformed|cannot"):
        readers.load_table(spark, path, malformed="fail").collect()
    with pytest.raises(ValueError):
        readers.load_table(spark, path, malformed="odd")


def test_topic_table_is_logged(spark, tmp_path):
    info = spark.createDataFrame([(0, 7, "0_a"), (-1, 2, "-1_b")], "topic int, count long, name string")
    rows = {r["metric"]: r["value"] for r in writers.table_rows(info, "run", "topic", "topic").collect()}
    assert rows == {"topic.0.count": 7.0, "topic.-1.count": 2.0}


def test_too_few_rows_write_nothing(spark, tmp_path):
    assert flows.write_topics({}, str(tmp_path), "run") == {}
