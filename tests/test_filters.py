import pytest

from recensio.operators import filters


def kept(spark, function, texts):
    df = spark.createDataFrame([(t,) for t in texts], "clean_text string")
    return [r["clean_text"] for r in function(df).collect()]


def test_remove_junk(spark):
    texts = ["ok", "Top", "boh ", "!!!", "non ok", "", None]
    assert kept(spark, filters.remove_junk, texts) == ["!!!", "non ok", "", None]


def test_remove_junk_legacy(spark):
    texts = ["Top", "ok", "!!!", "<URL>", "<USER> !", "", "  ", "_-_"]
    assert kept(spark, filters.remove_junk_legacy, texts) == ["Top", "<URL>", "<USER> !"]


@pytest.mark.parametrize(
    "text, junk",
    [(None, True), ("", True), (" ?! ", True), ("Boh...", True), ("ok ok", False), ("pessima!", True), ("va", False)],
)
def test_is_junk_review(one, text, junk):
    assert one(filters.is_junk_review, text) is junk


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(100)
    first = [r["id"] for r in filters.sample_rows(df, "id").collect()]
    assert len(first) == 10
    assert first == [r["id"] for r in filters.sample_rows(df.repartition(7), "id").collect()]


def test_foreign_rows(spark):
    df = spark.createDataFrame([("it",), ("en",), (None,), ("unknown",)], "language string")
    assert [r[0] for r in filters.foreign_rows(df).collect()] == ["en"]


def test_junk_is_told_from_a_text_that_is_cleaned_once(spark):
    from pyspark.sql import functions as F

    from recensio.operators import filters

    rows = [("ok",), ("buona app",), ("!!!",), ("",), (None,), ("<URL>",), (" Top ",)]
    df = spark.createDataFrame(rows, "t string").withColumn("clean_text", F.regexp_replace("t", "SEEN", ""))
    kept = filters.remove_junk_legacy(df)
    assert sorted(r["t"] for r in kept.collect()) == [" Top ", "<URL>", "buona app"]
    plan = kept.select(F.lit(1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SEEN") == 1
