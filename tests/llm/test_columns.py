"""Columns of the caller keep their values, ids may be texts, and samples stay bounded."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recensio.llm import backoff, boosting, credentials, langnet, leaks, mixing, quality, repeats, similar_sets, sketch
from recensio.llm.names import free_names, on_apart
from recensio.llm.ship import ship

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
NAMES = (
    "_quality score sampled ratio probability n_tokens mix_topic fit n_words hit_words hit_items _leak_key _lettered _other_0 "
    "_mix_source _cell_lang tokens topic class unit _id _text group text_hash size shard"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_names():
    assert free_names(["a", "B"], "b", "a", "a", "c") == ["b_", "a_", "a__", "c"]


@pytest.mark.parametrize("place", range(4))
def test_stages_keep_the_callers_values(spark, docs, place):
    odd = docs.limit(60).withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in NAMES})
    name, stage = corpus_pipeline.STAGES[place]
    kept = stage(spark, odd, SF_DIR)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert rows, name
    for r in rows:
        assert all(r[n] == f"{n}:{r['doc_id']}" for n in NAMES)
    plain = stage(spark, docs.limit(60), SF_DIR)
    assert sorted(r["doc_id"] for r in plain.collect()) == sorted(r["doc_id"] for r in rows)


def test_operators_keep_the_callers_values(spark, docs):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    odd = docs.limit(30).withColumns({n: F.lit("x") for n in ("_lettered", "_leak_key", "_cell_source", "hit_words", "n_words")})
    named = langnet.predict(odd, None)
    assert {r["_lettered"] for r in named.select("_lettered").collect()} == {"x"}
    found = leaks.find_leaks(odd, items)
    assert {r["_leak_key"] for r in found.select("_leak_key").collect()} == {"x"} and dict(found.dtypes)["hit_words"] == "array<int>"
    assert {r["_cell_source"] for r in mixing.mix(odd).select("_cell_source").collect()} == {"x"}
    assert on_apart(odd, ["doc_id"], lambda d: d.withColumn("more", F.lit(1))).columns == odd.columns


def test_the_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i % 997}" for i in range(5_000))
    rows = [(1, None, "en", "a", 3), (2, "", None, None, 3), (2, "", None, None, 3), (None, None, None, None, None), (3, long, "de", "b", 2)]
    rows += [(10 + i, f"A short sentence of number {i} that is like the others in its words. " * (1 + i % 5), "en", "a", 1) for i in range(20)]
    for name, data in (("odd", rows), ("none", [])):
        top = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{top}/documents.parquet")
        spark.createDataFrame([(0, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
        labels = [(r[0], i % 2) for i, r in enumerate(data) if r[0] and r[0] >= 10]
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{top}/labels.parquet")
        got = corpus_pipeline.run(spark, top).collect()
        assert len(got) <= len(data) and len({(r["shard"], r["slot"]) for r in got}) == len(got)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            df = spark.read.parquet(f"{top}/documents.parquet")
            out = stage(spark, df, top)
            assert number == 4 or out.columns == df.columns
            assert out.count() <= len(data)


def named(i):
    return None if i is None else f"d{i:06d}"


@pytest.mark.parametrize("name", ["score", "repeats", "fingerprints", "secrets", "classes", "one"])
def test_ids_of_text_give_what_numbers_give(spark, docs, name):
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(150).collect()]
    rows += [(rows[0][0] + 500_000, rows[0][1]), (rows[0][0] + 500_000, rows[0][1]), (None, rows[1][1]), (700_000, None), (700_001, "")]
    train = F.length("text") % 3 != 0
    work = {
        "score": lambda d: backoff.score_texts(d, train).select("doc_id", "n_tokens", F.round("score", 6).alias("s")),
        "repeats": lambda d: repeats.remove_repeats(d).select("doc_id", "n_removed", "kept_text"),
        "fingerprints": lambda d: sketch.edited_likeness(d).select("doc_id", F.md5("edited").alias("e"), F.size("sketch").alias("n")),
        "secrets": lambda d: credentials.scan(d, credentials.train([])).select("doc_id", F.to_json("spans").alias("s")),
        "classes": lambda d: similar_sets.similarity_classes(d).select("doc_id", "class_id", "n_links"),
        "one": lambda d: similar_sets.one_of_each(d),
    }[name]
    plain = work(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = work(spark.createDataFrame([(named(i), t) for i, t in rows], "doc_id string, text string")).collect()
    ids = ("doc_id", "class_id")
    want = sorted(str([named(v) if n in ids else v for n, v in r.asDict().items()]) for r in plain)
    assert sorted(str(list(r.asDict().values())) for r in texts) == want


def test_samples_are_bounded_where_one_text_fills_a_third(spark, monkeypatch):
    ship(spark)
    rows = [(i, "one and the same text in very many rows of the table", "en") for i in range(300)]
    rows += [(1000 + i, f"words of their own number {i} here", "en" if i % 2 else "de") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langnet, "train", lambda w, y, langs: seen.append(len(w)))
    langnet.fit(df, most=20)
    assert 0 < seen[0] <= 2 * 20 * langnet.TRAIN_WINDOWS
    monkeypatch.setattr(credentials, "train", lambda words: seen.append(words))
    credentials.fit(df, most=30)
    assert 0 < len(seen[1]) <= 30 * credentials.TRAIN_WORDS
    for fit in (lambda d: langnet.fit(d, most=20), lambda d: credentials.fit(d, most=30)):
        fit(df.repartition(7))
    assert seen[2] == seen[0] and seen[3] == seen[1]


def test_scores_without_a_rule_for_ids(spark):
    """One id in a third of the rows: its rows are spread by their texts, and scored as if they had ids of their own."""
    ship(spark)
    rows = [(7 if i % 3 == 0 else i, f"word{i % 11} other{i % 5} last") for i in range(90)]
    own = [(i, t) for i, (_, t) in enumerate(rows)]
    score = lambda data: sorted(round(r["score"], 9) for r in backoff.score_texts(spark.createDataFrame(data, "doc_id long, text string"), F.lit(True)).collect())
    assert score(rows) == score(own)


def test_constant_forest_keeps_columns(spark, docs):
    odd = docs.limit(5).withColumn("score", F.lit("x"))
    assert quality.score(odd, boosting.constant(0.5), name="score").filter("score = 0.5").count() == 5
