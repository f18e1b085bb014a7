import pytest
from pyspark.sql import functions as F

from recensio.operators import sentiment as st, translate as tr
from recensio.operators.language import detect_language, train_language_model
from recensio.operators.labels import parse_labels
from recensio.sources import readers, writers


def test_load_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.load_table(spark, str(tmp_path / "none.parquet"))
    with pytest.raises(ValueError):
        readers.load_table(spark, "x.xlsx")
    empty = readers.load_table(spark, "x.xlsx", on_error="empty")
    assert empty.count() == 0 and empty.schema == readers.REVIEW_SCHEMA


def test_cache_is_built_once(spark, tmp_path):
    path, built = str(tmp_path / "cache"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert writers.cached(spark, path, build).count() == 3
    assert writers.cached(spark, path, build).count() == 3
    assert len(built) == 1
    writers.cached(spark, path, build, use_cache=False)
    assert len(built) == 2


def test_metrics_append(spark, tmp_path):
    df = spark.createDataFrame([(2, 0.5)], "n_topics int, silhouette double")
    for run in ("a", "b"):
        writers.log_metrics(df, run, str(tmp_path / "m"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "m")).collect())
    assert got == [("a", "n_topics", 2.0), ("a", "silhouette", 0.5), ("b", "n_topics", 2.0), ("b", "silhouette", 0.5)]


@pytest.mark.parametrize("text, labels", [("['a','b']", ["a", "b"]), ("[a", []), (None, []), ("[]", []), ("['a'", [])])
def test_parse_labels(one, text, labels):
    assert one(parse_labels, text) == labels


@pytest.mark.parametrize(
    "votes, sentiment, result",
    [
        (("negative", "positive", "negative"), "neutral", "negative"),
        (("positive", "negative", "positive"), "neutral", "positive"),
        (("negative", "neutral", "positive"), "neutral", "negative"),
        (("positive", "?", None), "neutral", "positive"),
        (("negative", "negative", "negative"), "positive", "positive"),
    ],
)
def test_ensemble(spark, votes, sentiment, result):
    df = spark.createDataFrame([(*votes, sentiment)], "v1 string, v2 string, v3 string, sentiment string")
    assert st.ensemble_sentiment(df).first()["sentiment"] == result


ROWS = [(1, "ciao", "it"), (2, "hello", "en"), (3, "bad", "en"), (4, "hola", "es"), (5, "x", None), (6, "?", "unknown")]


@pytest.mark.parametrize("on_error, failed", [("original", "bad"), ("marker", "TRANSLATION_ERROR_en")])
def test_translate_both_ways(spark, on_error, failed):
    df = spark.createDataFrame(ROWS, "id long, review string, detected_lang string")
    table = spark.createDataFrame([("en", "hello", "ciao!"), ("es", "hola", "ehi")], "lang string, source_text string, target_text string")

    def make(code):
        def run(texts):
            return [{"hello": "ciao!", "hola": "ehi"}[t] for t in texts]

        return run

    want = {1: "ciao", 2: "ciao!", 3: failed, 4: "ehi", 5: "x", 6: "?"}
    for out in (tr.translate(df, table, on_error=on_error), tr.translate_with(df, make, on_error=on_error)):
        assert {r["id"]: r["final_text"] for r in out.collect()} == want


def test_language_model(spark):
    rows = [("the cat and the dog went there", "en"), ("il gatto e il cane della casa", "it"), ("perché non funziona più", "it")]
    model = train_language_model(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    df = spark.createDataFrame([(1, "the dog"), (2, "il cane non"), (3, "123 !!"), (4, None), (5, "")], "id long, t string")
    got = {r["id"]: r["detected_lang"] for r in detect_language(df, "id", "t", model).collect()}
    assert got == {1: "en", 2: "it", 3: None, 4: None, 5: None}


def test_scores_and_top_label(spark):
    df = spark.range(1).select(F.array(F.lit(0.2), F.lit(0.5), F.lit(0.5)).alias("s"))
    labels = ["negative", "neutral", "positive"]
    row = df.select(
        st.argmax_label(F.col("s"), labels).alias("a"), st.top_label(st.label_scores(F.col("s"), labels)).alias("b")
    ).first()
    assert row["a"] == "neutral" and row["b"] == "neutral"


def test_language_and_rare_words_without_broadcast(spark, monkeypatch):
    from recensio.operators import rarity, scale

    rows = [(i, f"the cat number {i % 7} and the dog", "en") for i in range(40)] + [(99, "il gatto e il cane", "it")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = train_language_model(df, "text", "lang")

    def shown():
        codes = detect_language(df, "id", "text", model).select("id", "detected_lang").collect()
        ratios = rarity.rare_token_ratio(df, "id", "text").collect()
        return sorted(map(str, codes)), sorted(map(str, ratios))

    want = shown()
    monkeypatch.setattr(scale, "fits_broadcast", lambda *a: False)
    assert shown() == want


def test_release_deletes_what_was_written(spark):
    from pathlib import Path

    from recensio.session import materialize, release

    kept = materialize(spark.range(10))
    folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists() and release(spark) >= 1 and not folder.exists()


CSV = 'id,t,x\n1,"a\n\nb, ""q""",2\n2,plain,3\nbad\n3,"z\r\nw",oops\n\n4,e,5,6\n5,"long\nlong\nlong\nlong\nlong\nlong\nlong\nlong",7\n6,"",8\n7,last,9'


@pytest.mark.parametrize("size", [4, 16, 40, 1 << 20])
def test_quoted_csv_is_split_as_it_is_read_whole(spark, tmp_path, size):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text(CSV, newline="")
    (tmp_path / "b.csv").write_text(CSV.replace("plain", '"x,""y"""'), newline="")
    (tmp_path / "c.csv").write_text("id,t,x\n")
    (tmp_path / "d.csv").write_text("")
    schema = T.StructType.fromDDL("id long, t string, x int")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = {
            how: sorted(map(str, readers.load_table(spark, str(tmp_path), schema, "csv", multi_line=how, rejected="bad").collect()))
            for how in (True, "split")
        }
        (tmp_path / "w").mkdir()
        (tmp_path / "w" / "a.csv").write_text('id,t,x\r\n1,"a\r\nb",2\r\n\r\n2,c,3\r\n', newline="")
        other = readers.load_table(spark, str(tmp_path / "w"), schema, "csv", multi_line="split")
        assert sorted(map(tuple, other.collect())) == [(1, "a\r\nb", 2), (2, "c", 3)]
        whole = readers.load_table(spark, str(tmp_path), schema, "csv", multi_line="split", malformed="drop")
        assert sorted(r["id"] for r in whole.collect()) == [1, 1, 2, 2, 5, 5, 6, 6, 7, 7]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got["split"] == got[True] and len(got["split"]) == 16


def test_open_quote_and_foreign_escape(spark, tmp_path):
    from recensio.sources.records import quoted_records

    (tmp_path / "a.csv").write_text('h\n"never\n' + "closed line\n" * 50)
    with pytest.raises(ValueError):
        readers.load_table(spark, str(tmp_path), format="csv", multi_line="split", escape="\\")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32")
    try:
        assert quoted_records(spark, str(tmp_path)).count() == 1
        with pytest.raises(Exception, match="not closed"):
            quoted_records(spark, str(tmp_path), longest=100).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rejected_rows_are_counted(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id long, t string, x int, _record string")
    (tmp_path / "a.csv").write_text("id,t,x,_record\n1,a,2,r\nbad\n3,c,no,r\n")
    (tmp_path / "a.json").write_text('{"id":1,"t":"a","x":2}\n{"id":\n')
    for name, read, rejected in (("a.csv", 3, ["3,c,no,r", "bad"]), ("a.json", 2, ['{"id":'])):
        metrics = str(tmp_path / f"m-{name}")
        kept, bad = readers.checked_table(spark, str(tmp_path / name), "run", metrics, schema)
        assert kept.schema == schema and kept.count() == 1
        assert sorted(r["record"] for r in bad.collect()) == rejected
        logged = {r["metric"]: r["value"] for r in spark.read.parquet(metrics).collect()}
        assert logged == {"rows_read": read, "rows_rejected": len(rejected)}
    with pytest.raises(ValueError):
        readers.load_table(spark, str(tmp_path / "a.csv"), schema, rejected="_RECORD")
    spark.range(2).write.parquet(str(tmp_path / "p"))
    kept, bad = readers.checked_table(
        spark, str(tmp_path / "p"), "run", str(tmp_path / "mp"), T.StructType.fromDDL("id long"), format="parquet"
    )
    assert (kept.count(), bad.count()) == (2, 0)


def test_flow_from_files_begins_at_the_load(spark, tmp_path):
    from recensio.plans import flows

    (tmp_path / "r.csv").write_text(
        'review_id,review,rating,sentiment,labels,review_date\n1,"bad\nlogin",1,negative,"[\'a\']",2024-01-02\ncut\n2,ok,5,positive,[],2024-01-03\n'
    )
    (tmp_path / "t.csv").write_text("old_label_name,label,parent_label\nx,y,z\n")
    seen = {}

    def flow(df, model, translations, taxonomy, folder, run_name, **options):
        seen.update(rows=sorted(r["review"] for r in df.collect()), labels=taxonomy.first()["label"], options=options)
        return {"rows": df}

    folder = str(tmp_path / "out")
    paths = (str(tmp_path / "r.csv"), str(tmp_path / "t.csv"))
    out = flows.flow_from_files(spark, *paths, flow, None, None, folder, load={"multi_line": "split"}, home="it")
    assert out["rows"].count() == 2 and seen == {"rows": ["bad\nlogin", "ok"], "labels": "y", "options": {"home": "it"}}
    assert [r["record"] for r in spark.read.parquet(f"{folder}/rejected").collect()] == ["cut"]
    logged = {r["metric"]: r["value"] for r in spark.read.parquet(f"{folder}/metrics").collect()}
    assert logged == {"rows_read": 3, "rows_rejected": 1}
    with pytest.raises(ValueError):
        flows.flow_from_files(spark, str(tmp_path / "none.csv"), paths[1], flow, None, None, folder)


def test_topic_report_as_csv(spark, tmp_path):
    from recensio.plans import flows

    info = spark.createDataFrame([(0, 2, "0_a_b"), (-1, 1, '-1_"x",y')], "topic int, count long, name string")
    out = {
        "rows": spark.createDataFrame([(1, 0), (2, 0), (3, -1)], "review_id long, topic int"),
        "doc_topics": spark.createDataFrame([(1, 0)], "review_id long, topic int"),
        "topic_words": spark.createDataFrame([(0, "a", 0.5)], "topic int, word string, weight double"),
        "topic_info": info,
        "topic_vectors": spark.createDataFrame([(0, [0.1])], "topic int, vector array<double>"),
        "metrics": spark.createDataFrame([(1, 3)], "n_topics int, n_docs int"),
        "silhouette": spark.createDataFrame([(0.5,)], "silhouette double"),
    }
    flows.write_topics(out, str(tmp_path), "run", "csv")
    report = spark.read.schema(info.schema).csv(f"{tmp_path}/topics", header=True, escape='"')
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, info.collect()))


def test_lines_of_quoted_csv_stay_in_their_task(spark, tmp_path):
    """Only what is cut by a split moves: far fewer pieces than lines."""
    from recensio.sources import records

    text = "".join(f'{i},"' + "word\n" * 50 + '"\n' for i in range(400))
    (tmp_path / "a.csv").write_text("id,text\n" + text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = records.quoted_records(spark, str(tmp_path))
        assert sorted(r["record"] for r in found.collect()) == sorted(f'{i},"' + "word\n" * 50 + '"' for i in range(400))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_translator_gets_runs_of_bounded_bytes(spark, monkeypatch):
    monkeypatch.setattr(tr, "BATCH_BYTES", 40, raising=False)
    rows = [(i, "abcdefghij"[: i % 11] if i % 5 else None, "en") for i in range(50)] + [(50, "x" * 100, "en"), (51, "ciao", "it")]
    df = spark.createDataFrame(rows, "id long, review string, detected_lang string").coalesce(1)

    def make(code):
        return lambda texts: [f"{sum(len(t or '') for t in texts)}" for _ in texts]

    out = {r["id"]: r["final_text"] for r in tr.translate_with(df, make).collect()}
    assert len(out) == 52 and out[51] == "ciao"
    assert out.pop(50) == "100" and max(int(v) for k, v in out.items() if k < 50) <= 40


def test_the_translation_table_moves_no_targets(spark, tmp_path):
    from recensio.catalog import language

    rows = [("fr", "abcd"), ("fr", "abcd"), (None, "abcd"), ("de", "abc"), ("de", None), (None, "ab"), ("de", "")]
    df = spark.createDataFrame(rows, "lang string, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = language.translations(spark, str(tmp_path))
    wanted = spark.sql(language.TABLE_SQL.replace("from documents", "from {d}"), d=df)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and found.columns == wanted.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("], [")[0] for line in plan.split("\n") if "Aggregate" in line]
    assert keys and not any("target_text" in k or "concat" in k for k in keys)


def test_trigrams_are_counted_where_texts_lie(spark, monkeypatch):
    """Counts, gains and languages are those of the column function, also without a broadcast table, dense sums or few letters."""
    import math

    from pyspark.sql import functions as F

    from recensio.operators import language

    texts = ["Perché no? è così", "the cat 𝒜𝒷𝒸 sat", "", None, "!!! 12", "a", "日本語のテキスト", "Ünïcode ſtraße İ", "".join(chr(0x4E00 + i * i % 900) for i in range(400))]
    rows = [(i % 30 if i % 8 else None, t, None if i % 11 == 3 else f"l{i % 9}") for i, t in enumerate(texts * 7)]
    df = spark.createDataFrame(rows, "id long, t string, l string")
    pieces = df.filter("l is not null").select("l", F.explode(language.trigrams(F.col("t"))).alias("g"))
    want = {(r["g"], r["l"]): r["count"] for r in pieces.groupBy("g", "l").count().collect()}

    def shown():
        model = language.train_language_model(df, "t", "l")
        counts = {(r["trigram"], g["code"]): round(math.exp(g["gain"]) - 1) for r in model.table.collect() for g in r["gains"] if g["code"]}
        assert counts == want
        return sorted(map(str, language.detect_language(df, "id", "t", model).collect()))

    moved = []
    monkeypatch.setattr(language, "lookup_join", lambda *a, old=language.lookup_join: (moved.append(a), old(*a))[1])
    found = shown()
    assert not moved  # trigrams stay with their texts
    monkeypatch.setattr(language, "DENSE", 0)
    monkeypatch.setattr(language, "SLICE", 50)
    assert shown() == found
    monkeypatch.setattr(language, "fits_broadcast", lambda *a: False)
    assert shown() == found and moved
