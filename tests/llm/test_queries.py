"""Each query with SQL against that SQL, and all of them on tables with odd rows or none."""

import duckdb
import pytest
from check import TABLES, normal

from recensio.llm import catalog

SF_DIR = "/root/testdata/sf0.001"

#: Null and empty texts, ties, repeated rows, a missing id, a very long word and a long text.
ODD = [
    (1, None, "en", "a", 3),
    (2, "", None, None, 3),
    (2, "", None, None, 3),
    (3, "Same words here are more than five in all", "en", "a", 1),
    (4, "same words here are more than five in all", "fr", "a", 1),
    (4, "same words here are more than five in all", "fr", "a", 1),
    (None, "same words here are more than five in all", "fr", None, None),
    (None, None, None, None, None),
    (5, "x" * 70_000, "de", "b", 2),
    (6, " ".join(f"w{i % 997}" for i in range(30_000)), "de", "b", 2),
    (7, " \t\n", "de", "b", 2),
    (8, "one two", "xx", "c", 2),
    (9, "一二三 四五 Ünïcode 😀 password: hunter22", "xx", "c", 2),
]
#: Odd vectors: none, of another length, with gaps, alike in all, without label or id.
VECTORS = [(i * 10, [((i * 7 + d * d) % 23 - 11) / 16 for d in range(64)], i % 3) for i in range(30)] + [
    (1, None, 1), (2, [], 1), (3, [0.5] * 63, 1), (4, [None] * 64, 1), (5, [float("nan")] * 64, 2), (100, [0.25] * 64, None), (None, [0.25] * 64, 1),
    (6, [0.25] * 64, 1), (6, [0.25] * 64, 1), (8, [0.25] * 64, 2), (9, [-0.0] * 64, 2),
]
OF_VECTORS = ("op11_centroids", "op12_hard_negatives")
VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(con, sql):
    relation = con.sql(sql)
    return normal(relation.columns, relation.fetchall())


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(ODD, SCHEMA).coalesce(2).write.parquet(f"{top}/documents.parquet")
    items = [(0, None), (1, ""), (2, "hunter22"), (3, "Words HERE are"), (4, " ".join(f"w{i}" for i in range(40))), (4, "one two"), (None, "four five six")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    labels = [(1, 0, 0), (3, 1, 0), (3, 0, 1), (None, 1, 0), (5, None, 0), (99, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame(VECTORS, VECTOR_SCHEMA).write.parquet(f"{top}/embeddings.parquet")
    return str(top)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("none")
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int"), ("embeddings", VECTOR_SCHEMA)):
        spark.createDataFrame([], schema).write.parquet(f"{top}/{name}.parquet")
    return str(top)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF_DIR)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == rows_of(con, catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(OF_VECTORS)))
def test_odd_rows(spark, odd_dir, name):
    df = catalog.QUERIES[name](spark, odd_dir)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(ODD)
    # rows alike in all columns get the same result but for their places in shards and what follows them
    if name not in ("op4_shards", "op5_fingerprints"):
        assert len([r for r in set(got) if r[df.columns.index("doc_id")] == 4]) == 1


@pytest.mark.parametrize("name", OF_VECTORS)
def test_odd_vectors(spark, odd_dir, name):
    """Rows with an id of their own are those of the SQL."""
    con = duckdb.connect()
    kept = "select * from '{}/embeddings.parquet/*.parquet' where vec_id is not null and vec_id not in (6) and (embedding is null or len(embedding) = 64)".format(odd_dir)
    import tempfile

    top = tempfile.mkdtemp()
    con.execute(f"create view embeddings as {kept}")
    con.execute(f"copy embeddings to '{top}/embeddings.parquet'")
    df = catalog.QUERIES[name](spark, top)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == rows_of(con, catalog.ORACLES[name])
    assert catalog.QUERIES[name](spark, odd_dir).count() >= df.count()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert catalog.QUERIES[name](spark, empty_dir).collect() == []


def test_odd_rows_of_sql(spark, odd_dir):
    """Where ids are there and differ, SQL defines the odd cases too."""
    con = duckdb.connect()
    con.execute(f"create view documents as select distinct * from '{odd_dir}/documents.parquet/*.parquet' where doc_id is not null")
    con.execute(f"create view benchmark as select * from '{odd_dir}/benchmark.parquet/*.parquet' where item_id is not null")
    import tempfile

    top = tempfile.mkdtemp()
    con.execute(f"copy documents to '{top}/documents.parquet'")
    con.execute(f"copy benchmark to '{top}/benchmark.parquet'")
    for name in ("op1_lm_scores", "op2_substring_dedup", "op3_decontaminate", "op8_jaccard_join", "op9_mixture"):
        df = catalog.QUERIES[name](spark, top)
        assert normal(df.columns, [tuple(r) for r in df.collect()]) == rows_of(con, catalog.ORACLES[name]), name
