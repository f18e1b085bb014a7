import numpy as np
import pytest
from pyspark.sql import functions as F

from recensio.operators import evaluate, forest, topics as tp
from recensio.operators.density import density_cluster
from recensio.operators.labels import mapping, map_labels
from recensio.operators import labels as labels_module


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    centres = rng.uniform(-5, 5, (3, 3))
    x = np.vstack([c + rng.normal(0, 0.25, (80, 3)) for c in centres] + [rng.uniform(-6, 6, (30, 3))])
    x = np.vstack([x, np.repeat(x[:1], 100, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>"), x


def test_density_finds_planted_clusters(spark, planted):
    df, _ = planted
    got = {r["id"]: r["cluster"] for r in density_cluster(df, "id", "v").collect()}
    assert len(got) == 370
    for k in range(3):
        members = [got[i] for i in range(80 * k, 80 * k + 80)]
        main = max(set(members), key=members.count)
        assert main != -1 and members.count(main) >= 70
    assert len({c for c in got.values() if c != -1}) == 3
    assert sum(got[i] == -1 for i in range(240, 270)) >= 25
    assert {got[i] for i in range(270, 370)} == {got[0]}
    again = {r["id"]: r["cluster"] for r in density_cluster(df.repartition(5), "id", "v").collect()}
    assert again == got


def test_one_blob_is_all_noise(spark):
    df = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(50)], "id long, v array<double>")
    assert density_cluster(df, "id", "v").filter("cluster <> -1").count() == 0


def silhouette(x, y):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        same = y == y[i]
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, y == k].mean() for k in set(y) if k != y[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block", [40, 4096])
def test_silhouette_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4))
    y = rng.integers(-1, 3, 150)
    y[0] = 9
    df = spark.createDataFrame([(i, v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, v array<double>, topic int")
    got = evaluate.silhouette(df, "id", "v", block=block).first()[0]
    assert got == pytest.approx(silhouette(x[y != -1], y[y != -1]), abs=1e-9)


def test_only_noise(spark):
    df = spark.createDataFrame([(1, [0.0], -1), (2, [1.0], -1)], "id long, v array<double>, topic int")
    assert evaluate.silhouette(df, "id", "v").first()[0] == -1.0
    assert evaluate.silhouette_squared(df, "id", "v").first()[0] == -1.0
    topics = spark.createDataFrame([(-1, "a", [1.0])], "topic int, top_words string, vector array<double>")
    labels = spark.createDataFrame([("x", 0, [1.0])], "label string, pos int, vector array<double>")
    assert evaluate.match_taxonomy(topics, labels).count() == 0


def test_match_uses_the_unrounded_score_and_the_first_of_ties(spark):
    c = 0.60003
    topics = spark.createDataFrame([(0, "a b", [1.0, 0.0])], "topic int, top_words string, vector array<double>")
    near = [c, (1 - c * c) ** 0.5]
    labels = spark.createDataFrame([("z", 0, near), ("a", 1, near), ("far", 2, [0.0, 1.0])], "label string, pos int, vector array<double>")
    row = evaluate.match_taxonomy(topics, labels).first()
    assert (row["best_match_label"], row["similarity_score"], row["match_type"]) == ("z", 0.6, "Strong")


def test_number_topics_and_metrics(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([7, 7, 7, 3, 3, -1])], "id long, cluster long")
    got = tp.number_topics(df, "id")
    assert [r["topic"] for r in got.orderBy("id").collect()] == [0, 0, 0, 1, 1, -1]
    row = tp.topic_metrics(got).first()
    assert (row["n_topics"], row["n_docs"], row["n_outliers"]) == (2, 6, 1)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [3.0, 0.0])], "id long, vector array<double>")
    centres = spark.createDataFrame([(0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [9.0, 9.0])], "topic int, vector array<double>")
    got = {r["id"]: r["probs"] for r in tp.topic_probabilities(df, centres, "id").collect()}
    assert sum(got[1]) == pytest.approx(1.0) and np.argmax(got[1]) == 0 and np.argmax(got[2]) == 1


def test_feature_names_fit_the_matrix(spark):
    rows = [(i, "ab"[i % 2], "it", float(i), 1.0 + i % 5, "2024-01-01", "xyz"[i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, labels string, language string, review_length double, rating double, d string, sentiment string")
    df = df.withColumn("review_date", F.to_date("d")).withColumn("punctuation_count", F.lit(0)).withColumn("emoji_count", F.lit(1))
    matrix, names = forest.feature_matrix(df)
    assert matrix.first()["features"].size == len(names)
    ranked = forest.feature_importance(matrix, names, trees=5, depth=5).collect()
    assert len(ranked) == len(names) and sum(r["importance"] for r in ranked) == pytest.approx(1.0)


def test_large_mapping_gives_the_same_labels(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["z"])], "id long, ls array<string>")
    pairs = mapping(spark.createDataFrame([("a", "A", 0), ("a", "AA", 1), ("b", None, 2)], "f string, t string, pos int"), "f", "t")
    small = sorted(map(str, map_labels(df, "id", "ls", pairs, "out").collect()))
    monkeypatch.setattr(labels_module, "MAP_ROWS", 0)
    assert sorted(map(str, map_labels(df, "id", "ls", pairs, "out").collect())) == small
    assert any("['AA', 'b', 'AA']" in row for row in small)


def test_zero_vectors_match_with_score_zero(spark):
    topics = spark.createDataFrame([(0, "a", [0.0, 0.0])], "topic int, top_words string, vector array<double>")
    labels = spark.createDataFrame([("x", 0, [1.0, 0.0])], "label string, pos int, vector array<double>")
    row = evaluate.match_taxonomy(topics, labels).first()
    assert (row["similarity_score"], row["match_type"]) == (0.0, "Weak/New")


def test_labels_of_a_list_have_columns_of_their_own(spark):
    rows = [(1, ["a", "b", "a"], "it", 1.0), (2, ["b"], "en", 2.0), (3, [], "it", 3.0), (4, ["new"], "fr", 4.0)]
    df = spark.createDataFrame(rows, "id long, labels array<string>, language string, rating double")
    df = df.withColumns({"review_date": F.to_date(F.lit("1970-01-02")), "sentiment": F.lit("x")})
    matrix, names = forest.feature_matrix(df, numeric=["rating"], learn_from=F.col("id") < 4)
    listed = [r["feature"] for r in names.table.orderBy("place").collect()]
    assert listed == ["labels_b", "labels_a", "language_it", "language_en", "rating", "review_date"] and len(names) == 6
    got = {r["id"]: r["features"].toArray().tolist() for r in matrix.collect()}
    assert got == {1: [1, 1, 1, 0, 1, 86400], 2: [1, 0, 0, 1, 2, 86400], 3: [0, 0, 1, 0, 3, 86400], 4: [0, 0, 0, 0, 4, 86400]}


def test_blocks_of_the_silhouette_grow_with_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(120, 3)), rng.integers(-1, 4, 120)
    df = spark.createDataFrame([(i, [float(a) for a in v], int(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, v array<double>, topic int")
    written, write = [], evaluate.materialize
    monkeypatch.setattr(evaluate, "materialize", lambda d: written.append(write(d)) or written[-1])
    monkeypatch.setattr(evaluate, "SILHOUETTE_BLOCKS", 4, raising=False)
    monkeypatch.setattr(evaluate, "DISTANCES", 70, raising=False)
    got = evaluate.silhouette(df, "id", "v", block=2).first()[0]
    assert got == pytest.approx(silhouette(x[y != -1], y[y != -1]), abs=1e-9)
    assert [d.count() for d in written if "block" in d.columns] == [4]


def test_forest_keeps_the_nodes_that_rows_have_reached(spark, monkeypatch):
    """A level of the trees reads where each row stands and does not walk down from the root again."""
    from recensio.operators import forest

    rows = [(i, ["a", "b"][i % 2], f"l{i % 3}", float(i), "2024-01-01", ["x", "y"][i % 5 == 0]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, labels string, language string, rating double, d string, sentiment string")
    df = df.withColumn("review_date", F.to_date("d"))
    matrix, names = forest.feature_matrix(df, numeric=["rating"])
    made = []

    class Seen(forest.RandomForestClassifier):
        def fit(self, *args):
            made.append(self)
            return super().fit(*args)

    monkeypatch.setattr(forest, "RandomForestClassifier", Seen)
    found = forest.feature_importance(matrix, names, trees=5, depth=6).collect()
    assert len(found) == len(names) and abs(sum(r["importance"] for r in found) - 1) < 1e-6
    assert [m.getCacheNodeIds() for m in made] == [True]
