"""The cell tree and what is built on it: neighbours, vector pairs, clusters, reduction."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recensio.operators import cells, density, vectors
from recensio.operators.density import NOISE


def table(spark, x, name="id"):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], f"{name} long, v array<double>")


def plain_neighbours(x, k):
    far = cells.squared(x, x)
    np.fill_diagonal(far, np.inf)
    return {(i, j, n + 1) for i in range(len(x)) for n, j in enumerate(np.lexsort((np.arange(len(x)), far[i]))[:k].tolist())}


@pytest.mark.parametrize("most", [None, 25])
def test_neighbours_are_exact(spark, most):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(250, 3)) * rng.exponential(1, (250, 1))
    got = cells.nearest_neighbours(table(spark, x), 4, most).collect()
    assert {(r["id"], r["other"], r["nth"]) for r in got} == plain_neighbours(x, 4)
    few = cells.nearest_neighbours(table(spark, x[:3]), 4, most).collect()
    assert {(r["id"], r["other"], r["nth"]) for r in few} == plain_neighbours(x[:3], 2)


def test_the_largest_cell_stays_below_the_bound(spark):
    """At ten and a hundred times the vectors, a third of them in one spot."""
    rng = np.random.default_rng(1)
    for n in (300, 3_000, 30_000):
        x = rng.normal(size=(n, 4))
        x[: n // 3] = 0.001 * x[: n // 3] + 5
        homes, _ = cells.grow(table(spark, x), most=100)
        sizes = [r["count"] for r in homes.groupBy("cell").count().collect()]
        assert sum(sizes) == n and max(sizes) <= 100


def test_vector_pairs_through_a_deep_tree(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6))
    x[:150] = x[0] + 0.15 * x[:150]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit.T
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if cosine[i, j] >= 0.95}
    pairs, _, _ = vectors.similar_vectors(table(spark, x), "id", "v", 0.95, most=20)
    got = [(r["id1"], r["id2"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_trees_are_walked_alike(spark, monkeypatch):
    """The driver's walk over a small tree chooses what the tables choose."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (1.5, 0), (9, 9), (9, 0))] + [rng.uniform(-3, 12, (20, 2))])
    df = table(spark, x)
    few = {r["id"]: r["cluster"] for r in density.density_cluster(df, "id", "v").collect()}
    monkeypatch.setattr(density, "TREE_ROWS", 0)
    assert {r["id"]: r["cluster"] for r in density.density_cluster(df, "id", "v").collect()} == few
    assert len(set(few.values()) - {NOISE}) >= 3


def test_reduction_follows_curves(spark):
    """Two half circles through each other's middle part after the reduction; equal directions share a place."""
    from recensio.operators.spectral import reduce_by_neighbours

    turn = np.linspace(0, np.pi, 40)
    one = np.stack([np.cos(turn), np.sin(turn), 0 * turn, 0 * turn], 1)
    two = np.stack([0 * turn, 0 * turn, np.cos(turn), np.sin(turn)], 1)
    x = np.vstack([one, two, 3 * one[:1], np.zeros((1, 4))])
    df = table(spark, x).withColumnRenamed("v", "vector")
    got = {r["id"]: r["reduced"] for r in reduce_by_neighbours(df, "id", dims=2, neighbours=6).collect()}
    assert len(got) == 82 and got[81] is None and got[80] == got[0]
    a, b = np.array([got[i] for i in range(40)]), np.array([got[i] for i in range(40, 80)])
    apart = np.linalg.norm(a.mean(0) - b.mean(0))
    assert apart > 5 * max(np.linalg.norm(a - a.mean(0), axis=1).min(), np.linalg.norm(b - b.mean(0), axis=1).min())
    assert np.sqrt(cells.squared(a, b)).min() > max(np.linalg.norm(np.diff(a, axis=0), axis=1).max(), np.linalg.norm(np.diff(b, axis=0), axis=1).max())
    none = reduce_by_neighbours(df.filter("id > 100"), "id")
    assert none.collect() == []


def test_sent_columns_and_joins_give_the_same_places(spark, monkeypatch):
    """The graph's rows lie still while the columns are sent to them; joins, for more rows, give the same places."""
    from recensio.operators import spectral

    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(c, 0.3, (60, 6)) for c in rng.normal(size=(4, 6))])
    df = table(spark, x).withColumnRenamed("v", "vector")

    def places():
        got = {r["id"]: r["reduced"] for r in spectral.reduce_by_neighbours(df, "id", dims=3, neighbours=5, products=10).collect()}
        return np.array([got[i] for i in range(len(x))])

    sent = places()
    products = []
    monkeypatch.setattr(spectral, "_product", lambda *a, old=spectral._product, **b: (products.append(a), old(*a, **b))[1])
    assert np.allclose(sent, places(), atol=1e-6) and not products
    monkeypatch.setattr(spectral, "STATE_BYTES", 0)
    joined = places()
    assert len(products) == 10
    for j in range(3):  # a direction has no sign
        assert min(np.abs(sent[:, j] - joined[:, j]).max(), np.abs(sent[:, j] + joined[:, j]).max()) < 1e-6


def test_rounding_does_not_choose_the_sign_of_a_direction():
    """Columns that are orthogonal but for rounding keep their signs, whichever way the rounding went."""
    from recensio.operators.spectral import _orthogonal

    gram = np.diag([4.0, 3.0, 2.0, 1.0])
    rng = np.random.default_rng(2)
    for _ in range(20):
        noise = rng.normal(0, 1e-15, (4, 4))
        assert np.allclose(_orthogonal(gram + noise + noise.T), np.diag([0.5, 3**-0.5, 2**-0.5, 1.0]))
