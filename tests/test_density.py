"""Clusters do not depend on the number of points, on outliers, or on the type of keys."""

from pyspark.sql import functions as F

from recensio.operators.density import NOISE, density_cluster


def planted(spark, per_spot):
    """Four spots whose points lie evenly in a small square."""
    side = int(per_spot**0.5)
    rows = spark.range(4 * per_spot).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"),
        F.floor(F.col("id") / per_spot).alias("spot"),
        (F.col("id") % side / side).alias("x"),
        (F.floor(F.col("id") / side) % side / side).alias("y"),
    )
    return rows.select("id", "spot", F.array(F.col("spot") % 2 * 10 + F.col("x"), F.floor(F.col("spot") / 2) * 10 + F.col("y")).alias("v"))


def spots(rows, found):
    pairs = rows.join(found, "id").groupBy("spot").agg(F.count_distinct("cluster").alias("n"), F.min("cluster").alias("c")).collect()
    return {r["spot"]: (r["n"], r["c"]) for r in pairs}


def test_the_same_clusters_with_a_hundred_times_the_points(spark):
    for per_spot in (64, 6_400):
        rows = planted(spark, per_spot)
        got = spots(rows, density_cluster(rows, "id", "v"))
        assert all(n == 1 for n, _ in got.values()) and len({c for _, c in got.values()}) == 4
        assert NOISE not in {c for _, c in got.values()}


def test_a_far_outlier_changes_nothing(spark):
    rows = planted(spark, 64)
    far = spark.createDataFrame([("far", 9, [1e9, -1e9])], "id string, spot long, v array<double>")
    alone = {r["id"]: r["cluster"] for r in density_cluster(rows, "id", "v").collect()}
    with_far = {r["id"]: r["cluster"] for r in density_cluster(rows.unionByName(far), "id", "v").collect()}
    assert with_far.pop("far") == NOISE
    pairs = {(alone[k], with_far[k]) for k in alone}
    assert len(pairs) == len(set(alone.values())) == len({b for _, b in pairs})


def test_components_broadcast_few_nodes_and_never_edges(spark, monkeypatch):
    from recensio.operators import components

    plans, write = [], components.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return write(df)

    monkeypatch.setattr(components, "materialize", seen)
    edges = spark.range(99).filter("id % 10 < 9").selectExpr("id as a", "id + 1 as b")
    for most, absent in ((1_000, "BuildLeft"), (50, "Broadcast")):
        plans.clear()
        monkeypatch.setattr(components, "DRIVER_NODES", most, raising=False)
        found = components.connected_components(spark.range(100).toDF("node"), edges).collect()
        assert {r["node"]: r["component"] for r in found} == {i: i // 10 * 10 for i in range(100)}
        assert plans and not any(absent in p for p in plans)
