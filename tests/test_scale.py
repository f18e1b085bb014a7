import numpy as np
import pytest
from pyspark.sql import functions as F

from recensio.operators import scale
from recensio.operators.blocks import with_blocks
from recensio.operators.components import connected_components


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_beyond_the_broadcast_limit(spark, how):
    # one key holds a third of the rows
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    dim = spark.range(-1, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(map(str, facts.join(dim, "k", how).select("id", "k", "v").collect()))
    for rows in (10, 10**6):
        got = scale.lookup_join(facts, dim, ["k"], how, rows=rows).select("id", "k", "v").collect()
        assert sorted(map(str, got)) == want
    sized = dim.join(facts.groupBy("k").count(), "k", "left")
    got = scale.lookup_join(facts, sized, ["k"], how, rows=10, seen="count").select("id", "k", "v").collect()
    assert sorted(map(str, got)) == want


def test_salted_sides_meet_exactly_once(spark):
    left = spark.range(100).select("id", (F.col("id") % 3 == 0).cast("int").alias("k"))
    a, b, keys = scale.salted(left, left, ["k"], "id", 5)
    assert keys == ["k", "_salt"]
    pairs = a.alias("a").join(b.alias("b"), keys).filter(F.col("a.id") < F.col("b.id"))
    n = sum(c * (c - 1) // 2 for c in (34, 66))
    assert pairs.count() == n == pairs.select("a.id", "b.id").distinct().count()


def test_number_rows(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * F.col("id")).alias("key"))
    got = sorted((r["key"], r["row_index"]) for r in scale.number_rows(df, "key").collect())
    assert [i for _, i in got] == list(range(len(got)))
    assert scale.number_rows(df.limit(0), "key").count() == 0


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=700), np.zeros(350)])
    b = rng.integers(0, 5, 501).astype(float)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None), ("c", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "q10": 1.0}
    got = {r["g"]: r for r in scale.exact_quantiles(df, "g", "v", points).collect()}
    for g, values in (("a", a), ("b", b), ("c", np.array([4.0]))):
        for name, p in points.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_rank_in_group(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).alias("g"))
    got = scale.rank_in_group(df, "g", F.xxhash64("id"), "id", "r").collect()
    for g in (True, False):
        ranks = sorted(r["r"] for r in got if r["g"] is g)
        assert ranks == list(range(1, len(ranks) + 1))
        assert {r["_size"] for r in got if r["g"] is g} == {len(ranks)}


def test_blocks_show_every_item_to_every_row(spark):
    rows, items = spark.range(5), spark.range(11).withColumnRenamed("id", "x")
    met = with_blocks(rows, items, block=3)
    assert met.count() > 5
    seen = met.select("id", F.explode("items.x").alias("x"))
    assert seen.count() == 55 == seen.distinct().count()


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101)]
    nodes = spark.createDataFrame([(n,) for n in [*range(61), 100, 101, 102, 200]], "node long")
    got = connected_components(nodes, spark.createDataFrame(chain, "a long, b long"))
    found = {r["node"]: r["component"] for r in got.collect()}
    assert all(found[i] == 0 for i in range(61))
    assert found[100] == found[101] == found[102] == 100 and found[200] == 200


def test_seldom_terms_come_back_to_their_texts(spark, monkeypatch):
    """A vocabulary that is too large to be broadcast whole: same weights, also for repeated and missing ids."""
    from recensio.operators import rarity, scale, weights

    rows = [(i % 17 if i % 9 else None, " ".join(f"w{j}" for j in range(40) if (i * j) % (j + 2) < 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string")

    def shown():
        found = weights.term_weights(df, "id", "text").collect()
        ratios = rarity.rare_token_ratio(df, "id", "text", quantile=0.5).collect()
        return (
            sorted((r["id"] is None, r["id"] or 0, r["term"], r["df"], r["tf"], round(r["weight"], 9), round(r["before"], 9)) for r in found),
            sorted((r[0] is None, r[0] or 0, r[1] is None, r[1] or 0.0) for r in ratios),
        )

    want, parts = shown(), []

    def few(dim, count):
        frequent, others = scale.frequent_part(dim, count, rows=8)
        parts.append((frequent.count(), others.count()))
        return frequent, others

    for module in (weights, rarity):
        monkeypatch.setattr(module, "fits_broadcast", lambda *a: False)
        monkeypatch.setattr(module, "frequent_part", few)
    assert shown() == want
    assert len(parts) == 2 and all(0 < a <= 8 and b > 0 for a, b in parts)


def test_salting_computes_its_rows_once_to_count_them_and_once_to_deal_them(spark):
    from recensio.operators.scale import salted

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    left = spark.range(100).selectExpr("id", "id % 2 as k").mapInPandas(counted, "id long, k long")
    a, b, keys = salted(left, spark.createDataFrame([(0,), (1,)], "k long"), ["k"], "id", 10)
    assert a.join(b, keys).count() == 100
    assert seen.value == 200
