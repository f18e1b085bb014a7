"""Helpers that keep joins, ranks and quantiles safe when keys are skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recensio.session import materialize

#: A side is broadcast only if it stays below both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: A key is hot when it covers more than 1/HOT_SHARE of all rows, so that at
#: most HOT_SHARE keys can be hot, whatever the data.
HOT_SHARE = 1_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against the limits; one row per task is moved for it."""
    measured = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("size"),
    ).first()
    return measured["n"] <= rows and (measured["size"] or 0) <= size


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it fits, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, rows) else df


def frequent_part(dim: DataFrame, count: str, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows of ``dim`` with the greatest ``count`` that can be broadcast, and the others.

    Words follow few frequent ones, so nearly all look-ups end in the first part. One number per different count
    is summed for the cut; rows that share a count stay together.
    """
    width = F.octet_length(F.to_json(F.struct(*dim.columns)))
    sizes = dim.groupBy(count).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size"))
    from_top = Window.orderBy(F.col(count).desc()).rowsBetween(Window.unboundedPreceding, 0)  # a row per different count
    upto = sizes.select(count, F.sum("n").over(from_top).alias("n"), F.sum("size").over(from_top).alias("size"))
    least = upto.filter((F.col("n") <= rows) & (F.col("size") <= size)).agg(F.min(count).alias("least")).first()["least"]
    if least is None:
        return dim.filter(F.lit(False)), dim
    return dim.filter(F.col(count) >= least), dim.filter(F.col(count) < least)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows: int = BROADCAST_ROWS,
    seen: str | None = None,
) -> DataFrame:
    """Join ``facts`` to ``dim``, which holds each key once.

    Small ``dim``: broadcast. Otherwise the keys that cover more than
    1/HOT_SHARE of the facts, whether ``dim`` has them or not, are set apart
    through a broadcast of at most HOT_SHARE keys; rows with a null key, which
    match nothing, are set apart too, and only the evenly spread rest is shuffled.
    ``seen`` names a column of ``dim`` that already holds the fact rows per key.
    """
    on = list(on)
    if fits_broadcast(dim, rows):
        return facts.join(F.broadcast(dim), on, how)
    if seen:
        total = dim.agg(F.sum(seen).alias("n")).first()["n"]
        hot_keys = dim.filter(F.col(seen) * HOT_SHARE > F.lit(total)).select(*on)
    else:
        per_key = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        total = facts.count()
        hot_keys = per_key.filter(F.col("_n") * HOT_SHARE > F.lit(total)).select(*on)
    hot_keys = materialize(hot_keys)
    hot = materialize(dim.join(F.broadcast(hot_keys), on, "left_semi"))
    probed = facts.join(F.broadcast(hot_keys.withColumn("_hot", F.lit(True))), on, "left")
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    apart = probed.filter(F.col("_hot") | ~known).select(*facts.columns)
    rest = probed.filter(F.col("_hot").isNull() & known).select(*facts.columns)
    found = apart.join(hinted(hot, HOT_SHARE), on, how)
    return found.unionByName(rest.join(dim, on, how).select(*found.columns))


def salted(
    left: DataFrame, right: DataFrame, keys: Sequence[str], by: str, most: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Split the work of keys with more than ``most`` left rows over several tasks.

    Left rows of such a key get one of ceil(rows / most) salts, right rows get
    all of them, so each pair of rows still meets exactly once. Returns both
    sides and the columns to join on.
    """
    keys = list(keys)
    sizes = (
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > most)
        .withColumn("_salts", F.ceil(F.col("_size") / F.lit(most)).cast("int"))
    )
    sizes = materialize(sizes)  # read several times; without it the left side is computed each time
    if sizes.isEmpty():
        return left, right, keys
    salts = F.coalesce("_salts", F.lit(1))
    one = F.pmod(F.xxhash64(by), salts).cast("int")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    left = lookup_join(left, sizes, keys, seen="_size").withColumn("_salt", one)
    right = lookup_join(right, sizes, keys, seen="_size").withColumn("_salt", every)
    return left.drop("_size", "_salts"), right.drop("_size", "_salts"), [*keys, "_salt"]


def number_rows(df: DataFrame, key: str, name: str = "row_index", start: int = 0) -> DataFrame:
    """Consecutive numbers in the order of the unique numeric ``key``.

    Keys are cut into ranges first; each range is ranked on its own and shifted
    by the number of rows in the ranges before it, so no task sees all rows.
    """
    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    points = [i / parts for i in range(1, parts)]
    cuts = sorted(
        set(df.agg(F.percentile_approx(key, points, 10 * parts).alias("c")).first()["c"] or [0])
    )
    splits = [float("-inf"), *[float(c) for c in cuts], float("inf")]
    ranged = (
        Bucketizer(splits=splits, inputCol="_key", outputCol="_range")
        .transform(df.withColumn("_key", F.col(key).cast("double")))
        .drop("_key")
    )
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(key)
    return (
        ranged.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_rank") - 1 + F.col("_offset") + F.lit(start))
        .drop("_range", "_rank", "_offset")
    )


def number_in_order(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers in any order, without one task that sees all rows.

    Rows are dealt into ranges of the order and written; each range is ranked
    alone and shifted by the rows in the ranges before it.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))  # one row a range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_rank") - 1 + F.col("_offset") + F.lit(start))
        .drop("_range", "_rank", "_offset")
    )


def exact_quantiles(
    df: DataFrame, group: str, value: str, points: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Interpolated quantiles per ``group``, without one task holding a group.

    Values are counted first, reading the input once. Approximate cut points split each group's distinct
    values into ranges; running counts inside a range plus the counts of the
    ranges before it give every value its exact position.
    ``weight`` names a column of repeat counts.
    """
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = materialize(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"))
        .agg(size.cast("long").alias("_n"))
    )
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = counts.groupBy("_g").agg(
        F.percentile_approx("_v", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("_cuts")
    )
    ranged = counts.join(hinted(cuts), "_g").select(
        "_g", "_v", "_n", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_r")
    )
    upto = Window.partitionBy("_g").orderBy("_r")
    offsets = materialize(
        ranged.groupBy("_g", "_r")
        .agg(F.sum("_n").alias("_size"))
        .select(
            "_g",
            "_r",
            (F.sum("_size").over(upto) - F.col("_size")).alias("_offset"),
            F.sum("_size").over(Window.partitionBy("_g")).alias("_total"),
        )
    )
    inside = Window.partitionBy("_g", "_r").orderBy("_v")
    placed = (
        ranged.withColumn("_upto", F.sum("_n").over(inside))
        .join(hinted(offsets), ["_g", "_r"])
        .withColumn("_end", F.col("_offset") + F.col("_upto"))
        .withColumn("_begin", F.col("_end") - F.col("_n"))
    )

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("_begin") <= position) & (position < F.col("_end")), F.col("_v")))

    quantiles = []
    for name, p in points.items():
        exact = (F.col("_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(exact)), at(F.ceil(exact))
        # low + (high - low) * part gives the value itself between equal neighbours
        quantiles.append((low + (high - low) * F.max(exact - F.floor(exact))).alias(name))
    return placed.groupBy(F.col("_g").alias(group)).agg(*quantiles)


def rank_in_group(df: DataFrame, group: str, order: Column, tie: str, name: str) -> DataFrame:
    """1-based rank by ``order`` (a hash) inside ``group``; groups may be huge.

    The hash space is cut into equal slices, which are even because hashes are;
    ``_size`` is the size of the group.
    """
    slices = 4 * max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sliced = df.withColumn("_h", order).withColumn(
        "_s", F.floor((F.shiftright(F.col("_h"), 32) + F.lit(2**31)) * F.lit(slices) / F.lit(2.0**32))
    )
    upto = Window.partitionBy(group).orderBy("_s")
    offsets = (
        sliced.groupBy(group, "_s")
        .agg(F.count(F.lit(1)).alias("_in"))
        .select(
            group,
            "_s",
            (F.sum("_in").over(upto) - F.col("_in")).alias("_offset"),
            F.sum("_in").over(Window.partitionBy(group)).alias("_size"),
        )
    )
    inside = Window.partitionBy(group, "_s").orderBy("_h", tie)
    return (
        sliced.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [group, "_s"])
        .withColumn(name, F.col("_rank") + F.col("_offset"))
        .drop("_h", "_s", "_rank", "_offset")
    )
