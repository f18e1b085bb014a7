"""Dense vectors: unit length, exact cosine join."""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.functions.features import let
from recensio.operators.cells import grow, visits
from recensio.operators.scale import lookup_join
from recensio.session import materialize, ship

#: Vectors of a block, and how many of them are multiplied with another block at once.
BLOCK_ROWS = 50_000
ROWS = 256


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def unit(vector: Column) -> Column:
    """Vector over its norm; a zero vector gives null."""
    return let(
        as_double(vector),
        lambda v: let(F.sqrt(dot(v, v)), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n))),
    )


def cosine(a: Column, b: Column) -> Column:
    """Null if either vector is zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0))


def pivot_cells(units: DataFrame, reach: float, most: int | None = None) -> DataFrame:
    """``(id, home, cell)``: every vector in its own cell of a tree, and in each cell it can reach.

    Cells with more than ``most`` vectors at home are split again (see ``cells``), so
    the largest stays bounded however many vectors there are.
    """
    homes, tree = grow(units.select("id", "v"), most)
    asking = homes.select("id", "v", F.lit(reach).alias("reach"), F.col("cell").alias("home"))
    return visits(asking, tree).select("id", "home", "cell")


def block_pairs(rows: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of every two blocks ``i <= j`` into which ``rows(id, ...)`` are cut, with ``block``; a row takes part ``blocks + 1`` times."""
    met = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    left = met.filter("block <= other").withColumns({"i": F.col("block"), "j": F.col("other")}).drop("other")
    right = met.filter("other <= block").withColumns({"i": F.col("other"), "j": F.col("block")}).drop("other")
    return left, right.select(*[F.col(c).alias(f"_{c}") for c in right.columns]).toDF(*right.columns)  # the same table


def ordered_pairs(ids1: pa.Array, ids2: pa.Array, once: bool) -> pa.Table:
    """``(id1, id2)`` with the smaller id first; with ``once`` only pairs that come in this order."""
    first = pc.less(ids1, ids2)
    pairs = pa.table({"id1": pc.if_else(first, ids1, ids2), "id2": pc.if_else(first, ids2, ids1)})
    return pairs.filter(first) if once else pairs


def _near(units: DataFrame, least: float, blocks: int) -> DataFrame:
    """``(id1, id2)`` of unit vectors ``(id, v)`` with a product of at least ``least``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = (left if left.num_rows else right)["id"].type
        if not (left.num_rows and right.num_rows):
            return pa.table({"id1": pa.array([], kind), "id2": pa.array([], kind)})
        held = [t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) for t in (left, right)]
        rows, others = [], []
        for start in range(0, left.num_rows, ROWS):
            a, b = np.nonzero(held[0][start : start + ROWS] @ held[1].T >= least)
            rows.append(start + a)
            others.append(b)
        ids1, ids2 = left["id"].combine_chunks(), right["id"].combine_chunks()
        once = left["block"][0].as_py() == right["block"][0].as_py()
        return ordered_pairs(ids1.take(pa.array(np.concatenate(rows))), ids2.take(pa.array(np.concatenate(others))), once)

    ship(units.sparkSession)
    left, right = block_pairs(units.select("id", F.col("v").cast("array<float>").alias("v")), blocks)
    kind = dict(units.dtypes)["id"]
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(run, f"id1 {kind}, id2 {kind}")


def similar_vectors(
    df: DataFrame,
    key: str,
    vector: str,
    threshold: float,
    inclusive: bool = True,
    most: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact pairs with cosine >= threshold, and the groups of equal vectors.

    Returns ``(pairs, groups, members)``: ``(id1, id2, similarity)`` between the
    first rows of equal vectors, ``(first_id, copies)``, and ``(id, first_id)`` of
    every row, from which all pairs of rows can be rebuilt.

    Vectors are cut into blocks of at most ``most`` rows or so, and every two blocks meet once in one task, which multiplies
    them a few rows at a time in single precision; what may reach the threshold is computed again in
    double precision. The work grows with the square of the rows, what moves with the rows times the blocks.
    """
    units = df.select(F.col(key).alias("id"), unit(F.col(vector)).alias("v")).filter(F.col("v").isNotNull())
    units = materialize(units.withColumn("same", F.xxhash64("v")))
    groups = materialize(
        units.groupBy("same", "v").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    )
    members = lookup_join(units, groups.select("same", "v", "first_id", "copies"), ["same", "v"], "inner", seen="copies").select("id", "first_id")
    found = groups.select("first_id", "copies")
    firsts = groups.select(F.col("first_id").alias("id"), "v")
    measured = firsts.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    if not measured["n"]:
        empty = df.sparkSession.createDataFrame([], "id1 long, id2 long, similarity double")
        return empty, found, members
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = max(ceil(measured["n"] / (most or BLOCK_ROWS)), min(ceil(sqrt(4 * cores)), ceil(measured["n"] / ROWS)))
    candidates = _near(firsts, threshold - 1e-5 - 1.2e-7 * measured["dims"], blocks)
    scored = (
        candidates.join(firsts.select(F.col("id").alias("id1"), F.col("v").alias("v1")), "id1")
        .join(firsts.select(F.col("id").alias("id2"), F.col("v").alias("v2")), "id2")
        .select("id1", "id2", dot(F.col("v1"), F.col("v2")).alias("similarity"))
    )
    close = F.col("similarity") >= threshold if inclusive else F.col("similarity") > threshold
    return scored.filter(close), found, members
