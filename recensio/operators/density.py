"""Density clusters over a ladder of grid resolutions.

Each level halves the cell width. Cells with enough points that touch form the
components of a level; a finer component lies inside one coarser component, so
the levels form a tree. The clusters are those nodes of the tree that keep the
greatest mass over density (excess of mass, Campello et al. 2013), the first
undivided component excluded. Points in no chosen cluster are noise (-1).

All the work is on cells and tree nodes: copies and dense spots collapse into
one cell before anything is joined.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.operators.cells import nearest_neighbours
from recensio.operators.components import by_nodes, connected_components
from recensio.operators.scale import lookup_join
from recensio.session import materialize

NOISE = -1
#: Cells are not made narrower than the width over two to this power.
MOST_LEVELS = 16
#: Parts are preferred if they outweigh the whole by this factor; what falls apart at
#: the last resolution only, where cells hold about ``min_samples`` points, does not.
TOGETHER = 1.25
#: Nodes of a tree that the driver walks by itself; a larger one is walked level by level as tables.
TREE_ROWS = 100_000
#: Members' core distances are at most so many times the upper quartile of the cluster's.
STRETCH = 3.0
#: Positions that are compared directly when neighbours are looked for.
MOST_TOGETHER = 2_000


def _frame(points: DataFrame, dims: int) -> tuple[list[float], float]:
    """Middle of each dimension and the widest spread of the inner 98 % of all points.

    Points outside lie in cells further out, so a far outlier changes no cell.
    """
    cuts = points.agg(
        *[F.percentile_approx(F.col("v")[i], [0.01, 0.5, 0.99], 100_000).alias(f"q{i}") for i in range(dims)]
    ).first()
    width = max(cuts[f"q{i}"][2] - cuts[f"q{i}"][0] for i in range(dims)) or 1.0
    return [cuts[f"q{i}"][1] - width / 2 for i in range(dims)], width


def _cell(lows: list[float], width: float, level) -> Column:
    place = [F.floor((F.col("v")[i] - F.lit(low)) / F.lit(width) * F.pow(F.lit(2.0), level)) for i, low in enumerate(lows)]
    return F.array(*[p.cast("long") for p in place])


def _cells(positions: DataFrame, lows: list[float], width: float) -> DataFrame:
    """``(level, cell, n, places)``: rows and positions of every cell at every level.

    Counted at the finest level; the cell above has its numbers halved.
    """
    finest = positions.groupBy(_cell(lows, width, F.lit(MOST_LEVELS)).alias("cell")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places"))
    at = finest.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(MOST_LEVELS))))
    up = F.transform("cell", lambda c: F.floor(c / F.pow(F.lit(2.0), F.lit(MOST_LEVELS) - F.col("level"))).cast("long"))
    return at.groupBy("level", up.alias("cell")).agg(F.sum("n").alias("n"), F.sum("places").alias("places"))


def _levels(cells: DataFrame, min_samples: int) -> int:
    """Levels until dense cells hold one position each, and two more, so that they come apart."""
    last = cells.filter((F.col("n") >= min_samples) & (F.col("places") > 1)).agg(F.max("level").alias("last")).first()["last"]
    return min(MOST_LEVELS, (last or 1) + 2)


def _tree(dense: DataFrame, dims: int, levels: int) -> DataFrame:
    """``(level, cell, n, component)`` of the dense cells."""
    ahead = [step for step in product((-1, 0, 1), repeat=dims) if step > (0,) * dims]
    steps = F.array(*[F.array(*[F.lit(s) for s in step]) for step in ahead])
    moved = dense.select("level", "cell", F.col("node").alias("a"), F.explode(steps).alias("step")).select(
        "level", "a", F.zip_with("cell", "step", lambda c, s: c + s).alias("cell")
    )
    size = dense.count()
    edges = moved.join(by_nodes(dense.select("level", "cell", F.col("node").alias("b")), size), ["level", "cell"])
    parts = connected_components(dense.select("node"), edges.select("a", "b"))
    return materialize(dense.join(by_nodes(parts, size), "node").select("level", "cell", "n", "component"))


def _choose_few(nodes: list[tuple], levels: int) -> list[int]:
    """What ``_choose`` does below, for a tree of few ``(level, component, size, parent)``."""
    at: dict[int, list[tuple]] = {level: [] for level in range(1, levels + 1)}
    for level, component, size, parent in nodes:
        at[level].append((component, size * 2.0**level, parent))
    root, whole = set(), None
    for level in range(1, levels + 1):
        here = [c for c, _, parent in at[level] if whole is None or parent == whole]
        if len(here) != 1:
            break
        whole = here[0]
        root.add(whole)
    inside: dict[int, list[tuple[float, float]]] = {}
    kept = set()
    for level in range(levels, 0, -1):
        for component, mass, parent in at[level]:
            parts = inside.get(component, [])
            own = mass + (parts[0][1] if len(parts) == 1 else 0.0)
            below = sum(best for best, _ in parts)
            keep = component not in root and own * TOGETHER >= below
            if keep:
                kept.add(component)
            inside.setdefault(parent, []).append((own if keep else below, own))
    chosen, hidden = [], set()
    for level in range(1, levels + 1):
        for component, _, parent in at[level]:
            if parent in hidden:
                hidden.add(component)
            elif component in kept:
                chosen.append(component)
                hidden.add(component)
    return chosen


def _choose(cells: DataFrame, levels: int, min_size: int) -> DataFrame:
    """``(component)`` of the chosen tree nodes; a component belongs to one level."""
    sizes = (
        cells.groupBy("level", "component").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_size)
    )
    above = cells.select(
        (F.col("level") + 1).alias("level"), "cell", F.col("component").alias("parent")
    )
    up = cells.select(
        "level", "component", F.transform("cell", lambda c: F.floor(c / 2).cast("long")).alias("cell")
    )
    parents = up.join(above, ["level", "cell"], "left").groupBy("level", "component").agg(F.min("parent").alias("parent"))
    nodes = materialize(sizes.join(parents, ["level", "component"], "left"))
    few = nodes.limit(TREE_ROWS + 1).collect()
    if len(few) <= TREE_ROWS:
        picked = _choose_few([tuple(r) for r in few], levels)
        return nodes.sparkSession.createDataFrame([(c,) for c in picked], "component long")
    # A chain of single nodes from the top is the undivided whole.
    root, whole = [], None
    for level in range(1, levels + 1):
        here = nodes.filter(F.col("level") == level)
        if whole is not None:
            here = here.filter(F.col("parent") == whole)
        found = here.select("component").limit(2).collect()
        if len(found) != 1:
            break
        whole = found[0]["component"]
        root.append(whole)
    in_root = F.col("component").isin(root) if root else F.lit(False)
    # From the finest level upwards: keep a node if it outweighs its best parts.
    scored, below = [], None
    for level in range(levels, 0, -1):
        here = nodes.filter(F.col("level") == level).withColumn("mass", F.col("size") * F.lit(float(2**level)))
        if below is None:
            here = here.withColumns({"parts": F.lit(0.0), "own": F.col("mass")})
        else:
            children = below.groupBy(F.col("parent").alias("component")).agg(
                F.sum("best").alias("parts"),
                F.count(F.lit(1)).alias("children"),
                F.max("own").alias("child_own"),
            )
            carried = F.when(F.col("children") == 1, F.col("child_own")).otherwise(F.lit(0.0))
            here = here.join(children, "component", "left").withColumns(
                {"own": F.col("mass") + F.coalesce(carried, F.lit(0.0)), "parts": F.coalesce("parts", F.lit(0.0))}
            )
        keep = (F.col("own") * F.lit(TOGETHER) >= F.col("parts")) & ~in_root
        below = materialize(
            here.withColumn("keep", keep)
            .withColumn("best", F.when(F.col("keep"), F.col("own")).otherwise(F.col("parts")))
            .select("level", "component", "parent", "own", "best", "keep")
        )
        scored.append(below)
    # From the top downwards: a kept node hides everything inside it.
    chosen, hidden = [], None
    for here in reversed(scored):
        if hidden is not None:
            here = here.join(hidden.withColumnRenamed("component", "parent"), "parent", "left").withColumn(
                "hid", F.coalesce("hid", F.lit(False))
            )
        else:
            here = here.withColumn("hid", F.lit(False))
        here = here.select("component", "keep", "hid")
        chosen.append(here.filter("keep and not hid").select("component"))
        hidden = here.select("component", (F.col("keep") | F.col("hid")).alias("hid"))
    out = chosen[0]
    for part in chosen[1:]:
        out = out.union(part)
    return out


def _core_distances(positions: DataFrame, min_samples: int) -> DataFrame:
    """``(place, core)``: distance to the position that makes it ``min_samples``, itself counted; infinite if there are fewer."""
    k = max(1, min_samples - 1)
    near = nearest_neighbours(positions.select(F.col("place").alias("id"), "v"), k, most=MOST_TOGETHER)
    core = near.filter(F.col("nth") == k).select(F.col("id").alias("place"), F.col("distance").alias("core"))
    return positions.select("place").join(core, "place", "left").withColumn("core", F.coalesce("core", F.lit(float("inf"))))


def density_cluster(
    df: DataFrame,
    key: str,
    vector: str,
    min_cluster_size: int = 15,
    min_samples: int = 5,
) -> DataFrame:
    """``(key, cluster)`` for every row; clusters are numbered by an arbitrary id.

    ``vector`` is an ``array<double>`` of few dimensions (see ``reduce_vectors``);
    keys may be of any type. The number of resolutions follows the data, and
    their frame its inner quantiles. Rows without a vector are noise.

    A point in or next to a cell of a chosen cluster belongs to it if its core distance (to the
    nearest positions that make it ``min_samples``) is at most ``STRETCH`` times that of
    three quarters of the positions in the cluster's dense cells; scattered points
    that happen to lie in a wide cell are farther from their neighbours and stay noise.
    """
    points = materialize(df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull()))
    first = points.select(F.size("v").alias("n")).first()
    if first is None:
        return df.select(key, F.lit(NOISE).cast("long").alias("cluster"))
    dims = first["n"]
    positions = materialize(points.groupBy("v").agg(F.min("id").alias("place"), F.count(F.lit(1)).alias("n")))
    lows, width = _frame(points, dims)
    counted = materialize(_cells(positions, lows, width))
    levels = _levels(counted, min_samples)
    dense = counted.filter((F.col("n") >= min_samples) & (F.col("level") <= levels)).select("level", "cell", "n", F.xxhash64("level", "cell").alias("node"))
    cells = _tree(materialize(dense), dims, levels)
    chosen = _choose(cells, levels, min_cluster_size)
    wanted = materialize(cells.join(chosen, "component", "left_semi").select("level", "cell", "n", "component"))
    # points in sparse cells that touch a chosen cell may lie on the border of its cluster
    around = F.array(*[F.array(*[F.lit(s).cast("long") for s in step]) for step in product((-1, 0, 1), repeat=dims) if any(step)])
    border = (
        wanted.select("level", "cell", "component", F.explode(around).alias("step"))
        .select("level", F.zip_with("cell", "step", lambda c, s: c + s).alias("cell"), "component")
        .join(wanted.select("level", "cell"), ["level", "cell"], "left_anti")
        .groupBy("level", "cell")
        .agg(F.min("component").alias("component"))
    )
    inside = wanted.select("level", "cell", "component", F.lit(True).alias("inside"))
    table = materialize(inside.unionByName(border.withColumn("inside", F.lit(False))))
    used = [r["level"] for r in table.select("level").distinct().collect()]  # at most MOST_LEVELS
    at = positions.select("place", "v", F.explode(F.array(*[F.lit(u) for u in used]) if used else F.array().cast("array<int>")).alias("level"))
    placed = at.select("place", "level", _cell(lows, width, F.col("level")).alias("cell"))
    met = lookup_join(placed, table, ["level", "cell"], "inner")
    best = met.groupBy("place").agg(F.max(F.struct("inside", "component")).alias("best")).select("place", "best.inside", "best.component")
    best = materialize(best.join(_core_distances(positions, min_samples), "place"))
    reach = best.filter("inside").groupBy("component").agg((F.percentile_approx("core", 0.75, 100_000) * STRETCH).alias("reach"))
    held = lookup_join(best, reach, ["component"], "inner").filter(F.col("core") <= F.col("reach"))
    named = positions.join(held.select("place", "component"), "place").select("v", "n", "component")
    labels = lookup_join(points, materialize(named), ["v"], "inner", seen="n").select(F.col("id").alias(key), F.col("component").alias("cluster"))
    return df.select(key).join(labels.distinct(), key, "left").withColumn("cluster", F.coalesce("cluster", F.lit(NOISE)))
