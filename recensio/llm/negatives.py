"""Hard negatives by exact integer scores, looked up in tables of subset sums.

The method of the Four Russians: for every eight dimensions an anchor has a table of the sums
of all 256 subsets of its components. A candidate is stored as bit planes of its integer
components (two's complement), one byte for eight dimensions; a plane's sum is one
lookup per byte, and the planes are shifted and added into the whole inner product.

Anchors, the stated query set, are taken in numbered rounds of at most ``ROUND_ANCHORS``,
which is all that is broadcast; candidates stay where they lie and pass by in batches. A
task keeps only the rows that can still be among an anchor's first ones. Positives
are settled before negatives, since they set the window of each search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recensio.operators.scale import number_in_order
from recensio.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Negatives score between these hundredths of the positive's score.
LOWEST, HIGHEST = 30, 90
#: Anchors that are broadcast at once; with eight bytes a component they take 128 KB a dimension.
ROUND_ANCHORS = 16_384
#: Anchors whose tables are held at once, and candidates scored at once.
BLOCK_ANCHORS = 256
BLOCK_ROWS = 512
#: Candidates scored first, when nothing is known yet of an anchor's best.
FIRST_ROWS = 32

_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_LEAST = np.iinfo(np.int64).min


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """``[group, byte, anchor]``: sums of the components whose bits are set in the byte."""
    count, dims = anchors.shape
    padded = np.zeros((count, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = anchors
    groups = padded.shape[1] // 8
    # in so few bits that a whole score fits
    kind = np.int32 if np.abs(padded).sum(axis=1).max(initial=0) < 2**15 else np.int64
    tables = np.zeros((groups, 256, count), kind)
    for g in range(groups):
        for bit in range(8):
            tables[g, 1 << bit : 2 << bit] = tables[g, : 1 << bit] + padded[:, 8 * g + bit].astype(kind)
    return tables


def bit_planes(rows: np.ndarray, planes: int) -> np.ndarray:
    """``[row, plane, group]``: byte per eight components of each plane of their two's complement."""
    bits = (rows[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``[row, anchor]`` inner products; ``planes`` is ``[plane, group, row]``.

    Groups that one side lacks count as zeros.
    """
    count, groups, rows = planes.shape
    kind = tables.dtype if count <= 16 else np.dtype(np.int64)
    total = np.zeros((rows, tables.shape[2]), kind)
    found, plane_sum = np.empty((2, rows, tables.shape[2]), tables.dtype)
    for p in range(count - 1, -1, -1):
        plane_sum[:] = 0
        for g in range(min(groups, len(tables))):
            np.take(tables[g], planes[p, g], axis=0, out=found, mode="clip")
            plane_sum += found
        if p == count - 1:
            total -= plane_sum  # the sign's plane
        else:
            total <<= 1
            total += plane_sum
    return total


class Best:
    """The first ``most`` rows of each owner by score, ties by row."""

    def __init__(self, owners: int, most: int, least: np.ndarray | None = None):
        self.most = most
        self.found = [np.zeros(0, np.int64)] * 3
        #: Scores below are out of the running.
        self.bound = np.full(owners, _LEAST) if least is None else least.copy()

    def add(self, owner: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(owner):
            return
        owner, score, row = (np.concatenate(x) for x in zip(self.found, (owner, score, row), strict=True))
        order = np.lexsort((row, -score, owner))
        owner, score, row = owner[order], score[order], row[order]
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        place = np.arange(len(owner)) - np.repeat(begins, np.diff([*begins, len(owner)]))
        full = place == self.most - 1
        self.bound[owner[full]] = score[full]
        stays = place < self.most
        self.found = [owner[stays], score[stays], row[stays]]


class _Round:
    """A round's anchors as tasks see them, in the order of labels."""

    def __init__(self, anchors: pa.Table, positives: pa.Table | None = None):
        self.place = anchors["place"].to_numpy()
        self.row = anchors["row"].to_numpy()
        self.label = anchors["label"].to_numpy()
        self.vectors = [np.frombuffer(v, np.int64) for v in anchors["whole"].to_pylist()]
        if positives is not None:
            at = np.searchsorted(self.place, positives["place"].to_numpy())
            slot = at * POSITIVES + positives["rank"].to_numpy()
            self.score = np.zeros(len(self.place) * POSITIVES, np.int64)
            self.positive, self.known = self.score.copy(), np.zeros(len(self.score), bool)
            self.score[slot], self.positive[slot], self.known[slot] = positives["score"].to_numpy(), positives["row"].to_numpy(), True

    def tables(self, begin: int, end: int) -> np.ndarray:
        held = self.vectors[begin:end]
        whole = np.zeros((len(held), max(map(len, held))), np.int64)
        for i, v in enumerate(held):
            whole[i, : len(v)] = v
        return subset_sums(whole)


def _batches(batches: Iterator[pa.RecordBatch], count: int):
    """Labels, rows and planes of a batch; vectors of several lengths one length after the other."""
    for batch in batches:
        label, row = (batch.column(c).to_numpy() for c in ("label", "row"))
        packed = batch.column("planes").to_pylist()
        sizes = np.array([len(p) for p in packed])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            planes = np.frombuffer(b"".join(packed[i] for i in at), np.uint8).reshape(len(at), count, size // count)
            yield label[at], row[at], planes.transpose(1, 2, 0)


def _pieces(begin: int, end: int, fresh: bool):
    if fresh and begin < end:
        yield begin, min(end, begin + FIRST_ROWS)
        begin += FIRST_ROWS
    for start in range(begin, end, BLOCK_ROWS):
        yield start, min(end, start + BLOCK_ROWS)


def _positives(known, count: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = known.value
        best: dict[int, Best] = {}
        for label, row, planes in _batches(batches, count):
            order = np.argsort(label, kind="stable")
            label, row, planes = label[order], row[order], planes[:, :, order]
            for value in np.intersect1d(label, anchors.label):
                first, last = np.searchsorted(label, value), np.searchsorted(label, value, side="right")
                begin, end = np.searchsorted(anchors.label, value), np.searchsorted(anchors.label, value, side="right")
                for a in range(begin, end, BLOCK_ANCHORS):
                    b = min(end, a + BLOCK_ANCHORS)
                    own, tables = best.setdefault(a, Best(b - a, most)), anchors.tables(a, b)
                    for i, j in _pieces(first, last, not len(own.found[0])):
                        got = scores(tables, np.ascontiguousarray(planes[:, :, i:j]))
                        keep = (got >= own.bound[None, :]) & (row[i:j, None] != anchors.row[None, a:b])
                        r, o = np.nonzero(keep)
                        own.add(o, got[r, o].astype(np.int64), row[i + r])
        for a, own in best.items():
            owner, score, row = own.found
            yield pa.record_batch([pa.array(anchors.place[a + owner]), pa.array(score), pa.array(row)], names=["place", "score", "row"])

    return run


def _negatives(known, count: int, most: int, lowest: int, highest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = known.value
        low, high = -((-lowest * anchors.score) // 100), (highest * anchors.score) // 100
        low[~anchors.known] = np.iinfo(np.int64).max
        best: dict[int, Best] = {}
        for label, row, planes in _batches(batches, count):
            for a in range(0, len(anchors.place), BLOCK_ANCHORS):
                b = min(len(anchors.place), a + BLOCK_ANCHORS)
                slots = slice(a * POSITIVES, b * POSITIVES)
                own = best.setdefault(a, Best((b - a) * POSITIVES, most, low[slots]))
                tables, most_score = anchors.tables(a, b), high[slots].reshape(-1, POSITIVES)
                for i, j in _pieces(0, len(row), not len(own.found[0])):
                    got = scores(tables, np.ascontiguousarray(planes[:, :, i:j]))
                    other = (label[i:j, None] != anchors.label[None, a:b]) & (row[i:j, None] != anchors.row[None, a:b])
                    least = own.bound.reshape(-1, POSITIVES)
                    found = [np.nonzero(other & (got >= least[None, :, p]) & (got <= most_score[None, :, p])) for p in range(POSITIVES)]
                    r = np.concatenate([x for x, _ in found])
                    o = np.concatenate([y for _, y in found])
                    slot = np.concatenate([y * POSITIVES + p for p, (_, y) in enumerate(found)])
                    own.add(slot, got[r, o].astype(np.int64), row[i + r])
        for a, own in best.items():
            slot, score, row = own.found
            slot = slot + a * POSITIVES
            columns = [anchors.place[slot // POSITIVES], anchors.row[slot // POSITIVES], slot % POSITIVES, anchors.positive[slot], anchors.score[slot], row, score]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    return run


_FOUND = pa.schema([(n, pa.int64()) for n in ("place", "anchor", "rank", "positive", "positive_score", "row", "score")])


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the lists of each length, BLOCK_ROWS at a time."""
    sizes = pc.list_value_length(column).to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for start in range(0, len(at), BLOCK_ROWS):
            some = at[start : start + BLOCK_ROWS]
            yield some, column.take(pa.array(some)).flatten().to_numpy().reshape(len(some), size)


def _packed(planes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes] = [b""] * len(batch)
            for places, whole in _by_length(batch.column("whole")):
                for place, row in zip(places, bit_planes(whole, planes), strict=True):
                    packed[place] = row.tobytes()
            yield pa.record_batch([batch.column("label"), batch.column("row"), pa.array(packed, pa.binary())], names=["label", "row", "planes"])

    return run


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = [np.array(v, np.int64).tobytes() for v in batch.column("whole").to_pylist()]
        columns = [batch.column("place").cast(pa.int64()), batch.column("row"), batch.column("label"), pa.array(whole, pa.binary())]
        yield pa.record_batch(columns, names=["place", "row", "label", "whole"])


def _first(df: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "row")
    return df.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    scale: int = SCALE,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` marks the query rows. A component x counts as floor(scale * x); a score is the
    inner product of integers. For each anchor and each of its first ``POSITIVES`` rows of
    equal label, the first ``negatives`` rows of another label whose score is between
    ``lowest`` and ``highest`` hundredths of the positive's; higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component, take no
    part. Shorter vectors count as if zeros followed. Labels are integers, ids of any
    type that sorts. Repeated rows each count as rows, and a repeated anchor gives its rows again; rows with
    an integer id equal to the anchor's are not among its other rows. An empty table gives no rows; other
    columns are ignored. Scores that could leave 64 bits are refused.
    """
    spark = vectors.sparkSession
    of = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(vec_id).alias("id"), of.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("query")
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    kind = dict(rows.dtypes)["id"]
    numbered = kind not in _INTEGERS
    rows = materialize(number_in_order(rows, [F.col("id"), F.xxhash64("v")], "row")) if numbered else rows.withColumn("row", F.col("id").cast("long"))
    whole = F.transform("v", lambda x: F.floor(x * scale))
    found = rows.agg(
        F.max(F.array_max(F.transform("v", F.abs))).alias("most"), F.max(F.size("v")).alias("dims"), F.max(F.when(F.col("query"), 1)).alias("any")
    ).first()
    empty = spark.createDataFrame([], f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long")
    if found["any"] is None:
        return empty
    size = int(np.ceil((found["most"] or 0.0) * scale))
    if size * size * max(1, found["dims"]) * 100 >= 2**62:
        raise ValueError(f"components up to {found['most']:g} may give scores beyond 64 bits")
    count = size.bit_length() + 1  # bits of two's complement
    whole_rows = rows.select("row", "label", "query", whole.alias("whole"))
    candidates = whole_rows.sortWithinPartitions("label").mapInArrow(_packed(count), "label long, row long, planes binary")
    candidates = materialize(candidates)
    asked = whole_rows.filter("query").select("row", "label", "whole")
    asked = number_in_order(asked, [F.col("label"), F.col("row"), F.xxhash64("whole")], "place")
    asked = materialize(asked.mapInArrow(_as_bytes, "place long, row long, label long, whole binary"))
    rounds = -(-asked.count() // ROUND_ANCHORS)
    parts = []
    for r in range(rounds):
        inside = F.col("place").between(r * ROUND_ANCHORS, (r + 1) * ROUND_ANCHORS - 1)
        anchors = asked.filter(inside).orderBy("place").toArrow()  # at most ROUND_ANCHORS rows
        known = spark.sparkContext.broadcast(_Round(anchors))
        near = candidates.mapInArrow(_positives(known, count, POSITIVES), "place long, score long, row long")
        positives = _first(near, ["place"], POSITIVES).select("place", "score", "row", (F.col("nth") - 1).cast("long").alias("rank")).toArrow()
        known.unpersist()
        known = spark.sparkContext.broadcast(_Round(anchors, positives))
        met = candidates.mapInArrow(_negatives(known, count, negatives, lowest, highest), ", ".join(f"{f.name} long" for f in _FOUND))
        parts.append(materialize(_first(met, ["place", "rank"], negatives)))
        known.unpersist()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if not numbered:
        ids = {c: F.col(c).cast(kind) for c in ("anchor", "positive", "row")}
    else:
        names = rows.select("row", "id")
        for c in ("anchor", "positive", "row"):
            named = names.select(F.col("row").alias(f"_{c}_row"), F.col("id").alias(f"_{c}"))
            out = out.join(named, F.col(c) == F.col(f"_{c}_row")).drop(f"_{c}_row")
        ids = {c: F.col(f"_{c}") for c in ("anchor", "positive", "row")}
    return out.select(
        ids["anchor"].alias("anchor_id"),
        ids["positive"].alias("positive_id"),
        F.col("nth").cast("int").alias("rank"),
        ids["row"].alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

