"""N-gram Jaccard join by Bayesian pruning of MinHash candidates and an exact check.

Texts with equal shingle sets are one class from the start. Classes that agree in
a band of MinHash values meet in that band's bucket; a pair is looked at in its
first common band only, and its MinHash values are compared a few at a time: it is
dropped as soon as the posterior probability that its similarity reaches the
threshold falls below the tolerance. What is left is counted exactly on the
shingle sets. Buckets are cut into blocks and pairs live in numpy arrays inside
a task; between tasks go members of blocks, packed pairs, and one row per member
with the number of its links, so a group of n near copies costs n rows for every
block it fills and not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.llm import arrays as A
from recensio.operators.components import connected_components
from recensio.session import materialize

WORDS = 5
THRESHOLD = 0.8
#: Bands times values per band: a pair at 0.8 shares no band with a chance of 5e-8.
BANDS, ROWS = 32, 4
#: Least posterior probability of reaching the threshold for a pair to stay.
TOLERANCE = 1e-7
STEP = 16
#: Members and shingles of a block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Texts to verify are looked up by broadcast up to this number (16 bytes each).
BROADCAST_TEXTS = 2_000_000

_seeds = A.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
_XOR = (_seeds[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_seeds[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

SIGNED = "text_hash long, class long, shingles int, signature binary"


def least_matches(threshold: float, tolerance: float, step: int = STEP, values: int = BANDS * ROWS) -> list[int]:
    """For each number of compared values the fewest matches with which a pair stays.

    With a uniform prior the similarity after m of n matches is Beta(m+1, n-m+1)
    distributed; its tail above the threshold is a binomial sum.
    """
    out = []
    for n in range(step, values + 1, step):
        below = np.cumsum([comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(n + 2)])
        out.append(next(m for m in range(n + 1) if below[m] >= tolerance))
    return out


def _shingle_sets(column, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, text = A.word_hashes(column, A.MARKS, lower=True)
    values, owner = A.shingles(hashes, text, len(column), words)
    bounds = np.searchsorted(owner, np.arange(len(column) + 1))
    return [np.unique(values[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each MinHash value, one row per non-empty set."""
    begins = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    all_ = (np.concatenate(sets) >> np.uint64(16)).astype(np.uint32)
    out = np.empty((len(sets), BANDS * ROWS), np.uint16)
    for k in range(BANDS * ROWS):
        x = (all_ ^ _XOR[k]) * _TIMES[k]
        x ^= x >> np.uint32(15)
        low = np.minimum.reduceat(x, begins) * np.uint32(0x85EBCA6B)
        out[:, k] = low >> np.uint32(16)
    return out


def _sign(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, "text"):
                sets = _shingle_sets(piece.column("text"), words)
                has = np.array([len(s) > 0 for s in sets])
                full = [s for s in sets if len(s)]
                ids = np.array([int(A.mix(s).sum(dtype=np.uint64)) for s in full], np.uint64).view(np.int64)
                signed = iter(_signatures(full)) if full else iter(())
                ids = iter(ids.tolist())
                yield pa.record_batch(
                    [
                        piece.column("doc_id"),
                        piece.column("text_hash"),
                        pa.array([next(ids) if x else None for x in has], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([next(signed).tobytes() if x else None for x in has], pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "class", "shingles", "signature"],
                )

    return sign


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
            data = b"".join(piece.column("signature").to_pylist())
            bands = np.frombuffer(data, np.uint64).reshape(-1, BANDS)
            keys = A.mix(bands + A.mix(np.arange(1, BANDS + 1, dtype=np.uint64)))
            number = np.tile(np.arange(BANDS, dtype=np.int32), len(bands))
            rows = {n: np.repeat(piece.column(n).to_numpy(), BANDS) for n in ("class", "shingles")}
            yield pa.record_batch(
                [pa.array(keys.ravel().view(np.int64)), pa.array(number), pa.array(rows["class"]), pa.array(rows["shingles"])],
                names=["key", "band", "class", "shingles"],
            )


def _pairs_of(count: np.ndarray, first: np.ndarray, most: int):
    """All pairs inside runs of members, as two arrays of positions, some ``most`` at a time."""
    row = np.arange(count.sum())
    left = np.repeat(first + count, count) - row - 1  # members after each one in its run
    i = 0
    upto = np.cumsum(left)
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + most, side="right")))
        a = np.repeat(row[i:j], left[i:j])
        b = np.arange(len(a)) - np.repeat(np.cumsum(left[i:j]) - left[i:j], left[i:j]) + a + 1
        yield a, b
        i = j


PRUNED = "unit long, class long, copies long, left binary, right binary"
_PRUNED = pa.schema([("unit", pa.int64()), ("class", pa.int64()), ("copies", pa.int64()), ("left", pa.binary()), ("right", pa.binary())])


def _prune(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def prune(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("unit", "ascending"), ("class", "ascending")])
        signature = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)
        bands = np.ascontiguousarray(signature).view(np.uint64)
        unit, ids, copies = (table[n].to_numpy() for n in ("unit", "class", "copies"))
        band, block = table["band"].to_numpy(), table["block"].to_numpy()
        apart = table["apart"].to_numpy(zero_copy_only=False).astype(bool)  # a pair of two blocks: only pairs across
        first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        count = np.diff(np.append(first, len(unit)))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in _pairs_of(count, first, 1 << 17):
            ok = ~apart[a] | (block[a] != block[b])
            a, b = a[ok], b[ok]
            ok = (bands[a] == bands[b]).argmax(axis=1) == band[a]
            a, b = a[ok], b[ok]
            match = np.zeros(len(a), np.int64)
            for n, need in enumerate(least):
                part = slice(n * STEP, (n + 1) * STEP)
                match += (signature[a, part] == signature[b, part]).sum(axis=1)
                ok = match >= need
                a, b, match = a[ok], b[ok], match[ok]
            found.append((a, b))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
        rows = []
        order = np.argsort(unit[a], kind="stable")
        a, b = a[order], b[order]
        starts = np.flatnonzero(np.concatenate([[True], unit[a][1:] != unit[a][:-1]])) if len(a) else []
        for i, j in zip(starts, [*starts[1:], len(a)], strict=False):
            rows.append((int(unit[a[i]]), None, None, ids[a[i:j]].tobytes(), ids[b[i:j]].tobytes()))
        used = np.unique(np.concatenate([a, b]))
        rows += [(int(u), int(c), int(n), None, None) for u, c, n in zip(unit[used], ids[used], copies[used], strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _PRUNED]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PRUNED, strict=True)], schema=_PRUNED)

    return prune


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, "text"):
                made = [s.tobytes() for s in _shingle_sets(piece.column("text"), words)]
                yield pa.record_batch([piece.column("class"), pa.array(made, pa.binary())], names=["class", "shingle_set"])

    return sets


LINKED = "class long, root long, weight long"
_LINKED = pa.schema([("class", pa.int64()), ("root", pa.int64()), ("weight", pa.int64())])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position that each of n members is linked with, over any number of links."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        np.minimum.at(low, root, low)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _verify(threshold: float):
    def verify(key: tuple[pa.Scalar, ...], pairs: pa.Table, members: pa.Table) -> pa.Table:
        members = members.sort_by([("unit", "ascending"), ("class", "ascending")])
        unit, ids, copies = (members[n].to_numpy() for n in ("unit", "class", "copies"))
        blobs = members["shingle_set"]
        out = []
        for u, left, right in zip(pairs["unit"].to_pylist(), pairs["left"].to_pylist(), pairs["right"].to_pylist(), strict=True):
            i, j = np.searchsorted(unit, u, "left"), np.searchsorted(unit, u, "right")
            own = ids[i:j]
            a, b = (np.searchsorted(own, np.frombuffer(x, np.int64)) for x in (left, right))
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in blobs.slice(i, j - i)]
            size = np.array([len(s) for s in sets])
            begin = np.cumsum(size) - size
            vocabulary, number = np.unique(np.concatenate(sets), return_inverse=True)
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            both = np.empty(len(a), np.int64)
            mark = np.zeros(len(vocabulary), np.int32)
            starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            for s, e in zip(starts, [*starts[1:], len(a)], strict=False):
                mine = number[begin[a[s]] : begin[a[s]] + size[a[s]]]
                mark[mine] = 1
                if 4 * (e - s) > len(sets):
                    both[s:e] = np.add.reduceat(mark[number], begin)[b[s:e]]
                else:
                    both[s:e] = [mark[number[begin[k] : begin[k] + size[k]]].sum() for k in b[s:e]]
                mark[mine] = 0
            true = both + 1e-9 >= threshold * (size[a] + size[b] - both)
            a, b = a[true], b[true]
            n = copies[i:j]
            weight = np.bincount(a, weights=n[b], minlength=j - i) + np.bincount(b, weights=n[a], minlength=j - i)
            linked = np.flatnonzero(weight)
            root = _roots(j - i, a, b)
            out.append((own[linked], own[root[linked]], weight[linked].astype(np.int64)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c) for c in columns], schema=_LINKED)

    return verify


def similarity_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(doc_id, text_hash, class_id, n_links, n_shingles, group)``, one row per row of ``docs``.

    Two texts are linked if the Jaccard similarity of their sets of
    ``words``-word shingles is at least ``threshold``; words are lower-cased
    runs of letters, digits and non-ASCII characters, ids of any type that sorts; a shorter text is one
    shingle. ``n_links`` counts the linked rows, copies and repeated rows
    included; ``class_id`` is the smallest id among all rows that links connect
    (null if none of them has one), ``group`` a number of the class that is never null. Null texts and texts without words have no
    shingles, no links, and their own id as class. An empty table gives no
    rows; other columns are ignored. Sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    kind = dict(rows.dtypes)["doc_id"]
    signed = materialize(rows.select("doc_id", "text_hash", "text").mapInArrow(_sign(words), f"doc_id {kind}, {SIGNED}"))
    full = signed.filter(F.col("class").isNotNull())
    classes = materialize(
        full.groupBy("class").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("doc_id").alias("least"),
            F.min("text_hash").alias("text_hash"),
            F.first("shingles").alias("shingles"),
            F.first("signature").alias("signature"),
        )
    )
    # bands that two classes share
    bands = classes.select("class", "shingles", "signature").mapInArrow(_band_keys, "key long, band int, class long, shingles int")
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("total")).filter("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    shared = bands.drop("shingles").join(sizes.select("key", blocks.alias("blocks")), "key")
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    met = shared.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "band", "class", "block", (F.col("block") != F.col("other")).alias("apart")
    )
    # a block meets itself once, and a pair of blocks holds the members of both
    met = materialize(met)
    seen = met.count()
    buckets = max(parts, seen // 20_000 + 1)
    with_signs = met.join(classes.select("class", "copies", "signature"), "class")
    units = with_signs.withColumn("bucket", F.pmod("unit", F.lit(buckets)).cast("int"))
    pruned = materialize(units.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_prune(threshold, tolerance), PRUNED))
    # exact check on the shingle sets of what is left
    members = pruned.filter(F.col("class").isNotNull()).select("unit", "class", "copies")
    wanted = materialize(classes.select("class", "text_hash", "shingles").join(members.select("class").distinct(), "class", "left_semi"))
    looked_up = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
    texts = rows.select("text_hash", "text").join(looked_up.select("class", "text_hash"), "text_hash").select("class", "text")
    sets = texts.mapInArrow(_sets(words), "class long, shingle_set binary").dropDuplicates(["class"])
    load = members.join(wanted.select("class", "shingles"), "class").agg(F.sum("shingles")).first()[0] or 0
    buckets = max(parts, load // 400_000 + 1)
    to = lambda df: df.withColumn("bucket", F.pmod("unit", F.lit(buckets)).cast("int")).repartition(buckets, "bucket").groupBy("bucket")
    linked = materialize(
        to(pruned.filter(F.col("left").isNotNull()).select(F.col("unit").alias("unit"), "left", "right"))
        .cogroup(to(members.join(sets, "class")))
        .applyInArrow(_verify(threshold), LINKED)
    )
    counts = linked.groupBy("class").agg(F.sum("weight").alias("weight"))
    edges = linked.filter(F.col("class") != F.col("root")).select(F.col("class").alias("a"), F.col("root").alias("b")).distinct()
    component = connected_components(linked.select(F.col("class").alias("node")).distinct(), edges)
    component = component.withColumnRenamed("node", "class")
    named = component.join(classes.select("class", "least"), "class").groupBy("component").agg(F.min("least").alias("lowest"))
    known = classes.select("class", "copies", "least").join(counts, "class", "left").join(component, "class", "left").join(named, "component", "left")
    known = known.select(
        "class",
        (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("lowest")).alias("class_id"),
        F.coalesce("component", "class").alias("group"),
    )
    own = signed.select("doc_id", "text_hash", "class", F.col("shingles").cast("long").alias("n_shingles"))
    none = F.lit(0).cast("long")
    alone = own.filter(F.col("class").isNull()).withColumns(
        {"class_id": F.col("doc_id"), "n_links": none, "group": F.xxhash64("doc_id", "text_hash")}
    )
    return own.filter(F.col("class").isNotNull()).join(known, "class").unionByName(alone).drop("class")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, rows without id last; repeated rows stay once.

    Which of several texts of that id stays is settled by a hash. Columns stay as they are.
    """
    members = similarity_classes(docs, doc_id, text, **settings)
    first = members.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("_id", "_text"):
        while name in taken:
            name += "_"
        names.append(name)
    own_id, own_text = names
    keepers = first.select(F.col("k.doc_id").alias("_keep_id"), F.col("k.text_hash").alias("_keep_text"))
    keys = [F.col(doc_id).alias(own_id), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias(own_text)]
    keyed = docs.select("*", *keys)
    same = keyed[own_id].eqNullSafe(keepers["_keep_id"]) & (keyed[own_text] == keepers["_keep_text"])
    kept = keyed.join(keepers, same, "left_semi")
    return kept.dropDuplicates(names).select(*docs.columns)
