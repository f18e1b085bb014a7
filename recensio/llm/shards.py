"""Balanced label propagation: linked documents gather in shards of equal counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from recensio.llm import arrays as A
from recensio.operators.scale import lookup_join, rank_in_group
from recensio.session import materialize

SHARDS = 8
#: A group above capacity / SPLIT moves document by document, a smaller one as a whole.
SPLIT = 16
#: Bytes of a passage's fingerprint, and fingerprints of which the least is taken: equal runs of GRAM + WINDOW - 1 bytes share a link.
GRAM, WINDOW = 50, 50

_LINES = np.zeros(256, bool)
_LINES[[0x0A, 0x0D]] = True


def _line_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every line that holds more than white space, which is left out at both ends."""
    begins, ends, text = A.words(data, offsets, _LINES)
    marks = np.flatnonzero(~A.SPACES[data])
    first, last = np.searchsorted(marks, begins), np.searchsorted(marks, ends) - 1
    filled = last >= first
    begins, ends = marks[first[filled]], marks[last[filled]] + 1
    return A.span_hashes(data, begins, ends), text[filled]


def _passage_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of GRAM bytes and their texts: the least one of each WINDOW in a row."""
    starts = np.arange(max(0, len(data) - GRAM + 1))
    hashes = A.span_hashes(data, starts, starts + GRAM)
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes[starts + GRAM > offsets[text + 1]] = np.uint64(2**64 - 1)  # those that cross texts
    least, wide = hashes, 1
    while wide < WINDOW and len(least):
        step = min(wide, WINDOW - wide)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        wide += step
    n = len(least)
    inside = starts[:n] + GRAM + WINDOW - 1 <= offsets[text[:n] + 1]
    keys, owners = least[inside], text[:n][inside]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return A.mix(keys[new] + np.uint64(1)), owners[new]


def shared_keys(docs: DataFrame, text: str = "text", name: str = "links") -> DataFrame:
    """``docs`` with the keys of all lines and winnowed passages of ``text``, wherever they stand, under ``name``.

    Texts with an equal line, or an equal run of GRAM + WINDOW - 1 bytes, have a
    key in common. The session must hold the package (``ship``). Null text has no
    keys. All columns stay; one called ``name`` is replaced.
    """
    kept = docs.drop(name)
    schema = StructType([*kept.schema, StructField(name, ArrayType(LongType(), False))])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, text):
                data, offsets = A.text_bytes(piece.column(text))
                lines, passages = _line_keys(data, offsets), _passage_keys(data, offsets)
                owner = np.concatenate([lines[1], passages[1]])
                keys = np.concatenate([lines[0], passages[0]])
                order = np.lexsort((keys, owner))
                owner, keys = owner[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
                owner, keys = owner[new], keys[new]
                bounds = np.searchsorted(owner, np.arange(piece.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.view(np.int64)))
                yield pa.record_batch([*piece.columns, lists], names=[*piece.schema.names, name])

    return kept.mapInArrow(keyed, schema)


def _quotas(flow: dict[tuple[int, int], int], load: dict[int, int], capacity: int, shards: int) -> list[float]:
    """Share of those who want to come that each shard admits: its free places and those of the leaving."""
    quota = [1.0] * shards
    for _ in range(50):
        for to in range(shards):
            coming = sum(n for (_, k), n in flow.items() if k == to)
            leaving = sum(n * quota[k] for (s, k), n in flow.items() if s == to)
            room = capacity - load.get(to, 0) + leaving
            quota[to] = min(quota[to], max(0.0, room / coming)) if coming else 1.0
    return quota


def _gathered(rows: DataFrame, capacity: int, shards: int, rounds: int) -> DataFrame:
    """Move linked documents to the shard that holds most of their group, while it has room.

    ``rows(row, group, group_size, shard)``. Votes are counted per group and
    shard before any join, so a group never meets itself. In every round each
    shard admits, by a hash, the share of those who want to come that its
    free and vacated places allow. A shard that a group nearly fills takes no
    more of it, so the rest gathers in another.
    """
    spread = F.when(F.col("group_size") * SPLIT > capacity, F.xxhash64("row", "round")).otherwise(F.xxhash64("group", "round"))
    chance = (F.shiftright(spread, 32) + F.lit(2**31)) / F.lit(2.0**32)
    rows = materialize(rows)
    full: list[int] = []  # shards that the round before has filled
    for turn in range(rounds):
        votes = materialize(rows.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")))
        load = {r["shard"]: r["n"] for r in votes.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one number a shard
        best = (
            votes.filter((F.col("n") < 0.9 * capacity) & ~F.col("shard").isin([-1, *full]))
            .groupBy("group")
            .agg(F.max(F.struct("n", F.xxhash64("group", "shard").alias("h"), "shard")).alias("b"))
            .select("group", F.col("b.shard").alias("goal"), F.col("b.n").alias("there"), F.col("b.h").alias("h"))
        )
        more = (F.col("there") > F.col("n")) | ((F.col("there") == F.col("n")) & (F.col("h") > F.xxhash64("group", "shard")))
        wishes = materialize(
            votes.join(best, "group")
            .filter((F.col("shard") != F.col("goal")) & more & (F.col("n") < 0.9 * capacity))
            .select("group", "shard", "goal", "n")
        )
        flow = {(r["shard"], r["goal"]): r["n"] for r in wishes.groupBy("shard", "goal").agg(F.sum("n").alias("n")).collect()}
        if not flow and not full:
            break
        quotas = _quotas(flow, load, capacity, shards)
        full = [s for s, q in enumerate(quotas) if q < 0.99]
        go = chance < F.element_at(F.array(*[F.lit(q) for q in quotas]), F.col("goal") + 1)
        rows = materialize(
            lookup_join(rows, wishes, ["group", "shard"], seen="n")
            .withColumn("round", F.lit(turn))
            .withColumn("shard", F.when(F.col("goal").isNotNull() & go, F.col("goal")).otherwise(F.col("shard")))
            .select("row", "group", "group_size", "shard")
        )
    return rows


def _bundles(links: DataFrame) -> DataFrame:
    """``links(row, key)`` as ``(row, key, group_size, weight)``: keys of one row only are left out, keys of the same rows are one.

    ``weight`` is the number of keys in one, shared between the other rows of each.
    """
    sizes = links.groupBy("key").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    shared = materialize(lookup_join(links, materialize(sizes), ["key"], how="inner", seen="group_size"))
    who = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"who{k}") for k in range(2)]
    same = shared.groupBy("key").agg(F.max("group_size").alias("group_size"), *who)
    named = same.groupBy("group_size", "who0", "who1").agg(F.count(F.lit(1)).alias("keys"), F.min("key").alias("key"))
    weight = (F.col("keys") / (F.col("group_size") - 1)).alias("weight")
    return materialize(
        lookup_join(
            shared.select("row", "key"), materialize(named.select("key", "group_size", weight)), ["key"], how="inner", seen="group_size"
        )
    )


def _voted(links: DataFrame, capacity: int, shards: int, rounds: int) -> DataFrame:
    """Move each document to the shard for which most of its links vote, while it has room.

    ``links(row, key, group_size, weight)``. Documents of a key are counted per
    shard before any join, so those of a frequent key never meet each other; a
    document then adds up the counts of all its keys, without itself, so votes
    pass from neighbour to neighbour over the rounds. Half of the documents, by a
    hash, may move in a round, so that neighbours do not swap for ever, and ties
    are settled anew. Shards admit as in ``_gathered``; documents of one leading
    key, the least hash of their keys but for the largest, start and are admitted together.
    """
    lead = F.coalesce(F.min(F.when(F.col("group_size") * SPLIT <= capacity, F.xxhash64("key"))), F.xxhash64(F.col("row"))).alias("group")
    part = lambda h: (F.shiftright(h, 32) + F.lit(2**31)) / F.lit(2.0**32)
    start = F.pmod(F.xxhash64("group"), F.lit(shards)).cast("int").alias("shard")
    begun = materialize(links.groupBy("row").agg(lead, F.count(F.lit(1)).alias("seen")).select("row", start, "seen"))
    links = materialize(lookup_join(links, begun, ["row"], how="inner", seen="seen").drop("seen"))
    full: list[int] = []
    for turn in range(rounds):
        counts = [F.count(F.when(F.col("shard") == s, 1)).alias(f"n{s}") for s in range(shards)]
        votes = materialize(links.groupBy("key").agg(F.count(F.lit(1)).alias("seen"), *counts))
        others = lambda s: F.col(f"n{s}") - F.when(F.col("shard") == s, 1).otherwise(0)
        vote = [F.sum(F.col("weight") * others(s)).alias(f"v{s}") for s in range(shards)]
        summed = (
            lookup_join(links, votes, ["key"], seen="seen")
            .groupBy("row")
            .agg(F.max("shard").alias("shard"), lead, F.count(F.lit(1)).alias("seen"), *vote)
        )
        free = [s for s in range(shards) if s not in full] or list(range(shards))
        vote = [F.col(f"v{s}") + part(F.xxhash64("row", F.lit(turn), F.lit(s))) * 1e-6 for s in range(shards)]
        best = F.array_max(F.array(*[F.struct(vote[s].alias("v"), F.lit(s).alias("s")) for s in free]))
        moves = (best["v"] > F.element_at(F.array(*vote), F.col("shard") + 1)) & (part(F.xxhash64(F.lit(turn), "row")) < 0.5)
        goal = F.when(moves, best["s"]).otherwise(F.col("shard")).alias("goal")
        wishes = materialize(summed.select("row", "shard", "group", "seen", goal))
        pairs = {(r["shard"], r["goal"]): r["n"] for r in wishes.groupBy("shard", "goal").agg(F.count(F.lit(1)).alias("n")).collect()}
        load = {s: sum(n for (k, _), n in pairs.items() if k == s) for s in range(shards)}
        flow = {(s, k): n for (s, k), n in pairs.items() if s != k}
        if not flow and not full:
            break
        quotas = _quotas(flow, load, capacity, shards)
        full = [s for s, q in enumerate(quotas) if q < 0.99]
        go = part(F.xxhash64("group", F.lit(turn))) < F.element_at(F.array(*[F.lit(q) for q in quotas]), F.col("goal") + 1)
        moves = materialize(wishes.filter((F.col("shard") != F.col("goal")) & go).select("row", "goal", "seen"))
        links = materialize(
            lookup_join(links, moves, ["row"], seen="seen").select(
                "row", "key", "group_size", "weight", F.coalesce("goal", "shard").alias("shard")
            )
        )
    return links.groupBy("row").agg(lead, F.max("group_size").alias("group_size"), F.max("shard").alias("shard"))


def shard_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    group: Column | None = None,
    rounds: int = 12,
    links: Column | None = None,
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot, group_size)``, one row per row of ``docs``.

    Documents of one ``group`` (default: equal texts) are linked. With ``links``,
    an array of integer keys such as ``shared_keys`` gives, those with a key in
    common are linked instead, and ``group_size`` is the largest number of
    documents that have one of its keys in common. Counts of the
    shards are at most one apart: linked documents gather by label propagation,
    the few that exceed a shard's exact share and all unlinked ones then fill
    the shards up. ``slot`` numbers a shard's documents from 0 without gaps.
    A group larger than a shard is spread over as few as the quotas allow. Null
    text has no bytes, and null texts are linked with empty ones. Rows without
    id, and repeated rows, are placed like others. An empty table gives no rows;
    other columns are ignored.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    group = links if links is not None else (F.sha2(t, 256) if group is None else group).cast("string")
    rows = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(t) + 1).cast("long").alias("size"),
            F.crc32(t).alias("text_crc32"),
            group.alias("group"),
        )
    )
    n = rows.count()
    share = [n // shards + (s < n % shards) for s in range(shards)]
    if links is not None:
        keyed = rows.select("row", F.explode(F.array_distinct("group")).alias("key")).filter(F.col("key").isNotNull())
        linked = materialize(_voted(_bundles(keyed), min(share), shards, rounds))
        alone_rows = rows.select("row").join(linked.select("row"), "row", "left_anti")
    else:
        groups = rows.filter(F.col("group").isNotNull()).groupBy("group").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
        sized = materialize(lookup_join(rows.select("row", "doc_id", "group"), materialize(groups), ["group"], seen="group_size"))
        start = F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int").alias("shard")
        linked = _gathered(sized.filter("group_size > 1").select("row", "group", "group_size", start), min(share), shards, rounds)
        alone_rows = sized.filter("group_size is null")
    # exact counts: what exceeds a shard's share joins the unlinked documents, which fill the rest
    alone = F.xxhash64("group")
    if links is None:
        alone = F.when(F.col("group_size") * SPLIT > min(share), F.xxhash64("row")).otherwise(alone)
    ranked = materialize(rank_in_group(linked, "shard", alone, "row", "rank"))
    exact = F.create_map(*[F.lit(x) for s, k in enumerate(share) for x in (s, k)])
    kept = ranked.filter(F.col("rank") <= exact[F.col("shard")]).select("row", "group_size", "shard")
    pool = (
        ranked.filter(F.col("rank") > exact[F.col("shard")])
        .select("row", "group_size")
        .unionByName(alone_rows.select("row", F.lit(1).cast("long").alias("group_size")))
    )
    taken = {r["shard"]: r["n"] for r in kept.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound, place = 0, F.lit(shards - 1)
    for s in reversed(range(shards)):  # from the last bound down, so that the first that holds wins
        bound = sum(share[k] - taken.get(k, 0) for k in range(s + 1))
        place = F.when(F.col("rank") <= bound, s).otherwise(place)
    filled = rank_in_group(pool.withColumn("all", F.lit(0)), "all", F.xxhash64("row"), "row", "rank")
    placed = materialize(kept.unionByName(filled.select("row", "group_size", place.cast("int").alias("shard"))))
    slots = rank_in_group(placed, "shard", F.xxhash64("row"), "row", "slot")
    return rows.select("row", "doc_id", "size", "text_crc32").join(
        slots.select("row", "shard", (F.col("slot") - 1).cast("long").alias("slot"), F.col("group_size")), "row"
    ).drop("row")
