"""SimHash fingerprints and exact near-duplicate components by covering hashing.

Covering locality-sensitive hashing (Pagh 2016): every bit gets a non-zero code of r + 1
bits, and for every non-zero v there is a table whose mask holds the bits with an
odd product of code and v. The codes of at most r differing bits span at
most r dimensions, so some v is orthogonal to all of them: in its table none of these
bits is in the mask and both fingerprints have one key. No pair within r is lost.

Equal fingerprints are one node. Keys are counted before rows meet; a key that very many
different fingerprints share is split by covering the bits its mask leaves out, down to
so few bits that a bucket is small by itself. A bucket sends a spanning forest, not its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.operators.components import connected_components
from recensio.operators.scale import lookup_join
from recensio.session import materialize

WORDS = 3
SEED = 42
RADIUS = 3
BITS = 64
#: Different fingerprints that are compared at once; more are split by further masks.
BUCKET = 256
#: Bits outside a mask that are few enough: no more than 2 ** LEFT fingerprints share a key.
LEFT = 8
#: Bytes of a text that are cut into words at once, and shingles whose bits are counted at once.
PIECE = 1 << 20
COUNTED = 1 << 14

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _hashes(text: bytes, words: int) -> Iterator[list[int]]:
    """Hashes of all shingles, piece by piece; a text of fewer words has one."""
    digest = xxhash.xxh64_intdigest
    carried: list[bytes] = []
    seen = begin = 0
    while begin < len(text):
        space = _SPACE.search(text, begin + PIECE)
        end = space.start() if space else len(text)
        found = carried + text[begin:end].lower().split()
        seen += len(found) - len(carried)
        begin = end
        if len(found) >= words:
            yield [digest(b" ".join(s), SEED) for s in zip(*(found[k:] for k in range(words)), strict=False)]
        carried = found[max(0, len(found) - words + 1) :]
    if 0 < seen < words:
        yield [digest(b" ".join(carried), SEED)]


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Bits that are set in over half of the shingle hashes; zero without any word."""
    total, count = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(text or b"", words):
        count += len(hashes)
        for start in range(0, len(hashes), COUNTED):
            part = np.array(hashes[start : start + COUNTED], dtype="<u8")
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * total > count))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``(id, bits)``, the fingerprint as a signed 64-bit number, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [_signed(fingerprint(t.as_py(), words)) for t in batch.column("text")]
            yield pa.record_batch([batch.column("id"), pa.array(bits, pa.int64())], names=["id", "bits"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, bits long")


def covering_masks(places: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the bits ``places`` such that some mask misses any ``radius`` of them."""
    codes = [1 + i % (2 ** (radius + 1) - 1) for i in range(len(places))]
    return [sum(1 << p for p, c in zip(places, codes, strict=True) if (c & v).bit_count() & 1) for v in range(1, 2 ** (radius + 1))]


def _finer(masks: list[int], radius: int) -> list[int]:
    """Masks of the next level: each mask with all coverings of the bits it leaves out."""
    out = []
    for mask in masks:
        rest = [b for b in range(BITS) if not mask >> b & 1]
        out.extend(mask | more for more in covering_masks(rest, radius))
    return out


def _forest(radius: int):
    """One link from each fingerprint of a bucket to the smallest that links reach in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for row in batch.column("bucket"):
                bits = np.sort(row.values.to_numpy())
                near = np.bitwise_count((bits[:, None] ^ bits[None, :]).view(np.uint64)) <= radius
                least, before = np.arange(len(bits)), None
                while before is None or (least != before).any():
                    before = least
                    least = np.where(near, least[None, :], len(bits)).min(axis=1)
                linked = np.flatnonzero(least != np.arange(len(bits)))
                left.append(bits[linked])
                right.append(bits[least[linked]])
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)`` between different fingerprints of ``nodes(bits)``: what links of at most
    ``radius`` differing bits connect, these connect, and nothing else."""
    links = None
    rows, masks = nodes.select("bits", F.lit(0).alias("path")), [0]
    while rows is not None:
        finer = _finer(masks, radius)
        fan = len(finer) // len(masks)
        table = F.array(*[F.lit(_signed(m)) for m in finer])
        spread = rows.withColumn("path", F.explode(F.sequence(F.col("path") * fan, F.col("path") * fan + fan - 1)))
        keyed = spread.withColumn("key", F.col("bits").bitwiseAND(F.element_at(table, F.col("path") + 1)))
        sizes = keyed.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b"))
        sizes = materialize(sizes.filter("n > 1"))
        two = sizes.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
        # where few bits are left, a bucket is small by itself
        last = max(BITS - m.bit_count() for m in finer) <= LEFT
        small = F.lit(True) if last else F.col("n") <= BUCKET
        many = sizes.filter((F.col("n") > 2) & small).select("path", "key", "n")
        members = lookup_join(keyed, many, ["path", "key"], "inner", seen="n")
        buckets = members.groupBy("path", "key").agg(F.collect_list("bits").alias("bucket"))  # at most BUCKET or 2 ** LEFT each
        found = two.unionByName(buckets.select("bucket").mapInArrow(_forest(radius), "a long, b long"))
        links = found if links is None else links.unionByName(found)
        hot = sizes.filter(~small).select("path", "key", "n")
        if last or hot.isEmpty():
            rows = None
        else:
            rows = materialize(lookup_join(keyed, hot, ["path", "key"], "inner", seen="n").select("bits", "path"))
        masks = finer
    return links.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    Words are what lies between ASCII white space, A-Z in lower case; shingles are ``words`` words with
    their repeats. Texts of fewer words are one shingle, texts without a word (null, empty) have
    fingerprint zero and are linked like any other. Fingerprints link at ``radius`` or fewer differing
    bits; ``component_id`` is the smallest id that links reach, the row's own included, and null only where no
    row reached has an id. Ids may be of any type. Repeated rows each stay; an empty table gives no rows; other columns are ignored.
    """
    marked = materialize(fingerprints(docs, doc_id, text, words))
    nodes = materialize(marked.groupBy("bits").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    links = materialize(near_links(nodes, radius))
    linked = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    component = connected_components(linked, links).withColumnRenamed("node", "bits")
    placed = nodes.join(component, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    lowest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(placed.join(lowest, "component").select("bits", "component_id", "rows"))
    whole = lookup_join(marked, named, ["bits"], "inner", seen="rows")
    return whole.select(F.col("id").alias(doc_id), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
