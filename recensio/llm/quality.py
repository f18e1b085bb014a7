"""Quality classifier: boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.llm import arrays as A
from recensio.llm import boosting

#: The forest is fitted on at most so many labelled documents, those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
#: Documents whose chance of being good is lower are rejected.
KEEP = 0.7

_LINES = np.zeros(256, bool)
_LINES[0x0A] = True


def _class(*bytes_: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(bytes_)] = True
    return table


_CLASSES = [
    _class(*range(0x41, 0x5B)),  # capitals
    _class(*range(0x61, 0x7B)),  # small letters
    _class(*range(0x30, 0x3A)),
    _class(*range(0x80, 0xC0)),  # about one for each non-ASCII letter
    _class(*b".,;:"),
    _class(*b"!?"),
    _class(*b"#$%&*+=<>@^~_"),
    _class(*b"|/\\"),
    _class(*b"()[]{}\"'`"),
    _class(0x0A),
    _class(0x20, 0x09),
]


def _repeats(text: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Different items and occurrences of the most frequent one, per text."""
    keys = A.mix(hashes + (text + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, count = np.unique(keys, return_index=True, return_counts=True)
    owner = text[first]
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, owner, count)
    return np.bincount(owner, minlength=texts), most


def statistics(column) -> np.ndarray:
    """One row of numbers per text: lengths, shares of kinds of characters, repetition of words and lines."""
    data, offsets = A.text_bytes(column)
    texts = len(offsets) - 1
    size = np.diff(offsets)
    per = np.maximum(size, 1)
    upto = np.zeros(len(data) + 1, np.int64)
    shares = []
    for table in _CLASSES:
        np.cumsum(table[data], out=upto[1:])
        shares.append((upto[offsets[1:]] - upto[offsets[:-1]]) / per)
    begins, ends, text = A.words(data, offsets)
    hashes = A.span_hashes(data, begins, ends)
    count = np.bincount(text, minlength=texts)
    words = np.maximum(count, 1)
    length = (ends - begins).astype(float)
    total = lambda x: np.bincount(text, weights=x, minlength=texts)
    mean = total(length) / words
    spread = np.sqrt(np.maximum(total(length**2) / words - mean**2, 0))
    longest = np.zeros(texts)
    np.maximum.at(longest, text, length)
    different, most = _repeats(text, hashes, texts)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    pairs = A.gram_hashes(hashes, 3)
    inside = text[: len(pairs)] == text[2:][: len(pairs)]
    triples, most_triples = _repeats(text[: len(pairs)][inside], pairs[inside], texts)
    n_triples = np.maximum(count - 2, 1)
    first, last = (data[begins], data[ends - 1]) if len(begins) else (np.zeros(0, np.uint8),) * 2
    odd_end = ~(_CLASSES[0] | _CLASSES[1] | _CLASSES[2] | _CLASSES[3])[last] & ~np.isin(last, list(b".,;:?"))
    starts_capital = _CLASSES[0][first]
    short = length <= 3
    lb, le, line_text = A.words(data, offsets, _LINES)
    lines = np.bincount(line_text, minlength=texts)
    different_lines, most_lines = _repeats(line_text, A.span_hashes(data, lb, le), texts)
    columns = [
        np.log1p(size),
        np.log1p(count),
        *shares,
        mean,
        spread,
        np.log1p(longest),
        different / words,
        most / words,
        total(again) / words,
        triples / n_triples,
        most_triples / n_triples,
        total(odd_end) / words,
        total(starts_capital) / words,
        total(short) / words,
        np.log1p(lines),
        different_lines / np.maximum(lines, 1),
        most_lines / np.maximum(lines, 1),
        shares[0] / np.maximum(shares[0] + shares[1], 1e-9),
    ]
    return np.stack(columns, axis=1)


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from A.pieces(batch, "text")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in _in_pieces(batches):
        x = statistics(piece.column("text"))
        columns = [piece.column("doc_id"), piece.column("quality"), pa.array(list(x), pa.list_(pa.float64()))]
        yield pa.record_batch(columns, names=["doc_id", "quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAIN_ROWS) -> boosting.Forest:
    """Forest from ``labels(doc_id, quality)`` of ``docs``; rows without id or label are left out.

    An id labelled several times counts as 1 if at least half of its labels are; of
    several rows of an id the text with the smallest hash is taken.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("quality")).dropna()
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # at most `most` rows of two numbers
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id")
    # the least hash of an id first, so that no text but the taken one moves
    least = found.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("h"))
    one = found.withColumn("h", F.xxhash64("text")).join(F.broadcast(least), ["doc_id", "h"])
    measured = one.select(F.col("doc_id").cast("string").alias("doc_id"), "quality", "text").mapInArrow(_measured, "doc_id string, quality double, x array<double>")
    rows = measured.groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r")).select("r.quality", "r.x")
    got = sorted((r["x"], r["quality"]) for r in rows.collect())
    if not got:
        return boosting.constant(0.5)
    return boosting.train(np.array([x for x, _ in got]).reshape(len(got), -1), np.array([y for _, y in got]))


def score(docs: DataFrame, forest: boosting.Forest, text: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` with the chance of good quality, rounded to 9 digits, under ``name``.

    Null text is scored as an empty one. An empty table gives no rows. All
    columns stay; one called ``name`` is replaced.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = docs.drop(name)
    schema = StructType([*kept.schema, StructField(name, DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, text):
                p = forest.probability(statistics(piece.column(text)))
                yield pa.record_batch([*piece.columns, pa.array(np.round(p, 9))], names=[*piece.schema.names, name])

    return kept.mapInArrow(scored, schema)
