"""Remove passages that an earlier document holds, by seeding and extending.

Seeds: of every window of ``length`` words the smallest hash of its ``seed``-word
grams is an anchor (winnowing), so equal windows have equal anchors, and about a
fifth of all grams is sent around. Buckets of the hash space tell each chunk of
documents which of its anchors another document holds too. Around these anchors
only, matches are extended to both sides: each window that was seeded by a shared
anchor is compared, as a hash, with the windows of all other documents. Next to
each other they form the maximal repeats, whose words go unless the document is
the first that holds the window.

A passage in a third of all documents costs each chunk one hash per window, and
no pairs of documents are ever listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.llm import arrays as A
from recensio.llm.chunks import chunk_table, chunked, table_of
from recensio.llm.names import on_numbers

LENGTH = 13
SEED = 5

REQUEST = "to int, chunk int, part int, kind int, keys binary, extra binary"
REPLY = "chunk int, part int, kind int, bits binary"
_REQUEST = pa.schema(
    [("to", pa.int32()), ("chunk", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary())]
)
_REPLY = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("bits", pa.binary())])
_ANCHORS, _WINDOWS = 0, 1


class _Chunk:
    """Words, windows and anchors of the documents of a chunk."""

    def __init__(self, table: pa.Table, length: int, seed: int):
        self.data, self.offsets = A.text_bytes(table["text"])
        self.begins, self.ends, self.text = A.words(self.data, self.offsets)
        self.ids = table["doc_id"].fill_null(-(2**63)).to_numpy()
        known = np.asarray(table["doc_id"].is_valid())
        hashes = A.span_hashes(self.data, self.begins, self.ends)
        size = max(0, len(hashes) - length + 1)
        inside = self.text[:size] == self.text[length - 1 :][:size]
        inside &= known[self.text[:size]]
        self.windows = np.flatnonzero(inside)  # first word of each
        self.window_hash = A.gram_hashes(hashes, length)[self.windows]
        grams = A.gram_hashes(hashes, seed)
        best, at = grams[self.windows], self.windows.copy()
        for k in range(1, length - seed + 1):
            other = grams[self.windows + k]
            less = other <= best
            best = np.where(less, other, best)
            at[less] = self.windows[less] + k
        self.anchors, self.anchor = np.unique(best, return_inverse=True)
        self.owner = self.ids[self.text[self.windows]]


def _shared_here(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Which of n values have two different owners."""
    low, high = np.full(n, 2**63 - 1), np.full(n, -(2**63))
    np.minimum.at(low, values, owner)
    np.maximum.at(high, values, owner)
    return low < high


def _ask_anchors(length: int, seed: int, buckets: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        c = _Chunk(chunk_table(table), length, seed)
        both = _shared_here(c.anchor, c.owner, len(c.anchors))
        cut = A.slices(A.bucket_of(c.anchors, buckets), buckets)
        return table_of(
            [
                (b, key[0].as_py(), b, _ANCHORS, c.anchors[i:j].tobytes(), A.pack_bits(both[i:j]))
                for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False))
                if i < j
            ],
            _REQUEST,
        )

    return ask


def _gather(rows):
    """The keys of all requests, each key's number, and the bounds of the requests."""
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    values, place = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])
    return values, place, [(e - len(k), e) for k, e in zip(keys, ends, strict=True)]


def _share_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    values, place, bounds = _gather(rows)
    shared = np.bincount(place, minlength=len(values)) > 1
    for r, (i, j) in zip(rows, bounds, strict=True):
        shared[place[i:j][A.unpack_bits(r["extra"], j - i)]] = True
    return table_of([(r["chunk"], r["part"], _ANCHORS, A.pack_bits(shared[place[i:j]])) for r, (i, j) in zip(rows, bounds, strict=True)], _REPLY)


def _extended(c: _Chunk, replies: list[dict], buckets: int):
    """The different windows around shared anchors, sorted, and which window is which."""
    shared = np.zeros(len(c.anchors), bool)
    cut = A.slices(A.bucket_of(c.anchors, buckets), buckets)
    for r in replies:
        if r["kind"] == _ANCHORS:
            i, j = cut[r["part"]], cut[r["part"] + 1]
            shared[i:j] = A.unpack_bits(r["bits"], j - i)
    around = np.flatnonzero(shared[c.anchor])
    values, place = np.unique(c.window_hash[around], return_inverse=True)
    least = np.full(len(values), 2**63 - 1)
    np.minimum.at(least, place, c.owner[around])
    return around, values, place, least


def _ask_windows(length: int, seed: int, buckets: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        answers, chunk = replies.to_pylist(), key[0].as_py()
        # answers on anchors go along to the last pass, so that one exchange brings both kinds to the chunk
        rows = [(r["part"], chunk, r["part"], _ANCHORS, r["bits"], None) for r in answers]
        if table.num_rows:
            _, values, _, least = _extended(_Chunk(chunk_table(table), length, seed), answers, buckets)
            cut = A.slices(A.bucket_of(values, buckets), buckets)
            rows += [
                (b, chunk, b, _WINDOWS, values[i:j].tobytes(), least[i:j].tobytes())
                for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False))
                if i < j
            ]
        return table_of(rows, _REQUEST)

    return ask


def _first_owners(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    out = [(r["chunk"], r["part"], _ANCHORS, r["keys"]) for r in rows if r["kind"] == _ANCHORS]
    rows = [r for r in rows if r["kind"] == _WINDOWS]
    if rows:
        values, place, bounds = _gather(rows)
        owner = np.concatenate([np.frombuffer(r["extra"], np.int64) for r in rows])
        least = np.full(len(values), 2**63 - 1)
        np.minimum.at(least, place, owner)
        earlier = least[place] < owner
        out += [(r["chunk"], r["part"], _WINDOWS, A.pack_bits(earlier[i:j])) for r, (i, j) in zip(rows, bounds, strict=True)]
    return table_of(out, _REPLY)


def _remove(length: int, seed: int, buckets: int, fields: pa.Schema):
    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return fields.empty_table()
        answers = replies.to_pylist()
        rows = chunk_table(table)
        c = _Chunk(rows, length, seed)
        around, values, place, least = _extended(c, answers, buckets)
        elsewhere = np.zeros(len(values), bool)
        cut = A.slices(A.bucket_of(values, buckets), buckets)
        for r in answers:
            if r["kind"] == _WINDOWS:
                i, j = cut[r["part"]], cut[r["part"] + 1]
                elsewhere[i:j] = A.unpack_bits(r["bits"], j - i)
        later = elsewhere[place] | (least[place] < c.owner[around])
        begins = c.windows[around[later]]
        edge = np.zeros(len(c.begins) + 1, np.int64)
        np.add.at(edge, begins, 1)
        np.add.at(edge, begins + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        return _answer(c, gone, rows, fields)

    return remove


def _answer(c: _Chunk, gone: np.ndarray, table: pa.Table, fields: pa.Schema) -> pa.Table:
    texts = table.num_rows
    first, count = A.runs(c.text, texts)
    removed = np.bincount(c.text[gone], minlength=texts)
    # maximal runs of removed words, counted within their document
    joined = gone[1:] & gone[:-1] & (c.text[1:] == c.text[:-1])
    opens = np.flatnonzero(gone & ~np.concatenate([[False], joined])[: len(gone)])
    closes = np.flatnonzero(gone & ~np.concatenate([joined, [False]])[: len(gone)])
    owner = c.text[opens]
    spans = pa.StructArray.from_arrays(
        [pa.array(opens - first[owner], pa.int32()), pa.array(closes + 1 - first[owner], pa.int32())], names=["begin", "end"]
    )
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
    # kept words and the one byte after each but the last of a document
    kept = np.flatnonzero(~gone)
    last = np.concatenate([c.text[kept][1:] != c.text[kept][:-1], [True]])[: len(kept)]
    edge = np.zeros(len(c.data) + 1, np.int8)
    edge[c.begins[kept]] += 1
    edge[c.ends[kept]] -= 1
    take = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    take[c.ends[kept[~last]]] = True
    data = np.where(A.SPACES[c.data], np.uint8(0x20), c.data)[take]
    offsets = np.concatenate([[0], np.cumsum(take)])[c.offsets].astype(np.int64)
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), texts, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    columns = [
        table["doc_id"],
        pa.array(count, pa.int64()),
        pa.array(removed, pa.int64()),
        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans),
        text.cast(pa.large_string()).cast(pa.string()),
    ]
    return pa.table([x.cast(f.type) if x.type != f.type else x for x, f in zip(columns, fields, strict=True)], schema=fields)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """``(doc_id, n_words, n_removed, removed, kept_text)``, one row per row of ``docs``.

    ``removed`` holds the maximal removed runs as word positions; ``kept_text``
    the kept words joined by one space. Words are runs of bytes other than
    white space; null text has none. A word goes if a window of ``length``
    words of its document covers it and a document with a smaller id holds the
    same window (ids may be of any type that sorts). Rows that share an id are one document, and none is earlier
    than another: all keep the same. Rows without id are left whole and make
    no other row lose words. Windows are compared by 64-bit hashes. An empty
    table gives no rows. Other columns are ignored.
    """
    return on_numbers(docs, doc_id, text, lambda rows: _without_repeats(rows, length, seed))


def _without_repeats(rows: DataFrame, length: int, seed: int) -> DataFrame:
    dealt, buckets = chunked(rows, "doc_id", "text")
    groups = lambda: dealt.groupBy("chunk")
    to = lambda df: df.repartition(buckets, "to").groupBy("to")
    anchors = to(groups().applyInArrow(_ask_anchors(length, seed, buckets), REQUEST)).applyInArrow(_share_anchors, REPLY)
    asked = groups().cogroup(anchors.groupBy("chunk")).applyInArrow(_ask_windows(length, seed, buckets), REQUEST)
    replies = to(asked).applyInArrow(_first_owners, REPLY)
    span = pa.struct([pa.field("begin", pa.int32()), pa.field("end", pa.int32())])
    fields = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(span)), ("kept_text", pa.string())]
    )
    schema = "doc_id long, n_words long, n_removed long, removed array<struct<begin:int,end:int>>, kept_text string"
    return groups().cogroup(replies.groupBy("chunk")).applyInArrow(_remove(length, seed, buckets, fields), schema)
