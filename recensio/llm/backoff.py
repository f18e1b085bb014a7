"""Language-model scores by a weighted backoff automaton.

Bigrams that the training texts hold at least ``MIN_COUNT`` times become arcs of
the state of their first word, with absolute discounting; every other word takes
the state's failure arc, which costs log10 of the withheld mass, to the root,
whose arcs are the add-one unigrams:

    P1(b)   = (c(b) + 1) / (N + V + 1)
    P(b|a)  = (c(ab) - D) / c(a) + f(a) P1(b)   for an arc
    P(b|a)  = f(a) P1(b)                        by the failure arc
    f(a)    = 1 - sum over arcs of (c(ab) - D) / c(a)

so that the words after any state sum to one. The automaton grows with the
corpus, so it is never in one place: each chunk of documents asks the buckets
that count words and bigrams for the arcs its own texts can take, builds that
part of the automaton and walks through its texts. With bigrams the state after
a word is that word, so numpy moves all positions of a chunk at once.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recensio.llm import arrays as A
from recensio.llm.chunks import CHUNK_BYTES, chunk_table, chunked, table_of

#: Bigrams seen less often get no arc; 1: every bigram that was seen has one.
MIN_COUNT = 1
DISCOUNT = 0.75
#: Bytes of a word's hash that are sent; its bucket says the rest.
WORD_BYTES = 7
_END, _START = np.uint64(0x51ED270B7F3A6C15), np.uint64(0xA24BAED4963EE407)

REQUEST = "to int, chunk int, part int, kind int, keys binary, counts binary, extra binary"
REPLY = "chunk int, part int, kind int, bits binary, counts binary, extra binary, tokens long, types long"
_ints = lambda *names: [(n, pa.int32()) for n in names]
_bytes = lambda *names: [(n, pa.binary()) for n in names]
_REQUEST = pa.schema(_ints("to", "chunk", "part", "kind") + _bytes("keys", "counts", "extra"))
_REPLY = pa.schema(
    _ints("chunk", "part", "kind") + _bytes("bits", "counts", "extra") + [("tokens", pa.int64()), ("types", pa.int64())]
)
_WORDS, _ARCS = 0, 1


class _Walk:
    """Tokens of a chunk with their contexts, as hashes and as places in its vocabulary and bigrams."""

    def __init__(self, table: pa.Table):
        hashes, text = A.word_hashes(table["text"], lower=True)
        texts = table.num_rows
        first, count = A.runs(text, texts)
        starts = first + np.arange(texts)
        tokens = np.empty(len(hashes) + texts, np.uint64)
        tokens[np.arange(len(hashes)) + text] = hashes
        tokens[starts + count] = _END
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]
        context[starts] = _START
        self.owner = np.repeat(np.arange(texts, dtype=np.int32), count + 1)
        self.train = table["train"].to_numpy(zero_copy_only=False).astype(bool)
        self.tokens, self.context = tokens, context

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = A.mix(self.context * np.uint64(0x9E3779B97F4A7C15) + self.tokens)
        return np.unique(pairs, return_inverse=True)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        words, place = np.unique(np.concatenate([self.tokens, [_START]]), return_inverse=True)
        return words, place[:-1]

    def trained(self, place: np.ndarray, n: int) -> np.ndarray:
        """Occurrences in training texts."""
        return np.bincount(place[self.train[self.owner]], minlength=n)


def _cut(sorted_hashes: np.ndarray, buckets: int) -> list[tuple[int, int]]:
    cut = A.slices(A.bucket_of(sorted_hashes, buckets), buckets)
    return list(zip(cut[:-1], cut[1:], strict=True))


def _ask_bigrams(buckets: int, width: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        walk = _Walk(chunk_table(table))
        pairs, place = walk.bigrams()
        counts = walk.trained(place, len(pairs))
        chunk = key[0].as_py()
        return table_of(
            [
                (b, chunk, b, _ARCS, A.pack_low(pairs[i:j], width), A.pack(counts[i:j]), None)
                for b, (i, j) in enumerate(_cut(pairs, buckets))
                if i < j
            ],
            _REQUEST,
        )

    return ask


def _count_bigrams(width: int, min_count: int):
    """Tell each chunk which of its bigrams are arcs, their counts, and which of them it has to report."""

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        keys = [A.unpack_low(r["keys"], width) for r in rows]
        _, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(place, weights=np.concatenate([A.unpack(r["counts"]) for r in rows])).astype(np.int64)
        out, j = [], 0
        for r, k in zip(rows, keys, strict=True):
            i, j = j, j + len(k)
            arc = total[place[i:j]] >= min_count
            mine = (first[place[i:j]] == np.arange(i, j))[arc]
            out.append((r["chunk"], r["part"], _ARCS, A.pack_bits(arc), A.pack(total[place[i:j]][arc]), A.pack_bits(mine), 0, 0))
        return table_of(out, _REPLY)

    return count


def _arcs(pairs: np.ndarray, replies: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Count of each bigram that is an arc, else 0, and whether this chunk reports it."""
    counts, mine = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    cut = _cut(pairs, buckets)
    for r in replies:
        if r["kind"] == _ARCS:
            i, j = cut[r["part"]]
            at = i + np.flatnonzero(A.unpack_bits(r["bits"], j - i))
            counts[at] = A.unpack(r["counts"])
            mine[at] = A.unpack_bits(r["extra"], len(at))
    return counts, mine


def _ask_words(buckets: int):
    """Count the chunk's words, and the mass and number of the arcs it reports, per state."""

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, answers = key[0].as_py(), replies.to_pylist()
        walk = _Walk(chunk_table(table))
        pairs, pair = walk.bigrams()
        count, mine = _arcs(pairs, answers, buckets)
        example = np.empty(len(pairs), np.int64)
        example[pair] = np.arange(len(pair))
        words, place = walk.words()
        state = np.searchsorted(words, walk.context[example[mine]])
        mass = np.bincount(state, weights=count[mine], minlength=len(words)).astype(np.int64)
        arcs = np.bincount(state, minlength=len(words))
        counts = walk.trained(place, len(words))
        counts[np.searchsorted(words, _START)] = walk.train.sum()
        rows = []
        for b, (i, j) in enumerate(_cut(words, buckets)):
            has = arcs[i:j] > 0
            extra = _joined([A.pack_bits(has), A.pack(mass[i:j][has]), A.pack(arcs[i:j][has])])
            rows.append((b, chunk, b, _WORDS, A.pack_low(words[i:j], WORD_BYTES), A.pack(counts[i:j]), extra))
        return table_of(rows, _REQUEST)

    return ask


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _parts(data: bytes) -> list[bytes]:
    out = []
    while data:
        n = int.from_bytes(data[:4], "little")
        out.append(data[4 : 4 + n])
        data = data[4 + n :]
    return out


def _count_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    asked, out = table.to_pylist(), []
    keys = [A.unpack_low(r["keys"], WORD_BYTES) for r in asked]
    words, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
    total, mass, arcs = (np.zeros(len(words), np.int64) for _ in range(3))
    j = 0
    for r, k in zip(asked, keys, strict=True):
        i, j = j, j + len(k)
        total[place[i:j]] += A.unpack(r["counts"])
        has, m, a = _parts(r["extra"])
        at = place[i:j][A.unpack_bits(has, len(k))]
        mass[at] += A.unpack(m)
        arcs[at] += A.unpack(a)
    real = words != A.unpack_low(A.pack_low(np.array([_START]), WORD_BYTES), WORD_BYTES)
    tokens, types = int(total[real].sum()), int((total[real] > 0).sum())
    j = 0
    for r, k in zip(asked, keys, strict=True):
        i, j = j, j + len(k)
        mine = place[i:j]
        has = arcs[mine] > 0
        spent = _joined([A.pack(mass[mine][has]), A.pack(arcs[mine][has])])
        out.append((r["chunk"], r["part"], _WORDS, A.pack_bits(has), A.pack(total[mine]), spent, tokens, types))
    return table_of(out, _REPLY)



def _score(buckets: int, discount: float, fields: pa.Schema):
    def score(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return fields.empty_table()
        rows, answers = chunk_table(table), replies.to_pylist()
        walk = _Walk(rows)
        pairs, pair = walk.bigrams()
        seen = _arcs(pairs, answers, buckets)[0][pair]
        del pairs, pair
        words, place = walk.words()
        c, failure = np.zeros(len(words), np.int64), np.ones(len(words))
        n = v = 0
        cut = _cut(words, buckets)
        for r in answers:
            if r["kind"] == _WORDS:
                i, j = cut[r["part"]]
                c[i:j] = A.unpack(r["counts"])
                has = i + np.flatnonzero(A.unpack_bits(r["bits"], j - i))
                mass, arcs = map(A.unpack, _parts(r["extra"]))
                failure[has] = 1 - (mass - discount * arcs) / c[has]
                n, v = n + r["tokens"], v + r["types"]
        unigram = (c + 1) / (n + v + 1)
        state = np.searchsorted(words, walk.context)
        p = failure[state] * unigram[place]
        arc = np.flatnonzero(seen)
        p[arc] += (seen[arc] - discount) / c[state[arc]]
        texts = rows.num_rows
        total = lambda x: np.bincount(walk.owner, weights=x, minlength=texts)
        values = {
            "n_tokens": np.bincount(walk.owner, minlength=texts),
            "n_known": total(c[place] > 0).astype(np.int64),
            "train_tokens": np.full(texts, n),
            "base_score": total(np.log10(unigram)[place]),
            "score": total(np.log10(p)),
        }
        columns = [rows["doc_id"], rows["train"]] + [pa.array(x, fields.field(name).type) for name, x in values.items()]
        return pa.table(columns, schema=fields)

    return score


def score_texts(
    docs: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    min_count: int = MIN_COUNT,
    discount: float = DISCOUNT,
) -> DataFrame:
    """``(doc_id, train, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    ``train`` says which rows the model learns from (null: not). Tokens are the
    lower-cased words and one end per text; null text is empty and has the end
    only. Ids may be of any type. Repeated rows count as often as they occur. Rows without id are
    scored like others. An empty table gives no rows; without training rows
    every word is unknown. Other columns are ignored. Words are told apart by
    64-bit hashes, bigrams by so many bits that fewer than one in 2^28 is
    taken for another.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.col(text).cast("string").alias("text"),
    )
    # no rule ties rows of an id together, so one with very many rows is spread by their texts
    dealt, buckets = chunked(rows, "doc_id", "text", spread=F.xxhash64("doc_id", "text"))
    width = min(8, ceil((log2(buckets * CHUNK_BYTES / 4) + 28 - log2(buckets)) / 8))
    docs_of = lambda: dealt.groupBy("chunk")
    to = lambda df: df.repartition(buckets, "to").groupBy("to")
    arcs = to(docs_of().applyInArrow(_ask_bigrams(buckets, width), REQUEST)).applyInArrow(_count_bigrams(width, min_count), REPLY)
    asked = docs_of().cogroup(arcs.groupBy("chunk")).applyInArrow(_ask_words(buckets), REQUEST)
    replies = to(asked).applyInArrow(_count_words, REPLY).unionByName(arcs)
    kinds = [("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double")]
    fields = pa.schema(
        [("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("train", pa.bool_())] + [(n, pa.int64() if t == "long" else pa.float64()) for n, t in kinds]
    )
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, train boolean, " + ", ".join(f"{n} {t}" for n, t in kinds)
    return docs_of().cogroup(replies.groupBy("chunk")).applyInArrow(_score(buckets, discount, fields), schema)
