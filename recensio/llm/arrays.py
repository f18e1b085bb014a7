"""Texts of an Arrow column as numpy arrays: words, hashes, packed integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that end a word of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a word of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
MARKS = np.zeros(256, bool)
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection in which every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the offsets where they begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray = SPACES):
    """Where each word begins and ends, and the number of its text."""
    inside = ~ends_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    previous = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    following = np.concatenate([inside[1:], [False]]) if len(data) else inside
    begins = np.flatnonzero(inside & (~previous | first[:-1]))
    ends = np.flatnonzero(inside & (~following | first[1:])) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, _SEGMENT + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``data[begin:end]``; the spans are in order and apart.

    Sums of byte values times powers of an odd base, taken segment by segment,
    so that memory does not grow with the number of bytes.
    """
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        at = begins[i]
        j = max(i + 1, int(np.searchsorted(begins, at + _SEGMENT)))
        piece = data[at : ends[j - 1]]
        up, down = _powers_to(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTES[piece] * up[:-1], out=sums[1:])
        b, e = begins[i:j] - at, ends[i:j] - at
        out[i:j] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        i = j
    return out


def runs(text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of every text."""
    count = np.bincount(text, minlength=texts)
    return np.cumsum(count) - count, count


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the caller drops those that cross texts."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:size].copy()
    for k in range(1, n):
        total *= np.uint64(_BASE)
        total += hashes[k : k + size]
    return mix(total)


def shingles(hashes: np.ndarray, text: np.ndarray, texts: int, n: int):
    """Hashes of n-word shingles and their texts; a shorter text is one shingle."""
    first, count = runs(text, texts)
    grams = gram_hashes(hashes, n)
    whole = (text[: len(grams)] == text[n - 1 :]) if len(grams) else np.zeros(0, bool)
    values, owners = grams[whole], text[: len(grams)][whole]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        few = np.zeros(len(short), np.uint64)
        for k in range(n):
            has = count[short] > k
            few[has] = few[has] * np.uint64(_BASE) + hashes[first[short[has]] + k]
        values = np.concatenate([values, mix(few + np.uint64(1))])
        owners = np.concatenate([owners, short])
        order = np.argsort(owners, kind="stable")
        values, owners = values[order], owners[order]
    return values, owners


def word_hashes(column, ends_word: np.ndarray = SPACES, lower: bool = False):
    """Hash and text number of every word of a text column."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    begins, ends, text = words(data, offsets, ends_word)
    return span_hashes(data, begins, ends), text


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in one byte each; those of 255 and more follow in eight."""
    values = np.asarray(values)
    over = values[values >= 255].astype("<i8")
    return len(over).to_bytes(8, "little") + np.minimum(values, 255).astype(np.uint8).tobytes() + over.tobytes()


def unpack(data: bytes) -> np.ndarray:
    over = int.from_bytes(data[:8], "little")
    out = np.frombuffer(data, np.uint8, len(data) - 8 - 8 * over, 8).astype(np.int64)
    if over:
        out[out == 255] = np.frombuffer(data, "<i8", over, len(data) - 8 * over)
    return out


def pack_bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def pack_low(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_low(data: bytes, width: int) -> np.ndarray:
    narrow = np.frombuffer(data, np.uint8).reshape(-1, width)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :width] = narrow
    return wide.view("<u8").ravel()


def slices(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket in values sorted by bucket."""
    return np.searchsorted(bucket, np.arange(buckets + 1))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space, so that sorted hashes are in bucket order."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def pieces(batch: pa.RecordBatch, column: str, size: int = 2 << 20):
    """Slices of consecutive rows with about ``size`` bytes of text each, a longer text alone."""
    _, offsets = text_bytes(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
