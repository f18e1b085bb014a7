"""Language identification by a convolutional network over bytes, in numpy.

Bytes are embedded, filters of widths two to four slide over windows of fixed
length, the largest response of each filter is kept, and a softmax layer names
the language. A text is judged by all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recensio.llm import arrays as A
from recensio.llm.names import free_names

WINDOW = 256
#: Texts per language, and windows of each, that the network is fitted on, at most.
TRAIN_TEXTS, TRAIN_WINDOWS = 600, 6
_SIZE, _WIDTHS, _FILTERS = 8, (2, 3, 4), 16
_BATCH = 96


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray  # 256 x _SIZE
    filters: np.ndarray  # 4 * _SIZE x 48; narrow filters end in zeros
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def _responses(self, windows: np.ndarray) -> np.ndarray:
        """Responses at every position of ``n x WINDOW`` bytes, before bias."""
        n, length = windows.shape
        wide = max(_WIDTHS)
        e = np.zeros((n, length + wide - 1, _SIZE), np.float32)
        e[:, :length] = self.embed[windows]
        patches = np.lib.stride_tricks.as_strided(e, (n, length, wide * _SIZE), (e.strides[0], e.strides[1], e.strides[2]))
        return (np.ascontiguousarray(patches).reshape(n * length, -1) @ self.filters).reshape(n, length, -1)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(windows), _BATCH):
            top = self._responses(windows[i : i + _BATCH]).max(axis=1)
            parts.append(np.maximum(top + self.bias, 0) @ self.out + self.out_bias)
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)


def _mask() -> np.ndarray:
    mask = np.zeros((max(_WIDTHS) * _SIZE, _FILTERS * len(_WIDTHS)), np.float32)
    for k, width in enumerate(_WIDTHS):
        mask[: width * _SIZE, k * _FILTERS : (k + 1) * _FILTERS] = 1
    return mask


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = 6, rate: float = 3e-3, seed: int = 7) -> Net:
    """Fit by Adam on shuffled batches; the gradient flows through each filter's best position only."""
    rng = np.random.default_rng(seed)
    mask = _mask()
    f32 = np.float32
    net = Net(
        langs,
        rng.normal(0, 0.5, (256, _SIZE)).astype(f32),
        rng.normal(0, 0.25, mask.shape).astype(f32) * mask,
        np.zeros(mask.shape[1], f32),
        rng.normal(0, 0.2, (mask.shape[1], len(langs))).astype(f32),
        np.zeros(len(langs), f32),
    )
    net.embed[0] = 0  # padding
    names = ("embed", "filters", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, wide = 0, max(_WIDTHS)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), _BATCH):
            x, y = windows[order[i : i + _BATCH]], labels[order[i : i + _BATCH]]
            n = len(x)
            responses = net._responses(x)
            at = responses.argmax(axis=1)
            pre = np.take_along_axis(responses, at[:, None, :], axis=1)[:, 0] + net.bias
            pooled = np.maximum(pre, 0)
            z = pooled @ net.out + net.out_bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            down = (p @ net.out.T) * (pre > 0)
            padded = np.concatenate([x, np.zeros((n, wide - 1), x.dtype)], axis=1)
            seen = padded[np.arange(n)[:, None, None], at[:, :, None] + np.arange(wide)]  # n x filters x width
            patch = net.embed[seen].reshape(n, -1, wide * _SIZE)
            back = down[:, :, None] * net.filters.T[None]
            to_embed = np.zeros_like(net.embed)
            np.add.at(to_embed, seen.ravel(), back.reshape(-1, _SIZE))
            to_embed[0] = 0
            gradients = {
                "embed": to_embed,
                "filters": np.einsum("nfk,nf->kf", patch, down) * mask,
                "bias": down.sum(axis=0),
                "out": pooled.T @ p,
                "out_bias": p.sum(axis=0),
            }
            step += 1
            for k, g in gradients.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(net, k, (getattr(net, k) - scale * first[k] / (np.sqrt(second[k]) + 1e-7)).astype(f32))
    return net


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, padded with zeros; their text and number of bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[text] + number * WINDOW
    used = np.minimum(WINDOW, offsets[text + 1] - begin)
    place = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    out = np.where(inside, data[np.minimum(place, max(len(data) - 1, 0))], np.uint8(0)) if len(text) else np.zeros((0, WINDOW), np.uint8)
    return out, text, used


def _sampled(most: int):
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, "text"):
                windows, text, _ = _windows(*A.text_bytes(piece.column("text")))
                first, count = A.runs(text, piece.num_rows)
                keep = np.zeros(len(text), bool)
                for i, n in zip(first, count, strict=True):
                    keep[i + np.unique(np.linspace(0, n - 1, min(n, most)).astype(int))] = n > 0
                langs = piece.column("lang").take(pa.array(text[keep]))
                yield pa.record_batch([langs, pa.array([w.tobytes() for w in windows[keep]], pa.binary())], names=["lang", "window"])

    return sampled


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", most: int = TRAIN_TEXTS) -> Net | None:
    """Network for the languages in ``lang``; None if no row has a language and a text.

    At most ``most`` different texts of each language are used, those with the smallest hashes; a
    text counts once however many rows hold it, so the bound holds for what reaches the driver.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0)).withColumn("h", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy("h")
    taken = rows.select("lang", "h").distinct().withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth")
    langs = sorted(r["lang"] for r in taken.select("lang").distinct().collect())
    if not langs:
        return None
    sample = rows.join(F.broadcast(taken), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")
    got = sorted((r["window"], r["lang"]) for r in sample.mapInArrow(_sampled(TRAIN_WINDOWS), "lang string, window binary").collect())
    windows = np.frombuffer(b"".join(bytes(w) for w, _ in got), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([langs.index(x) for _, x in got]), langs)


def predict(docs: DataFrame, net: Net | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, the chance of that language to four digits (the sixth depends on which texts share a batch).

    Null texts and texts without a letter are "und" with score 0, and so are all
    without a network. Windows of a text weigh by their bytes. An empty table
    gives no rows, a repeated row one each, and texts may be of any length (they are read piece by piece).
    Other columns stay; ones with these names are replaced.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    kept = docs.drop("lang_pred", "lang_score")
    names = kept.columns
    (mark,) = free_names(names, "_lettered")
    kept = kept.withColumn(mark, F.coalesce(F.col(text).cast("string").rlike("\\p{L}"), F.lit(False)))
    schema = StructType([*kept.drop(mark).schema, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, text, 1 << 20):
                n = piece.num_rows
                lettered = piece.column(mark).to_numpy(zero_copy_only=False).astype(bool)
                name, score = np.full(n, "und", object), np.zeros(n)
                if net is not None:
                    windows, owner, used = _windows(*A.text_bytes(piece.column(text)))
                    z = net.logits(windows).astype(np.float64)
                    size = np.maximum(np.bincount(owner, weights=used, minlength=n), 1)
                    mean = np.stack([np.bincount(owner, weights=z[:, k] * used, minlength=n) / size for k in range(z.shape[1])], axis=1)
                    p = np.exp(mean - mean.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    name = np.where(lettered, np.array(net.langs, object)[p.argmax(axis=1)], "und")
                    score = np.where(lettered, p.max(axis=1), 0.0)
                columns = [piece.column(c) for c in names] + [pa.array(name, pa.string()), pa.array(np.round(score, 4))]
                yield pa.record_batch(columns, names=[*names, "lang_pred", "lang_score"])

    return kept.mapInArrow(predicted, schema)
