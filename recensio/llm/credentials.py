"""Scan texts for secrets: fixed patterns, and strings that look random to character Markov models."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.llm import arrays as A

# Fixed patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")

#: Characters of a candidate, and its least length.
_CANDIDATE = np.ones(256, bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = False
LEAST = 16
#: A candidate is random if the models differ by so much in all, and by so much per character (natural logarithms).
TOTAL, EACH = 12.0, 0.6
#: Texts, and words of each, that the model of ordinary identifiers is fitted on, at most.
TRAIN_TEXTS, TRAIN_WORDS = 2_000, 50

_PRINTABLE = 128
#: Words of usual names in code, paths and addresses.
COMMON = (
    "the and for with from this that by id is has to of on in at name value count index file path table user usr local lib bin var home state order item list "
    "number python java site packages package module class function method object string array map set get put post http https www "
    "com org net example mail image page html json text data date time year month day test config default version release system "
    "service server client request response error message event account address payment report element document window button"
).split()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns in code points, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_strings(n: int = 3_000, seed: int = 11) -> list[str]:
    """Labelled samples of the random class: keys over the usual alphabets."""
    rng = random.Random(seed)
    small, large, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [small + large + digits, small + large + digits + "+/", small + large + digits + "-_", small + digits, large + digits, "0123456789abcdef"]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))) for _ in range(n)]


def _identifiers(words: list[str], seed: int = 13) -> list[str]:
    """Labelled samples of the ordinary class: words, and names joined from them in the usual ways."""
    rng = random.Random(seed)
    out = list(words)
    for w in words:
        others = rng.choices(words, k=rng.randint(1, 3))
        parts = [w, *others]
        style = rng.randrange(5)
        if style == 0:
            out.append("_".join(p.lower() for p in parts))
        elif style == 1:
            out.append("-".join(p.lower() for p in parts))
        elif style == 2:
            out.append(parts[0].lower() + "".join(p.capitalize() for p in parts[1:]))
        elif style == 3:
            out.append("_".join(p.upper() for p in parts))
        else:
            out.append("/".join(parts) + rng.choice(["", str(rng.randrange(2030))]))
        if rng.random() < 0.2:  # dates, rulers and plain numbers
            day = f"{rng.randint(1990, 2035)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
            clock = f"{rng.randint(0, 23):02}-{rng.randint(0, 59):02}-{rng.randint(0, 59):02}"
            out += [f"{day}-{clock}", rng.choice("-=_/+") * rng.randint(16, 60), str(rng.randrange(10**15, 10**19))]
    return out


def _logs(samples: list[str]) -> np.ndarray:
    """Log probabilities of each character after each other; 0 stands before the first."""
    counts = np.full((_PRINTABLE, _PRINTABLE), 0.05)
    for s in samples:
        codes = np.frombuffer(s.encode("ascii", "ignore"), np.uint8)
        np.add.at(counts, (np.concatenate([[0], codes[:-1]]), codes), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def train(words: list[str]) -> np.ndarray:
    """Table of log-likelihood ratios, random over ordinary, for each pair of characters.

    ``COMMON`` words are always among the ordinary ones.
    """
    words = words + COMMON * (1 + len(words) // 200)
    return _logs(random_strings()) - _logs(_identifiers(words))


def _some_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words: list[str] = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            for start, _, end in reversed(spans):
                text = text[:start] + " " + text[end:]
            some = re.findall(r"[A-Za-z]{2,}", text)
            step = max(1, len(some) // TRAIN_WORDS)
            words += some[::step][:TRAIN_WORDS]
        yield pa.record_batch([pa.array(words, pa.string())], names=["word"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = TRAIN_TEXTS) -> np.ndarray:
    """Fit on words of at most ``most`` different texts, those with the smallest hashes; what the fixed patterns match is left out.

    A text counts once however many rows hold it, so ``most`` bounds what reaches the driver.
    """
    rows = docs.filter(F.col(text).isNotNull()).select(F.xxhash64(F.col(text).cast("string")).alias("h"), F.col(text).cast("string").alias("text"))
    taken = rows.select("h").distinct().orderBy("h").limit(most)
    sample = rows.join(F.broadcast(taken), "h").groupBy("h").agg(F.min("text").alias("text")).select("text")
    return train(sorted(r["word"] for r in sample.mapInArrow(_some_words, "word string").collect()))


#: Per character, what a segment's sum is lessened by while its bounds are sought: the greatest sum first, then denser segments.
_LESS = (0.0, EACH / 2, EACH)
#: A segment that begins or ends inside a word must score so much more for each such bound.
SWITCH = 4.0
_JOINTS = np.zeros(256, bool)
_JOINTS[list(b"+/_=-")] = True


def _segment(score: np.ndarray) -> tuple[float, int, int]:
    """Sum and bounds of the segment of at least LEAST characters with the greatest sum."""
    upto = np.concatenate([[0.0], np.cumsum(score)])
    gain = upto[LEAST:] - np.minimum.accumulate(upto[:-LEAST])
    end = int(np.argmax(gain))
    begin = int(np.argmin(upto[: end + 1]))
    return float(gain[end]), begin, end + LEAST


def _segments(score: np.ndarray, joint: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the parts of a run that look random: its best segments, one after another.

    A segment is widened to the joints (``+/_=-``) around it, and must look
    random so widened, or by SWITCH more as it is. What it leaves of a run that
    looks random as a whole stays with it unless it is clearly ordinary.
    """
    found, todo = [], [(0, len(score))]
    random_ = lambda x, size: x >= TOTAL and x >= EACH * size
    while todo:
        i, j = todo.pop()
        if j - i < LEAST:
            continue
        here = score[i:j]
        whole = random_(here.sum(), j - i)
        for less in _LESS:
            _, b, e = _segment(here - less)
            left, right = np.flatnonzero(joint[i : i + b]), np.flatnonzero(joint[i + e : j])
            begin, end = int(left[-1]) + 1 if len(left) else 0, e + int(right[0]) if len(right) else j - i
            inside = SWITCH * (int(begin < b) + int(e < end))
            if whole:
                begin = begin if here[:begin].sum() <= -TOTAL else 0
                end = end if here[end:].sum() <= -TOTAL else j - i
            if whole or random_(here[begin:end].sum(), end - begin) or random_(here[b:e].sum() - inside, e - b):
                found.append((i + begin, i + end))
                todo += [(i, i + begin), (i + end, j)]
                break
    return sorted(found)


def random_spans(
    data: np.ndarray, offsets: np.ndarray, ratio: np.ndarray, apart: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end (in code points) of what looks random in the candidates; ``apart`` are such spans to cut out first."""
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    if apart is not None and len(apart[0]):
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        base = points[offsets[apart[0]]]
        data = data.copy()
        for b, e in zip(place[base + apart[1]].tolist(), place[base + apart[2]].tolist(), strict=True):
            data[b:e] = 0x20
    begins, ends, text = A.words(data, offsets, _CANDIDATE)
    long = ends - begins >= LEAST
    begins, ends, text = begins[long], ends[long], text[long]
    if not len(begins):
        return text, begins, ends
    codes = np.minimum(data, _PRINTABLE - 1).astype(np.int64)
    before = np.concatenate([[0], codes[:-1]])
    size = ends - begins
    starts = np.cumsum(size) - size
    place = np.repeat(begins - starts, size) + np.arange(size.sum())
    previous = before[place]
    previous[starts] = 0
    score = ratio[previous, codes[place]]
    # only runs whose best sum of positive ratios is high enough can hold a segment
    may = np.flatnonzero(np.add.reduceat(np.maximum(score, 0), starts) >= TOTAL)
    out = []
    for k in may.tolist():
        i, j = starts[k], starts[k] + size[k]
        out += [(text[k], begins[k] + b, begins[k] + e) for b, e in _segments(score[i:j], _JOINTS[data[begins[k] : ends[k]]])]
    text, begins, ends = np.array(out, np.int64).reshape(-1, 3).T
    base = points[offsets[text]]
    return text, points[begins] - base, points[ends] - base


SCANNED = "spans array<struct<kind:string,begin:int,end:int,base:boolean>>"


def scan(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, spans)``, one row per row of ``docs``; ``base`` marks spans of the fixed patterns.

    Spans are in code points, by start, then in the order of ``KINDS``. Random
    strings are sought in what the fixed spans leave of a text. Null text has none. Ids may be of any type,
    texts of any length (they are scanned piece by piece), and each repeated row has its own. An empty
    table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    span = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in A.pieces(batch, "text"):
                found = [base_spans(t) for t in piece.column("text").to_pylist()]
                fixed = np.array([(t, b, e) for t, f in enumerate(found) for b, _, e in f], np.int64).reshape(-1, 3).T
                owner, begins, ends = random_spans(*A.text_bytes(piece.column("text")), ratio, tuple(fixed))
                for t, b, e in zip(owner.tolist(), begins.tolist(), ends.tolist(), strict=True):
                    found[t].append((b, 3, e))
                out = [[{"kind": KINDS[k], "begin": b, "end": e, "base": k < 3} for b, k, e in sorted(f)] for f in found]
                yield pa.record_batch([piece.column("doc_id"), pa.array(out, pa.list_(span))], names=["doc_id", "spans"])

    return rows.mapInArrow(scanned, f"doc_id {dict(rows.dtypes)['doc_id']}, {SCANNED}")
