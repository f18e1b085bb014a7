"""The pipeline's stages, each on what its predecessor kept, against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recensio.llm import quality
from recensio.session import materialize

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows before the first stage and after each one."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF_DIR)))
    return out


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "mixing sources",
        "sharding",
    ]
    assert all(df.columns == kept[0].columns for df in kept[:-1])


def test_quality_stage(spark, kept):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    forest = quality.fit(kept[0], labels.filter(fold != 2))
    rows = kept[0].collect()
    p = forest.probability(quality.statistics(pa.array([r["text"] for r in rows])))
    assert ids(kept[1]) == sorted(r["doc_id"] for r, x in zip(rows, p, strict=True) if round(x, 9) >= 0.7)
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    stay = set(ids(kept[1]))
    wrong = [d for d, q in marked.items() if (d in stay) != bool(q)]
    assert len(wrong) <= 0.02 * len(marked)


def test_jaccard_stage(kept):
    rows = {r["doc_id"]: r["text"] for r in kept[1].collect()}
    sets = {}
    for d, t in rows.items():
        w = plain_words(t)
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    home = {d: d for d in rows}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    postings = {}
    for d, s in sets.items():
        for g in s or ():
            postings.setdefault(g, []).append(d)
    pairs = Counter((a, b) for p in postings.values() for a in p for b in p if a < b)
    for (a, b), n in pairs.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            home[high] = low
    assert ids(kept[2]) == sorted(d for d in rows if root(d) == d)


def test_decontamination_stage(spark, kept):
    grams = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = plain_words(r["text"] or "")
        grams |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(g) for g in grams}

    def leaks(text):
        w = plain_words(text)
        return any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1))

    assert ids(kept[3]) == sorted(r["doc_id"] for r in kept[2].collect() if not leaks(r["text"]))
    assert kept[3].count() < kept[2].count()


def test_mixing_stage(kept):
    import hashlib

    rows = kept[3].collect()
    cell, size = {}, {}
    for r in rows:
        t = r["text"]
        n = len(t)
        topic = "table" if " | " in t else "licence" if "icens" in t else "short" if n < 1000 else "medium" if n < 4000 else "long"
        cell[r["doc_id"]] = (r["source"], r["lang"], topic)
        size[r["doc_id"]] = len(re.findall(r"[^\x20\x09-\x0D]+", t))
    mass = Counter()
    for d, c in cell.items():
        mass[c] += size[d]
    total = sum(mass.values())
    weight = {c: float(m) for c, m in mass.items() if m}
    target = []
    for k in range(3):
        own = Counter()
        for c, m in mass.items():
            own[c[k]] += m
        raised = {x: (m / total) ** 0.7 for x, m in own.items() if m}
        target.append({x: v / sum(raised.values()) for x, v in raised.items()})
    for _ in range(80):
        for k in range(3):
            own = Counter()
            for c, w in weight.items():
                own[c[k]] += w
            weight = {c: w * target[k][c[k]] / own[c[k]] for c, w in weight.items()}
    ratio = {c: w * total / mass[c] for c, w in weight.items()}
    top = max(ratio.values())
    draw = lambda d: int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:8], 16) / 2**32
    assert ids(kept[4]) == sorted(d for d in cell if size[d] and draw(d) < ratio[cell[d]] / top)


def test_sharding_stage(kept):
    rows = kept[5].collect()
    assert sorted(r["doc_id"] for r in rows) == ids(kept[4])
    count = np.bincount([r["shard"] for r in rows], minlength=8)
    assert count.max() - count.min() <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(count[s]))
