"""Centroids, hard negatives and SimHash components against plain Python."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from recensio.llm import centroids, negatives, simhash
from recensio.llm.ship import ship

ROW = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


# ---- centroids


def test_coefficients_keep_distances_and_can_be_undone():
    rng = np.random.default_rng(1)
    x = rng.integers(-5000, 5000, (50, 64))
    t = centroids.transform(x)
    assert (np.square(t[1:] - t[:-1]).sum(1) == 64 * np.square(x[1:] - x[:-1]).sum(1)).all()
    assert centroids.restore(t[0].tolist()) == x[0].tolist()
    huge = [int(v) * 10**25 for v in t[1]]
    assert centroids.restore(huge) == [int(v) * 10**25 for v in x[1]]
    assert sorted(centroids.ORDER) == list(range(64)) and (t[:, 0] == x.sum(1)).all()


def test_nearest_is_exact_with_ties_at_every_stage():
    rng = np.random.default_rng(2)
    for spread in (1, 4, 1000):
        x, c = rng.integers(-spread, spread + 1, (400, 64)), rng.integers(-spread, spread + 1, (8, 64))
        c[5], c[6] = c[2], c[2]
        x[:40] = c[rng.integers(0, 8, 40)]
        got, distance = centroids.nearest(centroids.transform(x), centroids.transform(c))
        all_of = np.square(x[:, None, :] - c[None, :, :]).sum(2)
        assert (got == all_of.argmin(1)).all() and (distance == all_of.min(1)).all()


def plain_clusters(rows, clusters=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    code = lambda i: (i is None, "" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest())
    first = [v for _, v in sorted(((code(i), v) for i, v in kept), key=lambda r: r[0])[:clusters]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(first)) for _, v in kept]
    for _ in range(rounds):
        at = assign()
        for j in range(len(first)):
            own = [v for (_, v), (_, k) in zip(kept, at, strict=True) if k == j]
            if own:
                first[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = assign()
    total, part = sum(d for d, _ in at), {j: sum(d for d, k in at if k == j) for j in range(len(first))}
    return sorted((str(i), j, d, part[j], total, tuple(first[j])) for (i, _), (d, j) in zip(kept, at, strict=True))


def vectors(n, seed=3, dims=64):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dims)).astype(np.float32)
    return [[float(v) for v in row] for row in x]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_clusters_against_plain_python(shipped, kind):
    rows = list(enumerate(vectors(60)))
    rows += [(i, rows[3][1]) for i in range(100, 140)]  # one vector in very many rows
    rows += [(7, rows[7][1]), (200, None), (201, []), (202, [0.1] * 63), (203, [None] + [0.1] * 63), (204, [float("nan")] * 64), (205, [float("-inf")] * 64), (None, rows[5][1])]
    if kind == "string":
        rows = [(None if i is None else f"v{i}", v) for i, v in rows]
    df = shipped.createDataFrame(rows, f"vec_id {kind}, embedding array<float>").withColumns({c: F.lit("x") for c in ("id", "v", "cluster", "coefficients", "centroid")})
    got = centroids.cluster_vectors(df).collect()
    assert sorted((str(r[0]), *r[1:5], tuple(r["centroid"])) for r in got) == plain_clusters(rows)
    again = centroids.cluster_vectors(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_few_or_no_vectors(shipped):
    rows = list(enumerate(vectors(3)))
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(r["distance"] for r in centroids.cluster_vectors(df).collect()) == [0, 0, 0]
    none = centroids.cluster_vectors(df.filter("vec_id > 9"))
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(Exception, match="no exact distances"):
        centroids.cluster_vectors(shipped.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).collect()


# ---- hard negatives


@pytest.mark.parametrize("dims,size", [(64, 256), (13, 40), (8, 1), (5, 10**6)])
def test_scores_of_tables_are_inner_products(dims, size):
    rng = np.random.default_rng(dims)
    a, c = rng.integers(-size, size + 1, (30, dims)), rng.integers(-size, size + 1, (50, dims))
    planes = negatives.bit_planes(c, size.bit_length() + 1)
    got = negatives.scores(negatives.subset_sums(a), np.ascontiguousarray(planes.transpose(1, 2, 0)))
    assert (got == c @ a.T).all()


def plain_negatives(rows):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(256 * float(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in kept:
        if i % 100:
            continue
        others = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, k == label) for j, w, k in kept if j != i)
        for s, j, _ in [o for o in others if o[2]][:5]:
            inside = [(-t, k) for t, k, same in others if not same and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, n + 1, k, -s, t) for n, (t, k) in enumerate(inside[:10])]
    return sorted(out)


def pool(n, dims=64, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (10, dims))
    labels = rng.integers(0, 10, n)
    x = np.round(centres[labels] * 0.1 + rng.normal(0, 0.15, (n, dims)), 2 if dims > 8 else 1)
    return [(i, [float(np.float32(v)) for v in x[i]], int(labels[i])) for i in range(n)]


def negatives_of(df):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label=moved)


@pytest.mark.parametrize("dims", [64, 4])
def test_negatives_against_plain_python(shipped, monkeypatch, dims):
    rows = pool(700, dims)
    rows += [(1000 + i, rows[5][1], 1) for i in range(300)]  # one vector and one label in a third of the rows
    rows += [(2000, None, 1), (2001, rows[0][1], None), (2002, [None] * dims, 1), (2003, [float("nan")] * dims, 2), (None, rows[0][1], 3), (2100, [], 4), (2004, [0.5], 4), (2200, [-0.3] * dims, 77)]
    want = plain_negatives(rows)
    df = shipped.createDataFrame(rows, ROW).withColumns({c: F.lit(1) for c in ("row", "place", "rank", "query", "whole", "score", "id", "v")})
    assert len(want) > 50
    assert sorted(map(tuple, negatives_of(df.repartition(5)).collect())) == want
    monkeypatch.setattr(negatives, "ROUND_ANCHORS", 4)
    assert sorted(map(tuple, negatives_of(df).collect())) == want


def test_negatives_with_text_ids_and_repeated_rows(shipped):
    rows = pool(300)
    name = lambda i: f"{i:05d}"
    df = shipped.createDataFrame([(name(i), v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in rows], "vec_id string, embedding array<float>, label int")
    got = negatives.hard_negatives(df, F.col("vec_id").endswith("00"))
    assert sorted(map(tuple, got.collect())) == [(name(a), name(b), r, name(c), s, t) for a, b, r, c, s, t in plain_negatives(rows)]
    # a repeated candidate is a row of its own, a repeated anchor gives its rows again
    twice = shipped.createDataFrame([*rows, *rows[:1]], ROW)
    once = sorted(map(tuple, negatives_of(shipped.createDataFrame(rows, ROW)).filter("anchor_id = 0").collect()))
    assert sorted(map(tuple, negatives_of(twice).filter("anchor_id = 0").collect())) == sorted(once + once)
    assert negatives_of(df.sparkSession.createDataFrame([], ROW)).collect() == []
    assert negatives_of(df.sparkSession.createDataFrame([(1, [0.1], 1)], ROW)).collect() == []


# ---- SimHash


def plain_fingerprint(text):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = ["", " \t\n", "One", "one TWO", "One two THREE", "a b c d a b c d a b c", "ÄÖ Ü x é\x1cy Z\x0bq z", "x" * 5000 + " tail of it"]


def test_fingerprints_in_pieces(monkeypatch):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice("ab Cd efg hij K".split()) + rng.choice(["", "\n", "\t "]) for _ in range(n)) for n in (10, 100, 3000)]
    for piece in (1 << 20, 7, 64):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert [simhash.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == 0


def test_masks_cover_every_pair_in_the_radius():
    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15 and all(30 <= m.bit_count() <= 36 for m in masks)
    for bits in itertools.combinations(range(64), 3):
        difference = sum(1 << b for b in bits)
        assert any(not m & difference for m in masks)


def reached(bits, radius=3):
    group = list(range(len(bits)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in itertools.combinations(range(len(bits)), 2):
        if (bits[i] ^ bits[j]).bit_count() <= radius:
            a, b = sorted((top(i), top(j)))
            group[b] = a
    return [top(i) for i in range(len(bits))]


@pytest.mark.parametrize("bucket", [256, 8])
def test_links_connect_what_the_radius_connects(shipped, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(6)
    bits = {0, (1 << 64) - 1}
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(8):
            bits.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
    hot = rng.getrandbits(64)
    bits |= {hot ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(300)}
    bits = sorted(bits)
    nodes = shipped.createDataFrame([(simhash._signed(b),) for b in bits], "bits long")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.near_links(nodes).collect()]
    from recensio.operators.components import connected_components

    found = connected_components(nodes.withColumnRenamed("bits", "node"), shipped.createDataFrame([(simhash._signed(a), simhash._signed(b)) for a, b in links], "a long, b long"))
    part = {r["node"] % 2**64: r["component"] for r in found.collect()}
    want = reached(bits)
    assert len(links) < 15 * len(bits)
    assert len({(part[b], w) for b, w in zip(bits, want, strict=True)}) == len(set(want)) == len(set(part.values()))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_near_duplicates_against_all_pairs(shipped, kind):
    source = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [(int(r[0]), r[1]) for r in source][:600] + [(5000 + i, t) for i, t in enumerate(TEXTS)] + [(6000, None), (6001, ""), (6001, "")]
    texts += [(7000 + i, "the same words again and again") for i in range(400)]
    name = (lambda i: f"d{i:05d}") if kind == "string" else (lambda i: i)
    rows = [(name(i), t) for i, t in texts] + [(None, "the same words again and again")]
    df = shipped.createDataFrame(rows, f"doc_id {kind}, text string").withColumns({c: F.lit(1) for c in ("id", "bits", "least", "rows", "fingerprint", "component_id", "n")})
    got = simhash.near_duplicates(df).collect()
    marks = [plain_fingerprint(t or "") for _, t in rows]
    tops = reached(marks)
    lowest = {}
    for (i, _), t in zip(rows, tops, strict=True):
        if i is not None:
            lowest[t] = min(lowest.get(t, i), i)
    want = sorted((str(i), f"{m:016x}", lowest[t]) for (i, _), m, t in zip(rows, marks, tops, strict=True))
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
    assert simhash.near_duplicates(df.filter("false")).collect() == []
