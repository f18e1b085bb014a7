"""Similarity joins against brute force, with skewed keys forced small."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recensio.operators import copies, similar, vectors


def brute(texts, min_df=2, max_df=0.85):
    docs = {i: Counter(re.findall(r"\w\w+", t.lower())) for i, t in texts}
    n = len(docs)
    df = Counter(term for c in docs.values() for term in c)
    unit = {}
    for i, c in docs.items():
        v = {t: f * (math.log((1 + n) / (1 + df[t])) + 1) for t, f in c.items() if min_df <= df[t] <= max_df * n}
        norm = math.sqrt(sum(x * x for x in v.values()))
        unit[i] = {t: x / norm for t, x in v.items()} if norm else {}
    out = {}
    for i in unit:
        for j in unit:
            if i < j:
                out[i, j] = sum(x * unit[j].get(t, 0.0) for t, x in unit[i].items())
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        length = rng.choice([1, 2, 3, 8, 20])
        # a few words are in most texts, so that short texts share common terms
        rows.append((i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(40)], k=length))))
    rows += [(150 + i, "hot copy of one text w3 w5") for i in range(75)]
    rows += [(225 + i, f"near copy number{i} w1 w2 w9 w9") for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [2, 5, 4000])
@pytest.mark.parametrize("threshold", [0.6, 0.9])
def test_same_as_brute_force(spark, texts, most, threshold):
    scores = brute(texts)
    df = spark.createDataFrame(texts, "id long, text string")
    found = similar.similar_texts(df, "id", "text", threshold, most=most)
    first = {r["id"]: r["first_id"] for r in found.members.collect()}
    pairs = {(r["id1"], r["id2"]): r["similarity"] for r in found.pairs.collect()}
    want = {p for p, s in scores.items() if s >= threshold - 1e-12}
    listed = set()
    for i in first:
        for j in first:
            if i < j and (first[i] == first[j] or tuple(sorted((first[i], first[j]))) in pairs):
                listed.add((i, j))
    assert listed == want
    for pair, s in pairs.items():
        assert s == pytest.approx(scores[pair], abs=1e-9)
    copies_of = {r["first_id"]: r["copies"] for r in found.groups.collect()}
    assert copies_of == Counter(first.values())
    kept = {r["id"] for r in similar.remove_duplicates(df, "id", "text", threshold, True, most=most).collect()}
    assert kept == {i for i, _ in texts} - {j for _, j in want}
    tagged = {r["id"] for r in similar.tag_similar(df, "id", found).filter("is_near_duplicate").collect()}
    assert tagged == {i for pair in want for i in pair}


def test_drop_is_not_transitive(spark):
    # a ~ b and b ~ c, but a and c differ: both later ones go, also behind a dropped one
    base = "uno due tre quattro cinque sei"
    rows = [(0, base + " sette otto"), (1, base + " sette nove"), (2, base + " dieci nove"), (3, "altro testo qui")]
    rows += [(10 + i, w) for i, w in enumerate("sette otto nove dieci altro testo qui".split())]
    scores = brute(rows)
    t = (scores[0, 1] + scores[0, 2]) / 2
    assert scores[1, 2] > t > scores[0, 2]
    df = spark.createDataFrame(rows, "id long, text string")
    kept = {r["id"] for r in similar.remove_duplicates(df, "id", "text", t).collect()}
    assert kept == {0, 3, *range(10, 17)}


def test_empty_vocabulary_drops_nothing(spark):
    df = spark.createDataFrame([(1, "uno due"), (2, "tre quattro"), (3, None)], "id long, text string")
    assert similar.remove_duplicates(df, "id", "text").count() == 3


def test_exact_copies(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, None), (5, "b"), (6, "a")]
    df = spark.createDataFrame(rows, "id long, text string")
    assert sorted(r["id"] for r in copies.later_copies(df, "id", "text").collect()) == [2, 4, 6]
    assert sorted(r["id"] for r in copies.all_copies(df, "id", "text").collect()) == [1, 2, 3, 4, 6]
    assert copies.copy_count(df, "id", "text").first()[0] == 3


@pytest.mark.parametrize("most", [3, 4000])
def test_similar_vectors(spark, most):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    x = np.vstack([c + 0.25 * rng.normal(size=(25, 12)) for c in centres])
    x = np.vstack([x, x[:10], 3 * x[:5], np.zeros((1, 12))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    pairs, groups, _ = vectors.similar_vectors(df, "id", "v", 0.95, most=most)
    firsts = {r["first_id"] for r in groups.collect()}
    with np.errstate(invalid="ignore"):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T
    want = {(i, j) for i in firsts for j in firsts if i < j and s[i, j] >= 0.95}
    assert {(r["id1"], r["id2"]) for r in pairs.collect()} == want
    assert sum(r["copies"] for r in groups.collect()) == len(x) - 1


def test_without_any_broadcast(spark, texts, monkeypatch):
    from recensio.operators import scale, weights

    df = spark.createDataFrame(texts, "id long, text string")

    def shown():
        rows = weights.term_weights(df, "id", "text").collect()
        return sorted((r["id"], r["term"], r["tf"], round(r["weight"], 9), round(r["before"], 9)) for r in rows)

    want = shown()
    monkeypatch.setattr(weights, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(scale, "fits_broadcast", lambda *a: False)
    assert shown() == want


def test_few_pairs_of_clustered_vectors_meet(spark):
    """Vectors around forty centres: fewer than a tenth of all pairs share a cell at 0.92."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64))
    rows = [(i, (centres[i % 40] + rng.normal(0, 0.1, 64)).tolist()) for i in range(1_000)]
    units = spark.createDataFrame(rows, "id long, e array<double>").select("id", vectors.unit(F.col("e")).alias("v"))
    placed = vectors.pivot_cells(units, (2 - 2 * 0.92) ** 0.5).cache()
    home = placed.filter("home = cell").select("cell", F.col("id").alias("a"), F.col("home").alias("h"))
    met = home.join(placed, "cell").filter("h < home or (h = home and a < id)").count()
    assert met < 0.1 * 1_000 * 999 / 2


def test_keys_of_common_terms_grow_longer(spark, monkeypatch):
    """Different texts that share common terms: compared pairs grow more slowly than their square."""
    from recensio.operators import similar, weights

    rng = np.random.default_rng(9)

    def compared(n, most):
        """Entries that meet, and whether all pairs of brute force are among the candidates."""
        rows = [(i, " ".join(["alpha", "beta"] * 2 + [f"c{j}" for j in rng.choice(30, 8, replace=False)])) for i in range(n)]
        rows += [(n + i, f"other{i % 7} words{i % 5}") for i in range(n // 3)]
        table = weights.term_weights(spark.createDataFrame(rows, "id long, text string"), "id", "text")
        prefix = similar._prefix(table, 0.9)
        counted = []
        monkeypatch.setattr(similar, "salted", lambda a, b, keys, by, m: (counted.append(a.groupBy("key").count().selectExpr("sum(count * count)").first()[0]), (a, b, keys))[1])
        found = {(r["id1"], r["id2"]) for r in similar._by_common_terms(table, prefix, 0.9, most).collect()}
        vector = {}
        for r in table.collect():
            vector.setdefault(r["id"], {})[r["term"]] = r["weight"]
        first = {r["id"]: r["k1"] for r in prefix.filter(F.col("df") > most).select("id", "k1").collect()}
        close = {(a, b) for a in first for b in first if a < b and sum(w * vector[b].get(k, 0.0) for k, w in vector[a].items()) >= 0.9}
        rare = {r["term"] for r in table.filter(F.col("df") <= most).select("term").distinct().collect()}
        assert all((a, b) in found for a, b in close if not rare & vector[a].keys() & vector[b].keys())
        return sum(counted)

    few, many = compared(150, 10), compared(600, 10)
    assert many < 10 * few


def test_few_candidates_of_long_texts(spark):
    """Long unrelated texts share single rare terms all the time; hardly any such pair is a candidate."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"t{j}" for j in rng.choice(600, 60, replace=False))) for i in range(120)]
    rows += [(500 + i, rows[i][1].replace(rows[i][1].split()[0], "new")) for i in range(10)]
    packed = similar.placed_weights(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    packed = packed.groupBy("id").agg(F.collect_list(F.struct("term", "df", "weight", "before")).alias("terms"))
    found = [(r["id1"], r["id2"]) for r in similar._candidates(packed, 0.9, 4_000).collect()]
    assert {(i, 500 + i) for i in range(10)} <= set(found)
    assert len(found) == len(set(found)) < 100


def test_vector_blocks_meet_once(spark):
    """Pairs without a tree: nothing of the vectors is held by the driver."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 8))
    x[350:] = x[:350] + 0.05 * rng.normal(size=(350, 8))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.9)) if i < j}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = [(r["id1"], r["id2"]) for r in vectors.similar_vectors(df, "id", "v", 0.9, most=200)[0].collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_blocks_meet_in_rounds(spark, texts, monkeypatch):
    """Where many blocks meet, what moves at once stays at a few times the prefixes; pairs are those of brute force."""
    moved, written = [], similar.materialize

    def counted(df):
        if df.columns == ["id1", "id2"]:
            moved.append(df)
        return written(df)

    monkeypatch.setattr(similar, "BLOCK_TERMS", 60)
    monkeypatch.setattr(similar, "MOVED", 1)
    monkeypatch.setattr(similar, "materialize", counted)
    df = spark.createDataFrame(texts, "id long, text string")
    found = similar.similar_texts(df, "id", "text", 0.6)
    assert len(moved) > 3  # a round each, and all of them
    firsts = {r["first_id"] for r in found.groups.collect()}
    want = {p for p, s in brute(texts).items() if s >= 0.6 - 1e-12 and firsts >= {*p}}
    assert {(r["id1"], r["id2"]) for r in found.pairs.collect()} == want


def test_vectors_of_near_copies_move_about_once(spark, monkeypatch):
    """Candidates of one group of near copies share a cell, unless they are too many for one."""
    ids = [[g * 100 + i for i in range(30)] for g in range(5)]
    rows = [(a, b) for group in ids for a in group for b in group if a < b]
    candidates = spark.createDataFrame(rows, "id1 long, id2 long")

    def needed():
        placed = similar._in_cells(candidates).collect()
        assert sorted((r["id1"], r["id2"]) for r in placed) == rows
        return len({(r["cell"], i) for r in placed for i in (r["id1"], r["id2"])}), max(Counter(r["cell"] for r in placed).values())

    assert needed()[0] == 150
    monkeypatch.setattr(similar, "CELL_PAIRS", 100)
    copies_, most = needed()
    assert copies_ < len(rows) and most < 435


def test_numbered_terms_give_the_same_weights(spark, monkeypatch):
    """Numbers and counts hold what term_weights lists, with a broadcast vocabulary and without, also for repeated and missing ids."""
    from recensio.operators import scale, weights

    rows = [(i % 17 if i % 9 else None, " ".join(f"w{j}" for j in range(40) if (i * j) % (j + 2) < 2)) for i in range(60)] + [(90, None), (91, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    listed = {}
    for r in weights.term_weights(df, "id", "text").collect():
        listed.setdefault(r["id"], []).append((r["before"], r["df"], r["weight"]))

    def same():
        numbered, n_docs = weights.numbered_terms(df, "id", "text")
        seen = {r["id"]: [(x["before"], x["df"], x["weight"]) for x in r["terms"]] for r in weights.weighed(numbered, n_docs).collect()}
        assert seen.keys() == listed.keys()
        for i, entries in seen.items():
            assert np.allclose(entries, sorted(listed[i]), atol=1e-9)

    same()
    monkeypatch.setattr(weights, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(weights, "frequent_part", lambda dim, count: scale.frequent_part(dim, count, rows=8))
    same()
