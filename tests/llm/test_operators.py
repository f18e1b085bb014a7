"""Operators without SQL against plain Python, held-out accuracy, and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from recensio.llm import boosting, catalog, credentials, langnet, leaks, mixing, quality, repeats, shards, similar_sets, sketch
from recensio.llm.ship import ship

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def clashing(docs):
    """A few documents with columns named like those that operators use inside or add."""
    names = "class chunk blob unit row group shard slot size _id _text _range _guest _tie tokens weight ratio probability sampled topic words pos hash quality score lang_pred lang_score spans kept_text".split()
    return docs.limit(40).withColumns({n: F.lit("x") for n in names})


def test_clashing_names(spark, docs):
    odd = clashing(docs)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert repeats.remove_repeats(odd).count() == 40
    found = leaks.find_leaks(odd, items)
    assert found.count() == 40 and set(odd.columns) <= set(found.columns)
    assert shards.shard_documents(odd).count() == 40
    assert sketch.edited_likeness(odd).count() == 40
    assert similar_sets.similarity_classes(odd).count() == 40
    assert set(similar_sets.one_of_each(odd).columns) == set(odd.columns)
    assert mixing.mix(odd).count() == 40
    assert credentials.scan(odd, credentials.train([])).count() == 40
    assert langnet.predict(odd, None).filter("lang_pred = 'und'").count() == 40
    assert quality.score(odd, boosting.constant(0.5), name="score").filter("score = 0.5").count() == 40


def test_clashing_names_keep_their_values(spark):
    ship(spark)
    rows = [(i, f"text number {i} has words of its own q{i}", "x", f"y{i}", "z") for i in range(6)]
    odd = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, _id string, _text string, _keep_id string")
    assert sorted(tuple(r) for r in similar_sets.one_of_each(odd).collect()) == rows


def test_one_row_of_a_labelled_id_is_learned(spark, monkeypatch):
    """However many rows an id has, one of them reaches the driver, the same in any order."""
    ship(spark)
    rows = [(1, f"Many rows of one id, {i}.") for i in range(200)] + [(2, "Another one."), (2, "Another one."), (3, None)]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(boosting, "train", lambda x, y: seen.append((x.tolist(), y.tolist())))
    for order in (rows, rows[::-1]):
        quality.fit(spark.createDataFrame(order, "doc_id long, text string"), labels)
    assert seen[0] == seen[1] and sorted(seen[0][1]) == [0.0, 0.0, 1.0]


def test_shards_are_even_and_keep_groups(spark, docs):
    rows = catalog.QUERIES["op4_shards"](spark, SF_DIR).collect()
    count = Counter(r["shard"] for r in rows)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    homes = defaultdict(set)
    for r in rows:
        homes[r["text_crc32"]].add(r["shard"])
    copies = [r["text_crc32"] for r in rows if r["group_size"] > 1]
    assert copies and sum(len(homes[c]) > 1 for c in set(copies)) <= 0.05 * len(set(copies))
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in rows)


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "same" if i < 400 else f"t{i}" if i % 2 else f"t{i // 10}") for i in range(1_000)]
    placed = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count = Counter(r["shard"] for r in placed)
    assert set(count.values()) == {125}
    spread = Counter(r["shard"] for r in placed if r["doc_id"] < 400)
    assert sum(n for _, n in spread.most_common(4)) >= 0.7 * 400  # four shards would hold it at best; chance gives half


def test_lines_and_passages_anywhere_link_documents(spark, tmp_path):
    """Documents of a chain share a line or a passage with the next one only, never the first line."""
    import corpus_pipeline

    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, pairs = [], []
    for k in range(100):
        shared = [text(12) for _ in range(3)]
        for i in range(4):
            own = [text(8), text(8)]
            if k % 2:  # whole lines further down
                own += shared[max(0, i - 1) : i + 1]
            else:  # inside a text without line breaks
                own = [" ".join([own[0], *shared[max(0, i - 1) : i + 1], own[1]])]
            rows.append((4 * k + i, "\n".join(own)))
            if i:
                pairs.append((4 * k + i - 1, 4 * k + i))
    rows += [(1_000 + i, text(30)) for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d.parquet")
    docs = spark.read.parquet(f"{tmp_path}/d.parquet")
    placed = {r["doc_id"]: r for r in corpus_pipeline.sharded_documents(spark, docs, str(tmp_path)).collect()}
    count = Counter(r["shard"] for r in placed.values())
    assert len(placed) == 500 and max(count.values()) - min(count.values()) <= 1
    assert all((placed[d]["group_size"] > 1) == (d < 1_000) for d in placed)
    together = sum(placed[a]["shard"] == placed[b]["shard"] for a, b in pairs)
    assert together >= 0.8 * len(pairs)  # chance gives an eighth


def test_sketches_against_plain_hashes(spark, docs, texts):
    def chain(words):
        h = 42
        for w in words:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        return h - 2**64 if h >= 2**63 else h

    def plain(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = {chain(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {chain(w)} if w else set()
        low = sorted(h for h in grams if h < -(2**63) + 2**64 // 8)
        return low or ([min(grams)] if grams else [])

    got = {r["doc_id"]: r for r in sketch.edited_likeness(docs).collect()}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        a, b = texts[d], texts[order[(i + 1) % len(order)]]
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert got[d]["edited"] == edited
        if i % 10 == 0:
            assert got[d]["sketch"] == plain(a) and got[d]["edited_sketch"] == plain(edited) and got[d]["next_sketch"] == plain(b)
    found = catalog.QUERIES["op5_fingerprints"](spark, SF_DIR)
    assert found.filter("near_edited > near_next").count() > 0.95 * len(texts)
    assert all(0 <= r[0] <= 1 and 0 <= r[1] <= 1 for r in found.select("near_edited", "near_next").collect())


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(8_000)]
    part = base[:4_000]
    df = spark.createDataFrame([(" ".join(base), " ".join(part), "")], "a string, b string, c string")
    a, b, c = (sketch.sketch(F.col(x)) for x in "abc")
    row = df.select(sketch.containment(a, b), sketch.resemblance(a, b), sketch.containment(a, c), sketch.containment(c, c), sketch.merged(a, b) == a).first()
    assert row[0] == 1.0 and abs(row[1] - 0.5) < 0.06 and row[2] == 0.0 and row[3] == 1.0 and row[4]


def test_next_rows_wrap_and_stay_even(spark):
    rows = [(i * 3 % 101, f"t{i}") for i in range(101)] + [(None, "n1"), (None, "n2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sketch.with_next(df.withColumn("_tie", F.xxhash64("text")), "doc_id", "_tie", ["doc_id", "text"]).collect()
    following = {r["text"]: r["next_text"] for r in got}
    assert len(following) == 103 and len(set(following.values())) == 103
    byid = {i: t for i, t in rows if i is not None}
    assert all(following[byid[i]] == byid[i - 1] for i in range(1, 101))
    assert following[byid[0]] in ("n1", "n2") and byid[100] in (following["n1"], following["n2"])


def held_out_accuracy(rows, truth):
    seen = [(p == truth[d]) for d, out, p in rows if out and d in truth]
    assert len(seen) > 50
    return sum(seen) / len(seen)


def test_language_of_held_out_documents(spark, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [(r["doc_id"], r["held_out"], r["lang_pred"]) for r in catalog.QUERIES["op6_language_id"](spark, SF_DIR).collect()]
    assert held_out_accuracy(rows, truth) > 0.96
    assert all(out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, out, _ in rows)


def test_quality_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [(r["doc_id"], r["held_out"], r["predicted"]) for r in catalog.QUERIES["op10_quality"](spark, SF_DIR).collect()]
    assert held_out_accuracy(rows, truth) > 0.96


def test_flattened_trees_against_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    forest = boosting.train(x, y)
    assert ((forest.probability(x) > 0.5) == (y > 0.5)).mean() > 0.97
    for row in x[:20]:
        margin = forest.start
        for t in range(len(forest.feature)):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
            margin += forest.value[t, node]
        assert abs(1 / (1 + np.exp(-margin)) - forest.probability(row[None])[0]) < 1e-9
    assert boosting.train(x, np.ones(500)).probability(x).min() > 0.99


def test_secrets_against_plain_patterns(spark, texts):
    rows = catalog.QUERIES["op7_secret_scan"](spark, SF_DIR).collect()
    assign = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in rows:
        t = texts[r["doc_id"]]
        a = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        c = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        h = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (len(a), len(c), len(h))
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{b}:{e}" for b, k, e in sorted(a + c + h))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        base = [s for s in r["spans"].split(",") if s and not s.startswith("random")]
        assert ",".join(base) == joined


def test_markov_models_tell_unseen_strings_apart():
    words = "thering anon bleation retion wherand handle station person matter under window over letter".split() * 30
    ratio = credentials.train(words)

    def share(strings):
        data = "\n".join(f"é {s}" for s in strings).encode()
        text, begins, ends = credentials.random_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ratio)
        whole = "\n".join(f"é {s}" for s in strings)
        assert all(whole[b:e] in strings for b, e in zip(begins, ends, strict=True))
        return len(begins) / len(strings)

    assert share(credentials.random_strings(1_000, seed=77)) > 0.98
    assert share([s for s in credentials._identifiers(words[:15], seed=8) if len(s) >= credentials.LEAST]) < 0.02
    assert share(["wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]) == 1
    assert share(["getElementByIdFromDocument", "user_account_balance_2024", "2024-01-02-03-04-05", "-" * 40]) == 0


def test_random_parts_of_long_runs(spark):
    """Keys behind and before long ordinary names, two in a run, and joined to a fixed pattern."""
    ship(spark)
    words = "thering anon bleation retion wherand handle station person matter under window over letter".split() * 30
    ratio = credentials.train(words)
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda n: "".join(rng.choices(alphabet, k=n))
    name = "/".join(rng.choices(words, k=14))
    rows = []
    for i in range(100):
        a, b = key(20 + i % 21), key(24)
        rows += [(f"é {name}/{a}", [a]), (f"{a}-{name} é", [a]), (f"{a}/{name}/{b}/{name}", [a, b])]
        rows += [(f"AKIA{'Q' * 16}-{a} é {'0123456789abcdef' * 2}_{b}", [a, b]), (f"é {name}/{name}", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    found = total = 0
    for r in credentials.scan(df, ratio).collect():
        text, keys = rows[r["doc_id"]]
        spans = [(s["begin"], s["end"]) for s in r["spans"] if not s["base"]]
        assert keys or not spans
        assert all(e - b < len(name) for b, e in spans)  # the ordinary rest stays outside
        found += sum(any(b <= text.index(k) and text.index(k) + len(k) <= e for b, e in spans) for k in keys)
        total += len(keys)
    assert found >= 0.97 * total


def test_a_failing_match_is_passed_over():
    assert credentials.base_spans("secret:token:abcdefgh") == []
    assert credentials.base_spans("Token = 'abcdef' AKIA" + "A" * 16) == [(0, 0, 15), (17, 1, 37)]


def test_pruning_keeps_what_may_reach_the_threshold():
    least = similar_sets.least_matches(0.8, 1e-7)
    rng = np.random.default_rng(5)
    matches = rng.random((20_000, 128)) < 0.8
    lost = np.zeros(len(matches), bool)
    for n, need in enumerate(least):
        lost |= matches[:, : 16 * (n + 1)].sum(axis=1) < need
    assert lost.mean() < 1e-3
    assert (rng.random((2_000, 128)) < 0.2).sum(axis=1).max() < least[-1]


def test_many_near_copies_meet_in_blocks(spark, monkeypatch):
    """More members than a block: every link is counted once, whatever the blocks."""
    ship(spark)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(200), i % 7):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    grams = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in rows}
    links = {(i, j) for i in grams for j in grams if i != j and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])}
    want = Counter(i for i, _ in links)
    monkeypatch.setattr(similar_sets, "BLOCK", 16)
    got = {r["doc_id"]: r["n_links"] for r in similar_sets.similarity_classes(df).collect()}
    assert got == {i: want[i] for i in grams}


def test_mixture_meets_its_targets(spark, docs):
    lang = spark.createDataFrame([("en", 0.4), ("fr", 0.2), ("de", 0.2), ("es", 0.2)], "lang string, share double")
    mixed = mixing.mix(docs, temperature=1.0, targets=None)
    assert mixed.filter("sampled").count() == docs.count()  # its own shares are met by taking all
    cells = mixed.groupBy(F.col("source"), F.col("lang"), F.col("mix_topic").alias("topic")).agg(F.sum("n_tokens").alias("tokens"))
    targets = {m: mixing.tempered(cells, m, 0.7) for m in ("source", "topic")} | {"lang": lang}
    fitted = mixing.mix(docs, targets=targets)
    got = {r["lang"]: r["t"] for r in fitted.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t")).collect()}
    total = sum(got.values())
    assert all(abs(got[k] / total - s) < 1e-6 for k, s in (("en", 0.4), ("fr", 0.2)))
    assert fitted.agg(F.max("probability")).first()[0] == pytest.approx(1.0)


def test_removed_spans_and_kept_words(spark):
    a = [f"a{i}" for i in range(20)]
    rows = [(1, " ".join(a)), (2, "x y " + " ".join(a[:15]) + " z"), (3, " ".join(a[:12])), (2, "q r s")]
    got = {(r["doc_id"], r["n_words"]): r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[(2, 18)]["kept_text"] == "x y z" and [tuple(s) for s in got[(2, 18)]["removed"]] == [(2, 17)]
    assert got[(1, 20)]["n_removed"] == 0 and got[(3, 12)]["n_removed"] == 0 and got[(2, 3)]["kept_text"] == "q r s"


def test_leaks_without_broadcast(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    key = lambda df: sorted((r["doc_id"], tuple(r["hit_words"]), tuple(r["hit_items"])) for r in df.collect())
    want = key(leaks.find_leaks(docs, items))
    for name in ("BROADCAST_WINDOWS", "BROADCAST_TEXTS", "BROADCAST_FOUND"):
        monkeypatch.setattr(leaks, name, 0)
    assert key(leaks.find_leaks(docs, items)) == want
    clean = leaks.without_hits(leaks.find_leaks(docs, items).drop("text").join(docs.select("doc_id", "text"), "doc_id"))
    row = clean.filter(F.size("hit_words") > 0).first()
    assert len(row["clean_text"].split(" ")) == row["n_words"] - len(row["hit_words"])


def test_plans_of_raking_do_not_double_with_the_margins(spark, monkeypatch):
    plans, write = [], mixing.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate"))
        return write(df)

    monkeypatch.setattr(mixing, "materialize", seen)
    docs = spark.range(60).selectExpr("id as doc_id", "concat('w ', id) as text", "concat('l', id % 2) as lang", "concat('s', id % 3) as source")
    assert mixing.mix(docs).count() == 60
    assert max(plans) <= 8
