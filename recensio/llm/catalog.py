"""One query per operator over its whole table and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recensio.llm import backoff, centroids, credentials, langnet, leaks, mixing, negatives, quality, repeats, shards, similar_sets, simhash, sketch
from recensio.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(divisor: int):
    """crc32 of the id as text, modulo a number."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(divisor))


def digest(column):
    return F.sha2(column, 256)


# DuckDB has no crc32; the remainder is taken from the bits of the id's digits,
# one digit at a time, with the table of the polynomial made by recursion.
CRC_SQL = """
with recursive steps as (
  select b::bigint as b, b::bigint as r, 0 as k from range(256) t(b)
  union all
  select b, case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, k + 1 from steps where k < 8
), crc_table as (select list(r order by b) as t from steps where k = 8),
folds as (
  select doc_id, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as crc
  from documents, crc_table)
"""

OP1_SQL = (
    CRC_SQL
    + r"""
, texts as (
  select d.doc_id, f.crc % 7 = 2 as held_out,
    list_append(regexp_extract_all(translate(coalesce(d.text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') as w
  from documents d join folds f using (doc_id)),
tokens as (select doc_id, held_out, unnest(list_prepend('', w)[:-2]) as a, unnest(w) as b from texts),
words as (select b, count(*) as c from tokens where not held_out group by b),
arcs as (select a, b, count(*) as c from tokens where not held_out group by a, b),
states as (
  select a, total, 1 - sum(arcs.c - 0.75) / total as f
  from arcs join (select a, count(*) as total from tokens where not held_out group by a) using (a) group by a, total),
sizes as (select sum(c)::bigint as n, count(*) as v from words),
priced as (
  select doc_id, held_out, n, coalesce(words.c, 0) as c, (coalesce(words.c, 0) + 1.0::double) / (n + v + 1) as p1,
    coalesce((arcs.c - 0.75::double) / total, 0) as arc, coalesce(f, 1) as f
  from tokens cross join sizes left join words on tokens.b = words.b
    left join arcs on tokens.a = arcs.a and tokens.b = arcs.b left join states on tokens.a = states.a)
select doc_id, held_out, count(*) as n_tokens, count(*) filter (c > 0) as n_known, n as train_tokens,
  round(sum(log10(p1)), 6) as base_score, round(sum(log10(arc + f * p1)), 6) as score
from priced group by doc_id, held_out, n
"""
)


@query("op1_lm_scores", OP1_SQL)
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(7) == 2)
    scored = backoff.score_texts(docs, ~F.col("held_out"))
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        F.round("base_score", 6).alias("base_score"),
        F.round("score", 6).alias("score"),
    )


OP2_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') as s
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from texts)),
firsts as (select s, min(doc_id) as first_doc from windows group by s),
gone as (
  select distinct doc_id, unnest(range(i, i + 13)) as p
  from windows join firsts using (s) where first_doc < doc_id),
removed as (select doc_id, list(p) as ps, count(*) as n from gone group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0) as n_removed,
  sha256(coalesce(array_to_string(case when n is null then w else
    [w[p] for p in range(1, len(w) + 1) if not list_contains(ps, p)] end, ' '), '')) as kept_sha256
from texts left join removed using (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark, sf_dir):
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", digest(F.col("kept_text")).alias("kept_sha256"))


OP3_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, w, least(len(w), 10) as n from (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0),
grams as (
  select distinct item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as s
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from items)),
windows as (
  select doc_id, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as s
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from texts, (select distinct n from items)) where i > 0),
hits as (select doc_id, item_id, i, windows.n from windows join grams on grams.s = windows.s and grams.n = windows.n),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join hit_words using (doc_id) left join hit_items using (doc_id)
"""


@query("op3_decontaminate", OP3_SQL)
def op3(spark, sf_dir):
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        digest(F.array_join("hit_items", ",")).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


@query("op4_shards")
def op4(spark, sf_dir):
    placed = shards.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "group_size",
    )


@query("op5_fingerprints")
def op5(spark, sf_dir):
    made = sketch.edited_likeness(table(spark, sf_dir, "documents"))
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return made.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        digest(F.col("edited")).alias("edited_sha256"),
        sketch.fingerprint(own).alias("fingerprint"),
        sketch.fingerprint(edited).alias("edited_fingerprint"),
        sketch.containment(own, edited).alias("near_edited"),
        sketch.containment(own, following).alias("near_next"),
        sketch.resemblance(own, edited).alias("jaccard_edited"),
        sketch.resemblance(own, following).alias("jaccard_next"),
    )


@query("op6_language_id")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(4) == 2)
    net = langnet.fit(docs.filter(~F.col("held_out")))
    named = langnet.predict(docs.select("doc_id", "held_out", "text"), net)
    return named.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query("op7_secret_scan")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = credentials.scan(docs, credentials.fit(docs))
    place = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, place), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in credentials.KINDS],
        digest(joined(F.filter("spans", lambda s: s["base"]))).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


OP8_SQL = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
shingles as (
  select distinct doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from texts where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs_ as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_both from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select a, b from pairs_ join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where n_both + 1e-9 >= 0.8 * (x.n + y.n - n_both)),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, links.b from reach join links on reach.b = links.a),
classes as (select a, min(b) as class_id from reach group by a),
counts as (select a, count(*) as n_links from links group by a)
select d.doc_id, class_id, coalesce(n_links, 0) as n_links, coalesce(n, 0) as n_shingles
from documents d join classes on classes.a = d.doc_id left join counts on counts.a = d.doc_id
  left join sizes on sizes.doc_id = d.doc_id
"""


@query("op8_jaccard_join", OP8_SQL)
def op8(spark, sf_dir):
    found = similar_sets.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_shingles")


# The rounds of raking, three windows each, written out as one chain.
def _raked_sql(rounds: int) -> str:
    chain, at = [], "r0"
    for k in range(rounds):
        for margin in mixing.MARGINS:
            to = f"r{k + 1}" if margin == mixing.MARGINS[-1] else f"r{k}_{margin}"
            by = f"target_{margin} / sum(weight) over (partition by {margin})"
            off = f", {by} as by_{margin}" if k == rounds - 1 else ""
            chain.append(f"{to} as (select * replace (weight * {by} as weight){off} from {at})")
            at = to
    return ",\n".join(chain)


OP9_SQL = (
    r"""
with texts as (
  select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang, coalesce(text, '') as t,
    coalesce(doc_id::varchar, text, '') as key from documents),
rows_ as (
  select doc_id, source, lang, key, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::bigint as n_tokens,
    case when contains(t, ' | ') then 'table' when contains(t, 'icens') then 'licence' when length(t) < 1000 then 'short'
      when length(t) < 4000 then 'medium' else 'long' end as topic from texts),
cells as (select source, lang, topic, sum(n_tokens)::bigint as tokens from rows_ group by all having sum(n_tokens) > 0),
"""
    + ",\n".join(
        f"""own_{m} as (select {m}, pow(sum(tokens)::double / (select sum(tokens) from cells), 0.7) as p from cells group by {m}),
share_{m} as (select {m}, p / (select sum(p) from own_{m}) as target_{m} from own_{m})"""
        for m in mixing.MARGINS
    )
    + """,
r0 as (select *, tokens::double as weight from cells join share_source using (source) join share_lang using (lang)
  join share_topic using (topic)),
"""
    + _raked_sql(mixing.ROUNDS)
    + """,
ratios as (select source, lang, topic, weight * (select sum(tokens) from cells) / tokens as ratio from r20),
fits as (select round(max(greatest(abs(by_source - 1), abs(by_lang - 1), abs(by_topic - 1))), 6) as fit from r20),
chances as (select *, ratio / (select max(ratio) from ratios) as p from ratios)
select doc_id, source, lang, topic, n_tokens, round(coalesce(case when n_tokens > 0 then ratio end, 0), 6) as ratio,
  round(coalesce(case when n_tokens > 0 then p end, 0), 6) as probability,
  ('0x' || substr(md5('mix:' || key), 1, 8))::bigint / 4294967296.0::double
    < coalesce(case when n_tokens > 0 then p end, 0) as sampled, (select fit from fits) as fit
from rows_ left join chances using (source, lang, topic)
"""
)


@query("op9_mixture", OP9_SQL)
def op9(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    named = lambda c: F.coalesce(F.col(c), F.lit("(none)")).alias(c)
    return mixed.select(
        "doc_id",
        named("source"),
        named("lang"),
        F.col("mix_topic").alias("topic"),
        "n_tokens",
        F.round("ratio", 6).alias("ratio"),
        F.round("probability", 6).alias("probability"),
        "sampled",
        F.round("fit", 6).alias("fit"),
    )


@query("op10_quality")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(4) == 2)
    learned = table(spark, sf_dir, "labels").filter(fold(4) != 2)
    forest = quality.fit(docs, learned)
    scored = quality.score(docs.select("doc_id", "held_out", "text"), forest, name="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= quality.KEEP).cast("int").alias("predicted"))


# Ten rounds of assignment and floored means over single components, written out as one chain.
def _clusters_sql(rounds: int) -> str:
    chain = []
    for k in range(rounds + 1):
        chain.append(f"""d{k} as materialized (
  select p.v, c.j, sum((p.x - c.x) * (p.x - c.x))::bigint as d from parts p join c{k} c using (i) group by p.v, c.j),
a{k} as materialized (
  select v, j, d from d{k} qualify row_number() over (partition by v order by d, j) = 1)""")
        if k < rounds:
            chain.append(f"""m{k} as (
  select a.j, i, sum(x)::bigint as s, count(*)::bigint as n from parts p join a{k} a using (v) group by a.j, i),
c{k + 1} as materialized (
  select j, i, case when n is null then x else (s - ((s % n) + n) % n) // n end as x from c{k} left join m{k} using (j, i))""")
    return ",\n".join(chain)


OP11_SQL = (
    r"""
with kept as (
  select row_number() over () as v, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as w
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: isfinite(x))) = 64),
parts as materialized (select v, unnest(range(1, 65)) as i, unnest(w) as x from kept),
starts as (
  select v, row_number() over (order by sha256('3:' || vec_id), w) - 1 as j from kept
  qualify row_number() over (order by sha256('3:' || vec_id), w) <= 8),
c0 as (select j, i, x from starts join parts using (v)),
"""
    + _clusters_sql(centroids.ROUNDS)
    + f""",
sums as (select j, sum(d)::bigint as cluster_inertia from a{centroids.ROUNDS} group by j),
ends as (select j, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{centroids.ROUNDS} group by j)
select vec_id, j::int as cluster, d as distance, cluster_inertia, (select sum(d)::bigint from a{centroids.ROUNDS}) as inertia,
  centroid_sha256
from a{centroids.ROUNDS} join kept using (v) join sums using (j) join ends using (j)
"""
)


@query("op11_centroids", OP11_SQL)
def op11(spark, sf_dir):
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    written = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest(written).alias("centroid_sha256"))


OP12_SQL = r"""
with rows_ as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as w
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored as (
  select a.vec_id as anchor_id, c.vec_id as vec_id, a.label = c.label as alike, list_dot_product(a.w, c.w)::bigint as score
  from rows_ a join rows_ c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
found as (
  select p.*, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by n.score desc, n.vec_id)::int as rank
  from positives p join scored n using (anchor_id)
  where not n.alike and 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors, vec_id % 100 == 0, label=moved)


@query("op13_simhash")
def op13(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
