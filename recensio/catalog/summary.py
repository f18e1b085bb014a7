"""Aggregates, windows, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from recensio.catalog.base import HOME, WITH_NOISY, WITH_REVIEWS, noisy, query, reviews
from recensio.catalog.features import JUNK9, NORMAL, PICTURES, TEXT, hits, normal
from recensio.functions import emoji, features as fx
from recensio.functions.text import lookup
from recensio.functions.wordlists import SENTIMENT_VALUE
from recensio.operators import copies, filters, summary as sm

BACK = chr(92)
LENGTHS = f"""{WITH_NOISY}, f as (select review_id, cast(length({TEXT}) as double) as review_length,
cast({hits(BACK + 'S+', TEXT)} as double) as review_word_count, rating from noisy)"""
LONG = f"""{LENGTHS}, l as (select 'review_length' as feature, review_length as value from f union all
select 'review_word_count', review_word_count from f union all select 'rating', rating from f)"""
COLUMNS = ["review_length", "review_word_count", "rating"]


def lengths(spark, sf_dir):
    c = F.col("review")
    return noisy(spark, sf_dir).select(
        "review_id", "rating", fx.review_length(c).alias("review_length"), fx.word_count(c).alias("review_word_count")
    )


@query(
    "a01_value_counts",
    f"""{WITH_REVIEWS} select review_lang as value, count(*) as n from reviews
    where review_lang is not null group by review_lang""",
)
def a01(spark, sf_dir):
    return sm.value_counts(reviews(spark, sf_dir), "review_lang")


@query(
    "a01b_value_counts_listed",
    f"""{NORMAL} select v as value, count(review_id) as n
    from (values ('negative'), ('neutral'), ('positive')) t(v) left join n on s = v group by v""",
)
def a01b(spark, sf_dir):
    return sm.value_counts(normal(spark, sf_dir), "sentiment", ["negative", "neutral", "positive"])


@query(
    "a02_language_shares",
    f"""{WITH_REVIEWS}, t as (select case when review_id % 211 = 0 then 'nl' when review_id % 307 = 1 then 'pt'
      else review_lang end as l from reviews), c as (select l, count(*) as n from t group by l),
    s as (select case when n / (select sum(n) from c) < 0.008 then 'Other' else l end as value, n from c)
    select value, cast(sum(n) as bigint) as n, round(sum(n) / (select sum(n) from c) * 100, 1) as percentage
    from s group by value""",
)
def a02(spark, sf_dir):
    rare = F.when(F.col("review_id") % 211 == 0, "nl").when(F.col("review_id") % 307 == 1, "pt")
    df = reviews(spark, sf_dir).select(rare.otherwise(F.col("review_lang")).alias("language"))
    return sm.shares(df, "language")


@query(
    "a03_describe",
    f"""{LONG} select feature, count(value) as count, round(avg(value), 6) as mean,
    round(stddev_samp(value), 6) as std, min(value) as min, round(quantile_cont(value, 0.25), 6) as q25,
    round(quantile_cont(value, 0.5), 6) as q50, round(quantile_cont(value, 0.75), 6) as q75, max(value) as max
    from l group by feature""",
)
def a03(spark, sf_dir):
    df = sm.describe(lengths(spark, sf_dir), COLUMNS)
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")}
    return df.withColumns(rounded)


@query(
    "a04_medians",
    f"{LONG} select feature, round(median(value), 6) as median from l where feature <> 'rating' group by feature",
)
def a04(spark, sf_dir):
    df = sm.medians(lengths(spark, sf_dir), COLUMNS[:2])
    return df.select("feature", F.round("median", 6).alias("median"))


@query(
    "a05_histogram",
    f"""{LENGTHS}, m as (select min(review_length) as lo, max(review_length) as hi from f),
    b as (select least(cast(floor((review_length - lo) / ((hi - lo) / 50)) as int), 49) as bin from f, m),
    c as (select bin, count(*) as n from b group by bin)
    select cast(i as int) as bin, round(lo + i * ((hi - lo) / 50), 6) as low,
      round(lo + (i + 1) * ((hi - lo) / 50), 6) as high, coalesce(n, 0) as n
    from range(50) t(i) left join c on bin = i, m""",
)
def a05(spark, sf_dir):
    df = sm.histogram(lengths(spark, sf_dir), "review_length", 50)
    return df.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(
    "a06_box_statistics",
    f"""{LONG}, q as (select feature, quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as q50,
      quantile_cont(value, 0.75) as q75 from l group by feature),
    w as (select l.feature, q25, q50, q75, value, value >= q25 - 1.5 * (q75 - q25)
      and value <= q75 + 1.5 * (q75 - q25) as inside from l join q using (feature))
    select feature, q25, q50, q75, min(value) filter (inside) as whisker_low,
      max(value) filter (inside) as whisker_high, count(*) filter (not inside) as n_outside
    from w group by feature, q25, q50, q75""",
)
def a06(spark, sf_dir):
    return sm.box_statistics(lengths(spark, sf_dir), COLUMNS)


@query("a07_value_frequencies", f"{LONG} select feature, value, count(*) as n from l group by feature, value")
def a07(spark, sf_dir):
    return sm.value_frequencies(lengths(spark, sf_dir), COLUMNS)


RATINGS = [1.0, 2.0, 3.0, 4.0, 5.0]


@query(
    "a08_crosstab",
    f"""{NORMAL} select s as sentiment, """
    + ", ".join(f"count(*) filter (rating = {r}) as r{int(r)}" for r in RATINGS)
    + " from n group by s",
)
def a08(spark, sf_dir):
    df = sm.crosstab(normal(spark, sf_dir), "sentiment", "rating", RATINGS)
    return df.toDF("sentiment", *[f"r{int(r)}" for r in RATINGS])


@query(
    "a09_crosstab_shares",
    f"""{NORMAL}, u as (select s, coalesce(len(list_filter(regexp_extract_all(review, '\\S+'),
      lambda w: regexp_full_match(w, '\\p{{L}}+') and w = upper(w) and w <> lower(w)))
      / nullif(len(regexp_extract_all(review, '\\S+')), 0) > 0.5, false) as up from n)
    select s as sentiment, count(*) filter (not up) / count(*) as mixed, count(*) filter (up) / count(*) as upper
    from u group by s""",
)
def a09(spark, sf_dir):
    df = normal(spark, sf_dir).withColumn("up", fx.mostly_uppercase_words(F.col("review")))
    return sm.crosstab_shares(df, "sentiment", "up", [False, True]).toDF("sentiment", "mixed", "upper")


@query("a12_distinct_values", f"{WITH_REVIEWS} select distinct sentiment from reviews")
def a12(spark, sf_dir):
    return sm.distinct_values(reviews(spark, sf_dir), "sentiment")


@query(
    "a13_monthly_volume",
    f"""{WITH_NOISY}, d as (select review, case when month(review_date) <> 6 then review_date end as review_date from noisy),
    c as (select date_trunc('month', review_date) as m, count(review) as n from d where review_date is not null group by 1),
    s as (select unnest(generate_series((select min(m) from c)::timestamp, (select max(m) from c)::timestamp,
      interval 1 month)) as m)
    select cast(last_day(s.m) as varchar) as month_end, coalesce(n, 0) as n from s left join c on s.m = c.m""",
)
def a13(spark, sf_dir):
    # no June, so that empty months occur
    dated = F.when(F.month("review_date") != 6, F.col("review_date"))
    return sm.monthly_volume(noisy(spark, sf_dir).withColumn("review_date", dated)).withColumn("month_end", F.col("month_end").cast("string"))


@query(
    "a15_correlations",
    f"""{LENGTHS}, g as (select f.review_length as a0, f.rating as a1, case lower(trim(sentiment))
      when 'negative' then -1.0 when 'neutral' then 0.0 when 'positive' then 1.0 end as a2
      from f join noisy using (review_id)),
    m as (select corr(a0, a1) as r01, corr(a0, a2) as r02, corr(a1, a2) as r12 from g)
    select a, b, round(r, 6) as r from (
      select 'review_length' as a, 'rating' as b, r01 as r from m union all
      select 'rating', 'review_length', r01 from m union all
      select 'review_length', 'sentiment_numeric', r02 from m union all
      select 'sentiment_numeric', 'review_length', r02 from m union all
      select 'rating', 'sentiment_numeric', r12 from m union all
      select 'sentiment_numeric', 'rating', r12 from m union all
      select v, v, 1.0 from (values ('review_length'), ('rating'), ('sentiment_numeric')) t(v))""",
)
def a15(spark, sf_dir):
    df = normal(spark, sf_dir).select(
        "rating",
        fx.review_length(F.col("review")).alias("review_length"),
        lookup(F.col("sentiment"), SENTIMENT_VALUE).alias("sentiment_numeric"),
    )
    out = sm.correlations(df, ["review_length", "rating", "sentiment_numeric"])
    return out.withColumn("r", F.round("r", 6))


@query(
    "a16_exact_duplicates",
    f"""{WITH_NOISY} select count(*) - count(distinct coalesce(review, chr(1))) as n_duplicates from noisy""",
)
def a16(spark, sf_dir):
    return copies.copy_count(noisy(spark, sf_dir), "review_id", "review")


@query("a18_total_emoji", f"""{NORMAL} select cast(sum({hits(PICTURES, "coalesce(review, '')")}) as bigint) as total
from n where s = 'neutral'""")
def a18(spark, sf_dir):
    df = filters.keep_neutral(normal(spark, sf_dir))
    return df.agg(F.sum(emoji.emoji_count(F.coalesce("review", F.lit("")))).alias("total"))


@query(
    "a19_dropped_per_step",
    f"""{NORMAL}, k as (select s = 'negative' as k0, coalesce(not ({hits(BACK + 'S+', 'review')} <= 1
      and lower(trim(review)) in {JUNK9}), true) as k1, {hits(BACK + 'S+', TEXT)} >= 3 as k2 from n)
    select cast(0 as int) as step, 'sentiment' as name, count(*) filter (not k0) as dropped from k union all
    select 1, 'junk', count(*) filter (k0 and not k1) from k union all
    select 2, 'short', count(*) filter (k0 and k1 and not k2) from k""",
)
def a19(spark, sf_dir):
    c = F.col("review")
    steps = {
        "sentiment": F.col("sentiment") == "negative",
        "junk": ~filters.is_single_junk_word(c),
        "short": fx.word_count(c) >= 3,
    }
    return sm.funnel(normal(spark, sf_dir), steps)


@query(
    "a20_sentiment_of_short",
    f"{NORMAL} select s as value, count(*) as n from n where length({TEXT}) < 20 group by s",
)
def a20(spark, sf_dir):
    return sm.value_counts(filters.short_reviews(normal(spark, sf_dir)), "sentiment")


@query(
    "a21_foreign_counts",
    f"""{WITH_REVIEWS} select count(*) as foreign_rows, count(distinct lang) as foreign_languages
    from (select case when review_id % 10 <> 0 then review_lang end as lang from reviews)
    where lang <> '{HOME}' or lang is null""",
)
def a21(spark, sf_dir):
    lang = F.when(F.col("review_id") % 10 != 0, F.col("review_lang"))
    return sm.foreign_counts(reviews(spark, sf_dir).select(lang.alias("language")), "language", HOME)


@query(
    "w01_later_copies",
    f"""{WITH_NOISY} select review_id from (select review_id, row_number() over (partition by review
    order by review_id) as k from noisy) where k > 1""",
)
def w01(spark, sf_dir):
    return copies.later_copies(noisy(spark, sf_dir), "review_id", "review").select("review_id")


@query(
    "w02_all_copies",
    f"""{WITH_NOISY} select review_id, length({TEXT}) > 20 as longer_than_20 from (select review_id, review,
    count(*) over (partition by review) as k from noisy) where k > 1""",
)
def w02(spark, sf_dir):
    return copies.all_copies(noisy(spark, sf_dir), "review_id", "review").select(
        "review_id", (fx.review_length(F.col("review")) > 20).alias("longer_than_20")
    )


@query(
    "w03_share_of_total",
    f"""{NORMAL} select s as value, count(*) as n, count(*) / sum(count(*)) over () as share from n group by s""",
)
def w03(spark, sf_dir):
    return sm.share_of_total(sm.value_counts(normal(spark, sf_dir), "sentiment"))
