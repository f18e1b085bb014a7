"""Feature and filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recensio.catalog.base import HOME, WITH_NOISY, WITH_REVIEWS, noisy, query, reviews
from recensio.catalog.text import WORD, masks_sql, runs_sql, space_sql
from recensio.functions import emoji, features as fx, text as fn
from recensio.operators import filters, rarity

PUNCT = r"[^\p{L}\p{N}_\s\p{Z}]"
PICTURES = "(?:👍🏽|👍|❤️|😡|🇮🇹)"


def hits(pattern: str, x: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


TEXT = "coalesce(review, 'nan')"
RUNS_CTE = f"""{WITH_NOISY}, src as (select review_id as id, {TEXT} as x from noisy), {runs_sql('src')},
runs as (select id, count(*) as n from lagged
  where c <> chr(10) and c = l1 and c = l2 and (l3 is null or l3 <> c) group by id)"""
ENTROPY_CTE = f"""words as (select review_id, unnest(regexp_extract_all({TEXT}, '\\S+')) as w from noisy),
freq as (select review_id, w, count(*) as c from words group by all),
total as (select review_id, sum(c) as n from freq group by all),
entropy as (select review_id, round(abs(sum(c / n * log2(c / n))), 6) as e
            from freq join total using (review_id) group by review_id)"""
RARE_CTE = f"""docs as (select review_id, regexp_extract_all(lower({TEXT}), '{WORD}{{2,}}') as ts from noisy),
dfs as (select t, count(distinct review_id) as df from (select review_id, unnest(ts) as t from docs) group by t
        having count(distinct review_id) >= 5),
vocab as (select t, ln((1.0 + (select count(*) from noisy)) / (1.0 + df)) + 1.0 as idf from dfs),
cut as (select quantile_cont(idf, 0.9) as q, max(idf) as top from vocab),
raw as (select review_id, unnest(regexp_extract_all(review, '\\S+')) as t from noisy where review is not null),
ratio as (select review_id, avg(cast(coalesce(idf, (select top from cut)) > (select q from cut) as int)) as r
          from raw left join vocab using (t) group by review_id)"""

SIMPLE = {
    "x01_review_length": ("review_length", fx.review_length, f"length({TEXT})"),
    "x02_word_count": ("review_word_count", fx.word_count, hits(r"\S+", TEXT)),
    "x03_tokens": (
        "tokens",
        lambda c: F.array_join(fx.tokens(c), " "),
        f"array_to_string(regexp_extract_all(review, '{WORD}+|{PUNCT}'), ' ')",
    ),
    "x04_punctuation_count": ("punctuation_count", fx.punctuation_count, hits(PUNCT, "review")),
    "x05_emoji_count": ("emoji_count", emoji.emoji_count, hits(PICTURES, "review")),
    "x06_emoji_list": (
        "emoji_list",
        lambda c: F.array_join(emoji.emoji_list(c), " "),
        f"array_to_string(regexp_extract_all(review, '{PICTURES}'), ' ')",
    ),
    "x07_url_count": ("url_count", fx.url_count, hits(r"http\S+|www\.\S+", TEXT)),
    "x08_hashtag_count": ("hashtag_count", fx.hashtag_count, f"length({TEXT}) - length(replace({TEXT}, '#', ''))"),
    "x10_uppercase_ratio": (
        "uppercase_ratio",
        fx.uppercase_ratio,
        f"coalesce({hits('[[:upper:]]|' + chr(92) + 'p{Lu}', TEXT)} / nullif(length({TEXT}), 0), 0.0)",
    ),
    "x11_uppercase_words": (
        "mostly_uppercase",
        fx.mostly_uppercase_words,
        """coalesce(len(list_filter(regexp_extract_all(review, '\\S+'),
          lambda w: regexp_full_match(w, '\\p{L}+') and w = upper(w) and w <> lower(w)))
          / nullif(len(regexp_extract_all(review, '\\S+')), 0) > 0.5, false)""",
    ),
    "x12_special_char_count": ("special_char_count", fx.special_char_count, hits(r"[^\p{L}\p{N} ]", TEXT)),
    "x13_digit_ratio": ("digit_ratio", fx.digit_ratio, f"{hits(chr(92) + 'p{Nd}', TEXT)} / greatest(1, length({TEXT}))"),
}


def _simple(column, make):
    def run(spark, sf_dir):
        return noisy(spark, sf_dir).select("review_id", make(F.col("review")).alias(column))

    return run


# Counts that stay null for a missing review show as -1 in the comparison.
NULL_STAYS = {"punctuation_count", "emoji_count"}


def _shown(make):
    return lambda c: F.coalesce(make(c), F.lit(-1))


for _name, (_column, _make, _sql) in SIMPLE.items():
    if _column.endswith(("_count", "_length")):
        _sql = f"cast({_sql} as int)"
    if _column in NULL_STAYS:
        _make, _sql = _shown(_make), f"cast(coalesce({_sql}, -1) as int)"
    query(_name, f"{WITH_NOISY} select review_id, {_sql} as {_column} from noisy")(_simple(_column, _make))

query("x09_repeated_chars", RUNS_CTE + """ select review_id, cast(coalesce(n, 0) as int) as repeated_chars
from noisy left join runs on review_id = id""")(_simple("repeated_chars", fx.repeated_chars))


@query(
    "x14_is_foreign",
    f"""{WITH_REVIEWS} select review_id, coalesce(lang <> '{HOME}', true) as is_foreign
    from (select review_id, case when review_id % 10 = 0 then null else review_lang end as lang from reviews)""",
)
def x14(spark, sf_dir):
    lang = F.when(F.col("review_id") % 10 != 0, F.col("review_lang"))
    return reviews(spark, sf_dir).select("review_id", fx.is_foreign(lang, HOME).alias("is_foreign"))


@query(
    "x15_rare_token_ratio",
    f"""{WITH_NOISY}, {RARE_CTE} select review_id,
    round(case when review is null then 0.0 else coalesce(r, -1.0) end, 6) as rare_token_ratio
    from noisy left join ratio using (review_id)""",
)
def x15(spark, sf_dir):
    ratio = rarity.rare_token_ratio(noisy(spark, sf_dir), "review_id", "review")
    # text without words has no ratio; -1 stands for it in the comparison
    value = F.round(F.coalesce("rare_token_ratio", F.lit(-1.0)), 6)
    return ratio.select("review_id", value.alias("rare_token_ratio"))


@query(
    "x16_token_entropy",
    f"""{WITH_NOISY}, {ENTROPY_CTE} select review_id, coalesce(e, 0.0) as token_entropy
    from noisy left join entropy using (review_id)""",
)
def x16(spark, sf_dir):
    return noisy(spark, sf_dir).select(
        "review_id", F.round(fx.token_entropy(F.col("review")), 6).alias("token_entropy")
    )


def _ids(name, sql, keep):
    @query(name, sql)
    def run(spark, sf_dir):
        return keep(spark, sf_dir).select("review_id")


NORMAL = f"{WITH_NOISY}, n as (select *, coalesce(lower(trim(sentiment)), 'nan') as s from noisy)"


def normal(spark, sf_dir):
    """Noisy reviews with normalised sentiment; no text work needed yet."""
    return noisy(spark, sf_dir).withColumn("sentiment", fn.normalize_sentiment(F.col("sentiment")))


_ids("f01_keep_negative", f"{NORMAL} select review_id from n where s = 'negative'",
     lambda s, d: filters.keep_negative(normal(s, d)))
_ids("f02_keep_sentiments",
     f"{WITH_NOISY} select review_id from noisy where lower(sentiment) in ('negative', 'neutral')",
     lambda s, d: filters.keep_sentiment(noisy(s, d), ["Negative", "NEUTRAL"]))
_ids("f03_keep_neutral", f"{NORMAL} select review_id from n where s = 'neutral'",
     lambda s, d: filters.keep_neutral(normal(s, d)))

JUNK9 = "('ok','pessima','bella','sconsigliata','bene','boh','bleah','male','top')"
JUNK8 = "('ok','pessima','bella','sconsigliata','bene','boh','bleah','male')"
JUNK18 = ("('ok','okay','si','no','mah','boh','ciao','hello','hi','hey','bene','male','bravo','nice',"
          "'good','bad','pessima','scadente')")


def _cleaned(s, d, profile="main"):
    return fn.basic_cleaning(noisy(s, d), profile=profile)


_ids("f04_remove_junk", f"""{WITH_NOISY}, c as (select review_id, coalesce({space_sql('review')}, '') as x from noisy)
select review_id from c where not ({hits(chr(92) + 'S+', 'x')} <= 1 and lower(x) in {JUNK9})""",
     lambda s, d: filters.remove_junk(_cleaned(s, d)))
_ids("f05_remove_junk_legacy", f"""{WITH_NOISY},
c as (select review_id, coalesce({masks_sql(space_sql('review'), '<URL> ')}, '') as x from noisy)
select review_id from c where not ({hits(chr(92) + 'S+', 'x')} = 1 and lower(x) in {JUNK8}) and trim(x) <> ''
and (x like '<URL>%' or x like '<USER>%' or not regexp_full_match(x, '[^\\p{{L}}\\p{{N}}]+'))""",
     lambda s, d: filters.remove_junk_legacy(_cleaned(s, d, "legacy")))
_ids("f06_min_words", f"{WITH_NOISY} select review_id from noisy where {hits(chr(92) + 'S+', TEXT)} >= 3",
     lambda s, d: filters.min_words(noisy(s, d), 3))


@query(
    "f07_is_junk_review",
    f"""{WITH_NOISY}, c as (select review_id, review,
      trim(lower(regexp_replace(review, '[^A-Za-z0-9àèéìòùç ]', '', 'g'))) as bare from noisy)
    select review_id, (review is null or trim(review) = '' or not regexp_matches(review, '[\\p{{L}}\\p{{N}}]')
      or (len(string_split(bare, ' ')) = 1 and bare in {JUNK18})) as is_junk_review from c""",
)
def f07(spark, sf_dir):
    return noisy(spark, sf_dir).select(
        "review_id", filters.is_junk_review(F.col("review")).alias("is_junk_review")
    )


NOISE_SQL = f"""coalesce({hits(PICTURES, 'review')} > 2, false) or {hits('http' + chr(92) + 'S+|www' + chr(92) + '.' + chr(92) + 'S+', TEXT)} > 0
or contains({TEXT}, '#') or coalesce(n, 0) > 2
or coalesce({hits(chr(92) + 'p{Lu}', TEXT)} / nullif(length({TEXT}), 0), 0.0) > 0.5"""


@query(
    "f08_is_noisy_review",
    f"{RUNS_CTE} select review_id, ({NOISE_SQL}) as is_noisy from noisy left join runs on review_id = id",
)
def f08(spark, sf_dir):
    df = fx.add_features(noisy(spark, sf_dir))
    return df.select("review_id", filters.is_noisy().alias("is_noisy"))


@query(
    "f09_is_rule_outlier",
    f"""{RUNS_CTE}, {ENTROPY_CTE}, {RARE_CTE}
    select noisy.review_id, ({NOISE_SQL} or length({TEXT}) < 15 or {hits(chr(92) + 'S+', TEXT)} < 3
      or length({TEXT}) > 600 or {hits('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N} ]', TEXT)} > 15
      or {hits(chr(92) + 'p{Nd}', TEXT)} / greatest(1, length({TEXT})) > 0.3
      or coalesce(case when review is null then 0.0 else r end > 0.4, false)
      or coalesce(e, 0.0) < 1.2 or review_lang <> '{HOME}') as is_rule_outlier
    from noisy left join runs on noisy.review_id = id left join ratio on noisy.review_id = ratio.review_id
    left join entropy on noisy.review_id = entropy.review_id""",
)
def f09(spark, sf_dir):
    df = noisy(spark, sf_dir)
    ratio = rarity.rare_token_ratio(df, "review_id", "review")
    featured = fx.add_features(df, language="review_lang", home=HOME).join(ratio, "review_id")
    return featured.select("review_id", filters.is_rule_outlier().alias("is_rule_outlier"))


_ids("f10_short_reviews", f"{WITH_NOISY} select review_id from noisy where length({TEXT}) < 20",
     lambda s, d: filters.short_reviews(noisy(s, d)))
_ids("f11_rating_mismatch", f"""{WITH_REVIEWS}, t as (select review_id, rating, case when review_id % 3 = 0
then 'positive' else 'negative' end as s from reviews)
select review_id from t where (s = 'negative' and rating = 5.0) or (s = 'positive' and rating = 1.0)""",
     lambda s, d: reviews(s, d).filter(filters.rating_mismatch(
         F.when(F.col("review_id") % 3 == 0, "positive").otherwise("negative"), F.col("rating"))))
_ids("f12_low_rating", f"{WITH_REVIEWS} select review_id from reviews where rating <= 2",
     lambda s, d: filters.low_rating(reviews(s, d)))
_ids("f13_keep_language", f"{WITH_REVIEWS} select review_id from reviews where review_lang = '{HOME}'",
     lambda s, d: filters.keep_language(reviews(s, d), HOME, "review_lang"))
_ids("f14_drop_missing", f"""{WITH_REVIEWS} select review_id from reviews
where sentiment is not null and labels is not null and review_date is not null""",
     lambda s, d: filters.drop_missing(reviews(s, d), ["sentiment", "labels", "review_date"]))
_ids("f14b_drop_missing_any", f"""{WITH_NOISY} select review_id from noisy where sentiment is not null
and labels is not null and review_date is not null and review is not null""",
     lambda s, d: filters.drop_missing(noisy(s, d)))


@query("f15_sample_rows")
def f15(spark, sf_dir):
    short = filters.short_reviews(noisy(spark, sf_dir))
    return filters.sample_rows(short.select("review_id", "review"), "review_id", 10)


_ids("f16_foreign_rows", f"""{WITH_REVIEWS}, t as (select review_id, case when review_id % 10 = 0 then 'unknown'
when review_id % 10 = 1 then null else review_lang end as lang from reviews)
select review_id from t where lang <> '{HOME}' and lang <> 'unknown'""",
     lambda s, d: filters.foreign_rows(reviews(s, d).withColumn("language",
         F.when(F.col("review_id") % 10 == 0, "unknown").when(F.col("review_id") % 10 != 1, F.col("review_lang"))),
         home=HOME))
