"""Cleaning and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from recensio.catalog.base import HOME, WITH_NOISY, WITH_REVIEWS, noisy, query, reviews, table
from recensio.functions import text as fn
from recensio.functions import wordlists
from recensio.functions.emoji import emoji_to_alias
from recensio.operators import labels
from recensio.operators.scale import number_rows

WORD = r"[\p{L}\p{N}_]"


def alias_sql(x: str) -> str:
    for emoji, name in [
        ("👍🏽", "thumbs_up_medium_skin_tone"),
        ("👍", "thumbs_up"),
        ("❤️", "red_heart"),
        ("😡", "enraged_face"),
        ("🇮🇹", "Italy"),
    ]:
        x = f"replace({x}, '{emoji}', ' :{name}: ')"
    return x


def space_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def masks_sql(x: str, url: str = "<URL>") -> str:
    return f"regexp_replace(regexp_replace({x}, 'http\\S+', '{url}', 'g'), '@{WORD}+', '<USER>', 'g')"


def runs_sql(source: str) -> str:
    """CTEs from ``source(id, x)`` to ``squeezed(id, y)``; no back-references."""
    return f"""
chars as (select id, unnest(ch) as c, generate_subscripts(ch, 1) as pos
          from (select id, regexp_extract_all(x, '(?s).') as ch from {source})),
lagged as (select id, pos, c, lag(c, 1) over w as l1, lag(c, 2) over w as l2, lag(c, 3) over w as l3
           from chars window w as (partition by id order by pos)),
squeezed as (select s.id, coalesce(y, case when s.x is null then null else '' end) as y
  from {source} s left join (
    select id, string_agg(c, '' order by pos) as y from lagged
    where not coalesce(c <> chr(10) and c = l1 and c = l2, false) group by id) t on s.id = t.id)"""


def one(function, name):
    def run(spark, sf_dir):
        return noisy(spark, sf_dir).select("review_id", function(F.col("review")).alias(name))

    return run


def source_sql(x: str) -> str:
    return f"{WITH_NOISY}, src as (select review_id as id, {x} as x from noisy)"



query(
    "t01_clean_text",
    source_sql(masks_sql(space_sql(alias_sql("review"))))
    + f", {runs_sql('src')} select id as review_id, coalesce(y, '') as clean_text from squeezed",
)(one(fn.clean_text, "clean_text"))

query("t01a_emoji_alias", f"{WITH_NOISY} select review_id, {alias_sql('review')} as text from noisy")(
    one(emoji_to_alias, "text")
)

# sequences and the name that each has as a whole
SEQUENCE_NAMES = [
    ("\U0001f3f4" + "".join(chr(0xE0000 + ord(c)) for c in "gbeng") + "\U000e007f", "England"),
    ("\U0001f3f4" + "".join(chr(0xE0000 + ord(c)) for c in "gbwls") + "\U000e007f", "Wales"),
    ("👨\u200d👩\u200d👧\u200d👦", "family_man_woman_girl_boy"),
    ("👩\u200d❤\ufe0f\u200d👨", "couple_with_heart_woman_man"),
    ("👩🏽\u200d💻", "woman_technologist_medium_skin_tone"),
    ("🧑\u200d🚒", "firefighter"),
    ("🤦🏻\u200d♂\ufe0f", "man_facepalming_light_skin_tone"),
    ("❤\ufe0f\u200d🔥", "heart_on_fire"),
    ("🏳\ufe0f\u200d🌈", "rainbow_flag"),
]


def sequence_cases(position: int) -> str:
    whens = " ".join(f"when {k} then '{pair[position]}'" for k, pair in enumerate(SEQUENCE_NAMES))
    return f"case review_id % {len(SEQUENCE_NAMES)} {whens} end"


@query(
    "t01a2_emoji_sequences",
    f"""{WITH_NOISY} select review_id, concat(' :', {sequence_cases(1)}, ': ', {alias_sql('review')},
    ' :', {sequence_cases(1)}, ':  :thumbs_up: ') as text from noisy where review is not null""",
)
def t01a2(spark, sf_dir):
    df = noisy(spark, sf_dir).filter("review is not null")
    text = F.concat(F.expr(sequence_cases(0)), "review", F.expr(sequence_cases(0)), F.lit("👍"))
    return df.select("review_id", emoji_to_alias(text).alias("text"))


query("t01b_squeeze_space", f"{WITH_NOISY} select review_id, {space_sql('review')} as text from noisy")(
    one(fn.squeeze_space, "text")
)

query(
    "t01c_mask_urls",
    f"{WITH_NOISY} select review_id, regexp_replace(review, 'http\\S+', '<URL>', 'g') as text from noisy",
)(one(fn.mask_urls, "text"))

query(
    "t01d_mask_mentions",
    f"{WITH_NOISY} select review_id, regexp_replace(review, '@{WORD}+', '<USER>', 'g') as text from noisy",
)(one(fn.mask_mentions, "text"))

query(
    "t01e_squeeze_runs",
    source_sql("review") + f", {runs_sql('src')} select id as review_id, y as text from squeezed",
)(one(fn.squeeze_runs, "text"))

query(
    "t02_clean_legacy",
    source_sql(masks_sql(space_sql("review"), "<URL> "))
    + f", {runs_sql('src')} select id as review_id, coalesce(y, '') as clean_text from squeezed",
)(one(lambda c: fn.clean_text(c, "legacy"), "clean_text"))

query(
    "t03_clean_emoji_last",
    source_sql(masks_sql(space_sql("review")))
    + f", {runs_sql('src')} select id as review_id, coalesce({alias_sql('y')}, '') as clean_text from squeezed",
)(one(lambda c: fn.clean_text(c, "emoji_last"), "clean_text"))


@query(
    "t04_normalize_sentiment",
    f"""{WITH_REVIEWS} select review_id, coalesce(lower(trim(sentiment)), 'nan') as sentiment,
    coalesce(lower(sentiment), 'nan') as sentiment_unstripped from reviews""",
)
def t04(spark, sf_dir):
    c = F.col("sentiment")
    return reviews(spark, sf_dir).select(
        "review_id",
        fn.normalize_sentiment(c).alias("sentiment"),
        fn.normalize_sentiment(c, strip=False).alias("sentiment_unstripped"),
    )


@query(
    "t05_sentiment_value",
    f"""{WITH_REVIEWS}, s as (select review_id, lower(trim(sentiment)) as v from reviews)
    select review_id,
      case v when 'negative' then '-1' when 'neutral' then '0' when 'positive' then '1' end as value_or_null,
      case v when 'negative' then -1 when 'positive' then 1 else 0 end as value_or_zero from s""",
)
def t05(spark, sf_dir):
    value = fn.normalize_sentiment(F.col("sentiment"))
    return reviews(spark, sf_dir).select(
        "review_id",
        fn.lookup(value, wordlists.SENTIMENT_VALUE).cast("string").alias("value_or_null"),
        fn.lookup(value, wordlists.SENTIMENT_VALUE, F.lit(0)).alias("value_or_zero"),
    )


@query(
    "t06_language_name",
    f"""{WITH_REVIEWS} select review_id, case review_lang when 'en' then 'English' when 'es' then 'Spanish'
    when 'fr' then 'French' when 'de' then 'German' else review_lang end as language_name
    from (select review_id, case when review_id % 10 = 0 then 'xx' else review_lang end as review_lang from reviews)""",
)
def t06(spark, sf_dir):
    code = F.when(F.col("review_id") % 10 == 0, "xx").otherwise(F.col("review_lang"))
    return reviews(spark, sf_dir).select(
        "review_id", fn.lookup(code, wordlists.LANGUAGE_NAME, code).alias("language_name")
    )


@query(
    "t07_translator_code",
    f"""{WITH_REVIEWS} select review_id, case review_lang when 'es' then 'spa_Latn' when 'fr' then 'fra_Latn'
    when 'de' then 'deu_Latn' else 'eng_Latn' end as translator_code
    from (select review_id, case when review_id % 10 = 0 then 'xx' else review_lang end as review_lang from reviews)""",
)
def t07(spark, sf_dir):
    code = F.when(F.col("review_id") % 10 == 0, "xx").otherwise(F.col("review_lang"))
    default = F.lit(wordlists.TRANSLATOR_CODE_DEFAULT)
    return reviews(spark, sf_dir).select(
        "review_id", fn.lookup(code, wordlists.TRANSLATOR_CODE, default).alias("translator_code")
    )


@query(
    "t08_swap_in_translation",
    f"""{WITH_REVIEWS} select review_id, review as original_review,
    case when review_lang = '{HOME}' then review else concat('[', review_lang, '] ', review) end as review from reviews""",
)
def t08(spark, sf_dir):
    translated = F.when(F.col("review_lang") == HOME, F.col("review")).otherwise(
        F.concat(F.lit("["), "review_lang", F.lit("] "), "review")
    )
    df = reviews(spark, sf_dir).select("review_id", "review", translated.alias("final_text"))
    return fn.swap_in_translation(df)


@query(
    "t09_parse_labels",
    f"""{WITH_REVIEWS} select review_id,
    case when labels like '[%' and labels like '%]'
      then array_to_string(regexp_extract_all(labels, chr(39) || '([^' || chr(39) || ']*)' || chr(39), 1), '|')
      else '' end as parsed_labels,
    cast(case when labels like '[%' and labels like '%]' then 2 else 0 end as int) as n_labels from reviews""",
)
def t09(spark, sf_dir):
    parsed = labels.parse_labels(F.col("labels"))
    return reviews(spark, sf_dir).select(
        "review_id", F.array_join(parsed, "|").alias("parsed_labels"), F.size(parsed).alias("n_labels")
    )


# Printed lists of other shapes than the reviews hold.
PRINTED_SQL = """select doc_id, case doc_id % 7
  when 0 then concat('[', chr(39), source, chr(39), ',]')
  when 1 then concat('[', chr(39), source, chr(39), ', None, 12]')
  when 2 then concat('[', chr(39), chr(92), 'x41', chr(92), 'u00e9', chr(39), ', "it', chr(39), 's"]')
  when 3 then concat('[', chr(39), 'a', chr(39), '] [', chr(39), 'b', chr(39), ']')
  when 4 then concat('["x', chr(92), '"y", ', chr(39), 'p', chr(92), chr(39), 'q', chr(39), ' ]')
  when 5 then '[ ]' else concat('[', chr(39), source, chr(39), ' ', source, ']') end as printed, source from documents"""


@query(
    "t09b_parse_odd_labels",
    """select doc_id, case doc_id % 7 when 0 then source when 1 then source || '|?|12'
      when 2 then concat('A', chr(233), '|it', chr(39), 's') when 4 then concat('x"y|p', chr(39), 'q') else '' end as parsed_labels,
    cast(case doc_id % 7 when 0 then 1 when 1 then 3 when 2 then 2 when 4 then 2 else 0 end as int) as n_labels
    from documents""",
)
def t09b(spark, sf_dir):
    sql = PRINTED_SQL.replace("from documents", "from {documents}")
    parsed = labels.parse_labels(F.col("printed"))
    return spark.sql(sql, documents=table(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join(parsed, "|", "?").alias("parsed_labels"), F.size(parsed).alias("n_labels")
    )


@query(
    "t10_parse_date",
    f"""{WITH_REVIEWS} select review_id, cast(try_cast(t as date) as varchar) as parsed from (
    select review_id, case when review_id % 17 = 0 then 'yesterday' else cast(review_date as varchar) end as t
    from reviews)""",
)
def t10(spark, sf_dir):
    raw = F.when(F.col("review_id") % 17 == 0, "yesterday").otherwise(F.col("review_date").cast("string"))
    return reviews(spark, sf_dir).select("review_id", fn.parse_date(raw).cast("string").alias("parsed"))


@query(
    "t11_epoch_seconds",
    f"""{WITH_REVIEWS} select review_id, coalesce(cast(epoch(review_date) as bigint), -1) as seconds
    from reviews""",
)
def t11(spark, sf_dir):
    return reviews(spark, sf_dir).select("review_id", fn.epoch_seconds(F.col("review_date")).alias("seconds"))


@query("t12_corpus", f"{WITH_NOISY} select review_id, review as text from noisy")
def t12(spark, sf_dir):
    return fn.corpus(noisy(spark, sf_dir), "review_id", "review")


@query("t13_projection", f"{WITH_REVIEWS} select review_id, review, sentiment, rating from reviews")
def t13(spark, sf_dir):
    return reviews(spark, sf_dir).select("review_id", "review", "sentiment", "rating")


@query(
    "t14_renumber_rows",
    f"""{WITH_REVIEWS} select review_id, row_number() over (order by review_id) - 1 as row_index
    from reviews where rating <= 2""",
)
def t14(spark, sf_dir):
    kept = reviews(spark, sf_dir).filter(F.col("rating") <= 2).select("review_id")
    return number_rows(kept, "review_id")
