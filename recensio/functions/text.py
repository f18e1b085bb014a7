"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.functions import patterns
from recensio.functions.emoji import emoji_to_alias

# Masks.
URL_MASK = "<URL>"
USER_MASK = "<USER>"
PROFILES = ("main", "legacy", "emoji_last")


def squeeze_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, patterns.SPACE + "+", " "))


def mask_urls(text: Column, mask: str = URL_MASK) -> Column:
    return F.regexp_replace(text, patterns.URL, mask)


def mask_mentions(text: Column, mask: str = USER_MASK) -> Column:
    return F.regexp_replace(text, patterns.MENTION, mask)


def squeeze_runs(text: Column) -> Column:
    """Three or more of one character become two; newlines are left alone."""
    return F.regexp_replace(text, patterns.RUN, "$1$1")


def clean_text(text: Column, profile: str = "main") -> Column:
    """Clean one text column; null becomes the empty string.

    ``main`` names emoji first, ``legacy`` has no emoji step and puts a space
    after a masked URL, ``emoji_last`` names emoji after everything else.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; use one of {PROFILES}")
    out = emoji_to_alias(text) if profile == "main" else text
    out = squeeze_space(out)
    out = mask_urls(out, URL_MASK + " " if profile == "legacy" else URL_MASK)
    out = squeeze_runs(mask_mentions(out))
    if profile == "emoji_last":
        out = emoji_to_alias(out)
    return F.coalesce(out, F.lit(""))


def normalize_sentiment(sentiment: Column, strip: bool = True) -> Column:
    """Lower case; a missing value becomes the word ``nan``."""
    text = F.lower(sentiment.cast("string"))
    if strip:
        text = F.regexp_replace(text, patterns.EDGE_SPACE, "")
    return F.coalesce(text, F.lit("nan"))


def basic_cleaning(
    df: DataFrame, text_column: str = "review", target_column: str = "clean_text", profile: str = "main"
) -> DataFrame:
    """Add the cleaned text and, where there is one, normalise the sentiment."""
    out = df.withColumn(target_column, clean_text(F.col(text_column), profile))
    if "sentiment" in df.columns:
        out = out.withColumn("sentiment", normalize_sentiment(F.col("sentiment")))
    return out


def lookup(column: Column, values: dict, default: Column | None = None) -> Column:
    """Value of a small fixed map; without default, unknown keys give null."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    found = F.create_map(*pairs)[column]
    return found if default is None else F.coalesce(found, default)


def swap_in_translation(
    df: DataFrame, text: str = "review", translated: str = "final_text", backup: str = "original_review"
) -> DataFrame:
    """Keep the original under ``backup`` and let ``text`` be the translation."""
    return df.withColumnsRenamed({text: backup}).withColumnsRenamed({translated: text})


def corpus(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key), F.col(text).cast("string").alias("text"))


def parse_date(text: Column) -> Column:
    """The date that a text spells, else null."""
    return F.try_to_date(text)


def epoch_seconds(date: Column) -> Column:
    """Seconds from 1970 to the start of the day; -1 without a date."""
    return F.coalesce(F.unix_date(date).cast("long") * 86400, F.lit(-1))
