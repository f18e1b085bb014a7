"""Row filters and flags; all push down to or run right after the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.functions import features, patterns, wordlists


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, patterns.EDGE_SPACE, "")


def keep_sentiment(df: DataFrame, wanted: Sequence[str], column: str = "sentiment") -> DataFrame:
    """Case-insensitive membership; missing sentiment is dropped."""
    return df.filter(F.lower(column).isin([w.lower() for w in wanted]))


def keep_negative(df: DataFrame, column: str = "sentiment") -> DataFrame:
    return df.filter(F.col(column) == "negative")


def keep_neutral(df: DataFrame, column: str = "sentiment") -> DataFrame:
    return df.filter(F.lower(column) == "neutral")


def is_single_junk_word(text: Column, words: Sequence[str] = wordlists.JUNK_WORDS) -> Column:
    single = features.word_count(text) <= 1
    return F.coalesce(single & _strip(F.lower(text)).isin(list(words)), F.lit(False))


def remove_junk(df: DataFrame, column: str = "clean_text", words: Sequence[str] = wordlists.JUNK_WORDS) -> DataFrame:
    return df.filter(~is_single_junk_word(F.col(column), words))


def remove_junk_legacy(df: DataFrame, column: str = "clean_text") -> DataFrame:
    """Single junk words, empty texts, and texts of punctuation only (masks stay)."""

    def kept(text: Column) -> Column:
        only_marks = text.rlike(patterns.ONLY_MARKS)
        return ~is_single_junk_word(text, wordlists.JUNK_WORDS_LEGACY) & (_strip(text) != "") & ~only_marks

    # a filter moves below the cleaning and would clean a text again for each condition
    return df.filter(features.let(F.col(column), kept))


def min_words(df: DataFrame, n: int, column: str = "review") -> DataFrame:
    return df.filter(features.word_count(F.col(column)) >= n)


def is_junk_review(text: Column) -> Column:
    """Missing, empty, without letter or digit, or one meaningless word."""
    bare = F.lower(F.regexp_replace(_strip(text), r"[^A-Za-z0-9àèéìòùç ]", ""))
    one_word = F.trim(bare)
    return (
        F.when(text.isNull(), True)
        .when(_strip(text) == "", True)
        .when(~text.rlike(r"[\p{L}\p{N}]"), True)
        .otherwise(one_word.isin(wordlists.MEANINGLESS_WORDS))
    )


def _any(rules: list[Column]) -> Column:
    flag = F.lit(False)
    for rule in rules:
        flag = flag | F.coalesce(rule, F.lit(False))
    return flag


def is_noisy(limits: dict[str, float] = wordlists.NOISE_LIMITS) -> Column:
    """Any feature column above its limit; a missing feature never counts."""
    return _any([F.col(name) > limit for name, limit in limits.items()])


def is_rule_outlier(
    above: dict[str, float] = wordlists.OUTLIER_ABOVE,
    below: dict[str, float] = wordlists.OUTLIER_BELOW,
    foreign: str = "is_foreign",
) -> Column:
    rules = [F.col(name) > limit for name, limit in above.items()]
    rules += [F.col(name) < limit for name, limit in below.items()]
    return _any([*rules, F.col(foreign)])


def short_reviews(df: DataFrame, column: str = "review", below: int = 20) -> DataFrame:
    return df.filter(features.review_length(F.col(column)) < below)


def rating_mismatch(sentiment: Column, rating: Column) -> Column:
    """Negative text with the best rating, or positive with the worst."""
    return ((sentiment == "negative") & (rating == 5.0)) | ((sentiment == "positive") & (rating == 1.0))


def low_rating(df: DataFrame, column: str = "rating", limit: float = 2) -> DataFrame:
    return df.filter(F.col(column) <= limit)


def keep_language(df: DataFrame, language: str, column: str = "language") -> DataFrame:
    return df.filter(F.col(column) == language)


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def sample_rows(df: DataFrame, key: str, n: int = 10, seed: int = 42) -> DataFrame:
    """Repeatable random sample of at most ``n`` rows."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def foreign_rows(df: DataFrame, column: str = "language", home: str = "it") -> DataFrame:
    """Rows with a known language other than ``home``."""
    return df.filter((F.col(column) != home) & (F.col(column) != "unknown"))
