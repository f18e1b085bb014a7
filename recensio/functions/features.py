"""Structural and noise features of a text, all row-local.

Columns marked "as text" count a missing review as the word ``nan``; the others
stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.functions import patterns
from recensio.functions.emoji import emoji_count


def as_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("nan"))


def count_of(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def review_length(text: Column) -> Column:
    return F.char_length(as_text(text))


def word_count(text: Column) -> Column:
    return count_of(patterns.NOT_SPACE + "+", as_text(text))


def words(text: Column) -> Column:
    """Whitespace-separated tokens; empty text gives an empty array."""
    return F.regexp_extract_all(text, F.lit(patterns.NOT_SPACE + "+"), F.lit(0))


def tokens(text: Column) -> Column:
    """Words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(f"{patterns.WORD}+|{patterns.PUNCTUATION}"), F.lit(0))


def terms(text: Column) -> Column:
    """Lower-cased words of two or more characters, as term weighting sees them."""
    return F.regexp_extract_all(F.lower(as_text(text)), F.lit(patterns.TERM), F.lit(0))


def punctuation_count(text: Column) -> Column:
    return count_of(patterns.PUNCTUATION, text)


def url_count(text: Column) -> Column:
    return count_of(patterns.URL_OR_WWW, as_text(text))


def hashtag_count(text: Column) -> Column:
    return count_of("#", as_text(text))


def repeated_chars(text: Column) -> Column:
    return count_of(patterns.RUN, as_text(text))


def uppercase_ratio(text: Column) -> Column:
    upper = count_of(r"\p{IsUppercase}", as_text(text))
    return F.coalesce(upper / F.nullif(review_length(text), F.lit(0)), F.lit(0.0))


def mostly_uppercase_words(text: Column) -> Column:
    """More than half of the words are all letters and all upper case."""
    all_words = words(text)
    shouted = F.filter(
        all_words, lambda w: w.rlike(r"^\p{L}+$") & (w == F.upper(w)) & (w != F.lower(w))
    )
    return F.coalesce(F.size(shouted) / F.nullif(F.size(all_words), F.lit(0)) > 0.5, F.lit(False))


def special_char_count(text: Column) -> Column:
    return count_of(r"[^\p{L}\p{N} ]", as_text(text))


def digit_ratio(text: Column) -> Column:
    return count_of(r"\p{Nd}", as_text(text)) / F.greatest(F.lit(1), review_length(text))


def is_foreign(language: Column, home: str = "it") -> Column:
    """Missing language counts as foreign."""
    return ~language.eqNullSafe(F.lit(home))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Inside a lambda an outer expression is computed again for every element;
    a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def term_counts(tokens: Column) -> Column:
    """``array<struct<term,tf>>`` of an array, by sorting it; no shuffle needed.

    The positions where a new term starts in the sorted array give the counts.
    """

    def count(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - start).alias("tf"),
                ),
            ),
        )

    none = F.array().cast("array<struct<term:string,tf:int>>")
    return let(F.array_sort(tokens), lambda o: F.when(F.size(o) > 0, count(o)).otherwise(none))


def token_entropy(text: Column) -> Column:
    """Entropy in bits of the word distribution; empty text gives 0."""

    def bits(counts: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c["tf"])
        return let(
            n,
            lambda total: F.aggregate(
                counts,
                F.lit(0.0),
                lambda acc, c: acc - (c["tf"] / total) * F.log2(c["tf"] / total),
            ),
        )

    return F.abs(let(term_counts(words(as_text(text))), bits))


NOISE_FEATURES = {
    "emoji_count": emoji_count,
    "url_count": url_count,
    "hashtag_count": hashtag_count,
    "repeated_chars": repeated_chars,
    "uppercase_ratio": uppercase_ratio,
    "punctuation_count": punctuation_count,
}


def add_features(df: DataFrame, text: str = "review", language: str | None = None, home: str = "it") -> DataFrame:
    """All row-local features in one projection."""
    c = F.col(text)
    columns = {
        "review_length": review_length(c),
        "review_word_count": word_count(c),
        **{name: make(c) for name, make in NOISE_FEATURES.items()},
        "special_char_count": special_char_count(c),
        "digit_ratio": digit_ratio(c),
        "token_entropy": token_entropy(c),
    }
    if language:
        columns["is_foreign"] = is_foreign(F.col(language), home)
    return df.withColumns(columns)
