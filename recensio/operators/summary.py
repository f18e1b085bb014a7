"""Distributions, histograms, box statistics, crosstabs, trends, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.operators.scale import exact_quantiles, hinted
from recensio.session import materialize


def count_rows() -> Column:
    return F.count(F.lit(1))


def value_counts(df: DataFrame, column: str, categories: Sequence[str] | None = None) -> DataFrame:
    """Rows per value, missing values left out; ``categories`` fixes the list."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(count_rows().alias("n"))
    )
    if categories is None:
        return counts
    listed = F.explode(F.array(*[F.lit(c) for c in categories])).alias("value")
    wanted = df.sparkSession.range(1).select(listed)
    return wanted.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def shares(df: DataFrame, column: str, fold_below: float = 0.008, other: str = "Other") -> DataFrame:
    """Percentage per value to one decimal; values under ``fold_below`` in one row.

    The total is a scalar subquery, so the groups are never moved to one task.
    """
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    name = F.when(F.col("n") / total < fold_below, F.lit(other)).otherwise(F.col("value"))
    return (
        counts.select(name.alias("value"), "n", total.alias("total"))
        .groupBy("value", "total")
        .agg(F.sum("n").alias("n"))
        .select("value", "n", F.round(F.col("n") / F.col("total") * 100, 1).alias("percentage"))
    )


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value)`` rows of several numeric columns, in one pass."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)``: counting first keeps the rows small and the skew out."""
    return long_form(df, columns).groupBy("feature", "value").agg(count_rows().alias("n"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum.

    Values are counted in the one pass over the input; the rest works on counts.
    """
    counts = materialize(counted(df, columns).filter(F.col("value").isNotNull()))
    n, v = F.col("n"), F.col("value")
    basic = counts.groupBy("feature").agg(
        F.sum(n).alias("count"),
        (F.sum(n * v) / F.sum(n)).alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    spread = (
        counts.join(hinted(basic.select("feature", "count", "mean")), "feature")
        .groupBy("feature", "count")
        .agg(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("squares"))
        .select("feature", F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"))
    )
    quartiles = exact_quantiles(counts, "feature", "value", QUARTILES, "n")
    return basic.join(spread, "feature").join(quartiles, "feature")


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return exact_quantiles(counted(df, columns), "feature", "value", {"median": 0.5}, "n")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    span = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if span["low"] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, n long")
    low, high = span["low"], span["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col("v") - low) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(place.alias("bin")).agg(count_rows().alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_statistics(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value within ``reach`` x IQR, outlier count."""
    counts = materialize(counted(df, columns).filter(F.col("value").isNotNull()))
    quartiles = exact_quantiles(counts, "feature", "value", QUARTILES, "n")
    iqr = F.col("q75") - F.col("q25")
    inside = F.col("value").between(F.col("q25") - reach * iqr, F.col("q75") + reach * iqr)
    return (
        counts.join(hinted(quartiles), "feature")
        .groupBy("feature", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("n_outside"),
        )
    )


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return counted(df, columns).filter(F.col("value").isNotNull())


def crosstab_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """``(row, column, n, share)`` for all values that occur together; the share is that of the row's total."""
    counts = materialize(
        df.filter(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row, column).agg(count_rows().alias("n"))
    )
    totals = counts.groupBy(row).agg(F.sum("n").alias("_total"))
    return counts.join(hinted(totals), row).select(row, column, "n", (F.col("n") / F.col("_total")).alias("share"))


def _wide(df: DataFrame, row: str, column: str, values: Sequence | None, cell: str) -> DataFrame:
    counts = crosstab_counts(df, row, column)
    return counts.groupBy(row).pivot(column, None if values is None else list(values)).agg(F.first(cell)).na.fill(0)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Counts of ``row`` x ``column``, one column for each of ``values`` or of all values that occur.

    For columns of very many values use the long form, ``crosstab_counts``.
    """
    return _wide(df, row, column, values, "n")


def crosstab_shares(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Crosstab with each row divided by its total over all values, listed or not."""
    return _wide(df, row, column, values, "share")


def share_of_total(counts: DataFrame, n: str = "n", share: str = "share") -> DataFrame:
    """``counts`` with each count over the sum of all."""
    return counts.withColumn(share, F.col(n) / counts.agg(F.sum(n).alias("total")).scalar())


def monthly_volume(df: DataFrame, date: str = "review_date", counted_column: str = "review") -> DataFrame:
    """Texts per month from the first to the last month; empty months give 0."""
    counts = (
        df.filter(F.col(date).isNotNull())
        .groupBy(F.trunc(date, "month").alias("month"))
        .agg(F.count(counted_column).alias("n"))
    )
    spine = counts.agg(
        F.expr("sequence(min(month), max(month), interval 1 month)").alias("months")
    ).select(F.explode("months").alias("month"))
    return spine.join(counts, "month", "left").select(
        F.last_day("month").alias("month_end"), F.coalesce("n", F.lit(0)).alias("n")
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form, one pass, pairwise-complete rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows dropped by each step when applied in order, in a single pass.

    ``steps`` maps a name to the condition a row must meet to stay.
    """
    alive, sums = F.lit(True), []
    for keep in steps.values():
        stays = F.coalesce(keep, F.lit(False))
        sums.append(F.coalesce(F.sum(F.when(alive & ~stays, 1).otherwise(0)), F.lit(0)))
        alive = alive & stays
    cells = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"_{i}").alias("dropped"))
        for i, name in enumerate(steps)
    ]
    wide = df.agg(*[s.alias(f"_{i}") for i, s in enumerate(sums)])
    return wide.select(F.inline(F.array(*cells)))


def foreign_counts(df: DataFrame, language: str, home: str = "it") -> DataFrame:
    """Rows not in the home language (missing included) and their languages."""
    foreign = ~F.col(language).eqNullSafe(F.lit(home))
    per_language = df.filter(foreign).groupBy(language).agg(count_rows().alias("n"))
    return per_language.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("foreign_rows"),
        F.count(language).alias("foreign_languages"),
    )
