"""Printed label lists and the label taxonomy."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.operators.scale import lookup_join

#: Up to this many pairs, a mapping travels as one map value inside the plan.
MAP_ROWS = 1_000


_QUOTED = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\""""
_ITEM = rf"(?:{_QUOTED}|None|True|False|-?\d+(?:\.\d+)?)"
_LIST = rf"^\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*+,?)?\s*\]\s*$"
#: Stands for an escaped backslash while other escapes are read.
_BACKSLASH = "\ue000"


def _unescaped(inner: Column) -> Column:
    """A quoted item without its quotes: its escapes are written as JSON ones and read as such."""
    c = F.replace(inner, F.lit("\\\\"), F.lit(_BACKSLASH))
    for quote in ("'", '"'):
        c = F.replace(c, F.lit("\\" + quote), F.lit(quote))
    c = F.regexp_replace(c, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    c = F.replace(F.replace(c, F.lit('"'), F.lit('\\"')), F.lit("\t"), F.lit("\\t"))
    c = F.replace(c, F.lit(_BACKSLASH), F.lit("\\\\"))
    read = F.from_json(F.concat(F.lit('["'), c, F.lit('"]')), "array<string>")
    return F.when(inner.contains("\\"), F.coalesce(F.get(read, F.lit(0)), inner)).otherwise(inner)


def parse_labels(printed: Column) -> Column:
    """A printed list, ``"['a', None]"``, to an array; anything that is not one gives ``[]``.

    Items are quoted texts, numbers, True, False and None, which becomes null; a
    comma may follow the last. Lists in lists are not labels and give ``[]``.
    """
    items = F.transform(
        F.regexp_extract_all(printed, F.lit(f"({_ITEM})"), F.lit(1)),
        lambda x: F.when(x == "None", F.lit(None).cast("string"))
        .when(x.startswith("'") | x.startswith('"'), _unescaped(F.substring(x, F.lit(2), F.length(x) - 2)))
        .otherwise(x),
    )
    return F.coalesce(F.when(printed.rlike(_LIST), items), F.array().cast("array<string>"))


def mapping(taxonomy: DataFrame, source: str, target: str, order: str = "pos") -> DataFrame:
    """One ``target`` per ``source``; the last row wins, as in a dict."""
    return (
        taxonomy.filter(F.col(source).isNotNull())
        .groupBy(F.col(source).alias("_from"))
        .agg(F.max_by(target, order).alias("_to"))
    )


def map_labels(
    df: DataFrame, key: str, column: str, pairs: DataFrame, target: str
) -> DataFrame:
    """Replace each label by its partner, keeping unmapped ones, order and repeats.

    A mapping of checked size becomes one map and needs no shuffle. A larger one
    is joined label by label, and the labels are put back in place by position.
    """
    empty = F.array().cast("array<string>")
    few = pairs.limit(MAP_ROWS + 1).collect()
    if len(few) <= MAP_ROWS:
        text = json.dumps({row["_from"]: row["_to"] for row in few})
        whole = F.from_json(F.lit(text), "map<string,string>")
        mapped = F.transform(column, lambda label: F.coalesce(whole[label], label))
        return df.withColumn(target, F.coalesce(mapped, empty))
    exploded = df.select(key, F.posexplode(column).alias("_pos", "_from"))
    mapped = lookup_join(exploded, pairs, ["_from"]).select(
        key, F.struct("_pos", F.coalesce("_to", "_from").alias("label")).alias("_item")
    )
    collected = mapped.groupBy(key).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    return (
        df.join(collected, key, "left")
        .withColumn(target, F.coalesce(F.col("_items.label"), empty))
        .drop("_items")
    )


def frequent_labels(df: DataFrame, column: str, n: int = 20, date: str = "review_date") -> DataFrame:
    """``(label)``: the ``n`` most frequent labels of dated rows, for trends; ties by name."""
    dated = df.filter(F.col(date).isNotNull())
    counts = dated.select(F.explode(column).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("label").isNotNull()).orderBy(F.desc("n"), "label").limit(n).select("label")


def update_labels(df: DataFrame, key: str, taxonomy: DataFrame) -> DataFrame:
    """Old label names to the current ones (``parsed_labels`` to ``new_labels``)."""
    pairs = mapping(taxonomy, "old_label_name", "label")
    return map_labels(df, key, "parsed_labels", pairs, "new_labels")


def parent_labels(df: DataFrame, key: str, taxonomy: DataFrame) -> DataFrame:
    """Labels to their parents; a label without parent stays."""
    pairs = mapping(taxonomy, "label", "parent_label")
    return map_labels(df, key, "new_labels", pairs, "parent_labels")


def label_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of every label over all rows, repeats included."""
    return (
        df.select(F.explode(column).alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_labels(counts: DataFrame, n: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("n"), "label").limit(n)


def rare_labels(counts: DataFrame, n: int = 20) -> DataFrame:
    return counts.orderBy("n", F.desc("label")).limit(n)


def distinct_label_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Number of different labels per array column, one row ``(level, n_labels)``."""
    parts = F.array(
        *[F.struct(F.lit(level).alias("level"), F.col(c).alias("labels")) for level, c in columns.items()]
    )
    return (
        df.select(F.inline(parts))
        .select("level", F.explode("labels").alias("label"))
        .distinct()
        .groupBy("level")
        .agg(F.count(F.lit(1)).alias("n_labels"))
    )


def monthly_label_counts(
    df: DataFrame, labels: DataFrame, column: str = "new_labels", date: str = "review_date"
) -> DataFrame:
    """Rows per month and label: every month of the range for every label.

    ``labels`` has one column ``label``; a row counts once per label.
    """
    dated = df.filter(F.col(date).isNotNull()).select(F.trunc(date, "month").alias("month"), column)
    counts = (
        dated.select("month", F.explode(F.array_distinct(column)).alias("label"))
        .groupBy("month", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    span = dated.agg(
        F.expr("sequence(min(month), max(month), interval 1 month)").alias("months")
    )
    wanted = labels.select("label").distinct()
    spine = wanted.select("label", F.explode(span.scalar()).alias("month"))
    return spine.join(counts, ["label", "month"], "left").select(
        F.last_day("month").alias("month_end"), "label", F.coalesce("n", F.lit(0)).alias("n")
    )
