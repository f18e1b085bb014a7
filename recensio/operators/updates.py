"""Conditional update of one column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_back(df: DataFrame, changed: DataFrame, key: str, column: str) -> DataFrame:
    """Values of ``changed(key, column)`` replace those of the same key.

    For updates computed from the row itself a ``when`` is cheaper; this join is
    for values that come from another table.
    """
    new = changed.select(key, F.col(column).alias("_new"))
    return df.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")
