"""Names and ids of the caller's tables: columns under other names, ids of any type as numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recensio.operators.scale import lookup_join, number_in_order
from recensio.session import materialize

_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The names wanted, lengthened until the table has none of them."""
    held, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def on_apart(docs: DataFrame, used: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` on ``docs`` whose columns but ``used`` bear numbers as names, and then their own again.

    The operator may add or replace any column; the caller's come back with their values.
    """
    others = [c for c in docs.columns if c not in used]
    own = lambda c: F.col(f"`{c}`")
    plain = docs.select(*[own(c) for c in docs.columns if c in used], *[own(c).alias(f"_other_{i}") for i, c in enumerate(others)])
    found = operator(plain)
    back = {c: F.col(f"_other_{i}").alias(c) for i, c in enumerate(others)}
    return found.select(*[back.get(c, own(c)) for c in docs.columns])


def on_numbers(docs: DataFrame, doc_id: str, text: str, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` on ``(doc_id, text)`` with integer ids; ids of another type are numbered in their order first.

    Equal ids get one number and null none; the operator's ``doc_id`` is turned back.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if dict(rows.dtypes)["doc_id"] in _INTEGERS:
        return operator(rows.withColumn("doc_id", F.col("doc_id").cast("long")))
    ids = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    ids = materialize(number_in_order(ids, [F.col("doc_id")], "_number").withColumn("_number", F.col("_number").cast("long")))
    found = operator(lookup_join(rows, ids, ["doc_id"], "left", seen="_rows").select(F.col("_number").alias("doc_id"), "text"))
    columns = found.columns
    named = ids.select(F.col("doc_id").alias("_named"), F.col("_number").alias("doc_id"), "_rows")
    back = lookup_join(materialize(found), named, ["doc_id"], "left", seen="_rows")
    return back.select(*[F.col("_named").alias("doc_id") if c == "doc_id" else F.col(c) for c in columns])
