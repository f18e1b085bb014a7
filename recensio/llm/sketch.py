"""Document fingerprints: every shingle hash below a fixed fraction of the hash space.

With column functions only. A sketch's size follows its document, so the share
of a short text's hashes that a long one holds too is an estimate without bias,
and the union of two sketches is the sketch of both texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recensio.llm.names import on_numbers

WORDS = 5
#: One hash of so many is kept.
SCALE = 8


def sketch(text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Sorted hashes of the ``words``-word shingles that lie in the lowest 1/``scale``.

    A shorter text is one shingle; null and texts without words give an empty
    sketch. Where no hash lies that low, the lowest one stands in, so that only
    texts without words have empty sketches; ``merged`` keeps that rule.
    """
    # the list is bound once by a lambda, else each use of it would split the text again
    tokens = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != F.lit(""))
    hashes = F.transform(
        F.array(tokens),
        lambda w: F.when(
            F.size(w) >= words,
            F.transform(F.sequence(F.lit(1), F.size(w) - (words - 1)), lambda i: F.xxhash64(F.slice(w, i, words))),
        ).otherwise(F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))),
    )
    return F.element_at(F.transform(hashes, lambda h: _lowest(h, scale)), 1)


def _lowest(hashes: Column, scale: int) -> Column:
    limit = F.lit(-(2**63) + 2**64 // scale)
    low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < limit)))
    return F.when((F.size(low) > 0) | (F.size(hashes) == 0), low).otherwise(F.array(F.array_min(hashes)))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two texts' shingles together, from their sketches."""
    return _lowest(F.array_union(a, b), scale)


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other holds too; 1 if both are empty, 0 if one is."""
    least = F.least(F.size(a), F.size(b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def resemblance(a: Column, b: Column) -> Column:
    """Share of all hashes that both sketches hold; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, 1.0).otherwise(both / every)


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(rows: DataFrame, order: str, tie: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``next_<c>``: the value in the row after, by descending ``order``; the last is followed by the first.

    The order is cut into ranges of ids (rows without id come last, cut by
    ``tie``); the first row of each range visits the range before it as a
    guest, so that each range can be sorted alone.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx(order, points, 10 * parts)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)  # at most one for each partition
    high = F.shiftright(F.col(tie), 32) + F.lit(2**31)
    unnamed = F.lit(len(cuts) + 1) + F.floor((F.lit(2**32 - 1) - high) * F.lit(parts) / F.lit(2.0**32))
    below = F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<long>"), lambda c: c > F.col(order)))
    ranged = rows.withColumn("_range", F.when(F.col(order).isNull(), unnamed).otherwise(below).cast("int"))
    firsts = (
        ranged.groupBy("_range").agg(F.max(F.struct(order, tie)).alias("f")).select("_range", "f.*").orderBy("_range").collect()
    )  # one id and number for each range
    guests = [(f["_range"], firsts[i - 1]["_range"], f[order], f[tie]) for i, f in enumerate(firsts)]
    guests = rows.sparkSession.createDataFrame(guests, f"_range int, _to int, _first {dict(rows.dtypes)[order]}, _first_tie long")
    first = (
        ranged.join(F.broadcast(guests), "_range")
        .filter(F.col(order).eqNullSafe(F.col("_first")) & (F.col(tie) == F.col("_first_tie")))
        .dropDuplicates(["_range"])
        .withColumn("_range", F.col("_to"))
        .select(*ranged.columns)
    )
    both = ranged.withColumn("_guest", F.lit(0)).unionByName(first.withColumn("_guest", F.lit(1)))
    inside = Window.partitionBy("_range").orderBy("_guest", F.col(order).desc_nulls_last(), F.col(tie).desc())
    return (
        both.withColumns({f"next_{c}": F.lead(c).over(inside) for c in columns}).filter(F.col("_guest") == 0).drop("_range", "_guest")
    )


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """``(doc_id, text, edited, sketch, edited_sketch, next_sketch)``, one row per row of ``docs``.

    Ids may be of any type that sorts. The edited text's last floor(n/2) code points are replaced by the first as
    many, or all, of the next text by descending id. Null text is empty.
    Rows of one id follow each other by a hash of their text, rows without id
    come last; of equal rows each has a like row next to it. A single row is
    its own next. An empty table gives no rows; other columns are ignored.
    """
    return on_numbers(docs, doc_id, text, lambda rows: _edited(rows, words, scale))


def _edited(rows: DataFrame, words: int, scale: int) -> DataFrame:
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("_tie", F.xxhash64("text"))
    paired = with_next(rows, "doc_id", "_tie", ["text"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return paired.select(
        "doc_id",
        "text",
        edited.alias("edited"),
        sketch(F.col("text"), words, scale).alias("sketch"),
        sketch(edited, words, scale).alias("edited_sketch"),
        sketch(F.col("next_text"), words, scale).alias("next_sketch"),
    )
