"""Find and remove benchmark passages in training texts, with column functions only.

Windows of the benchmark items become hashes; with their number checked they are
broadcast, otherwise joined by key. Documents are scanned once for windows with
such a hash (only an id and a position leave a text); the few hits are verified
word by word against the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.llm.names import free_names
from recensio.operators.scale import hinted
from recensio.session import materialize

LENGTH = 10
#: Windows of the benchmark up to this number are broadcast (12 bytes each).
BROADCAST_WINDOWS = 1_000_000
#: Suspect texts up to this number are looked up by broadcast (16 bytes each), and what
#: was found in them up to so many numbers; beyond, both are joined by key.
BROADCAST_TEXTS = 2_000_000
BROADCAST_FOUND = 8_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = "".join(map(chr, [*range(0x01, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def plain_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all other non-ASCII characters."""
    clean = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER + _MARKS, _UPPER.lower() + " " * len(_MARKS))
    clean = F.replace(clean, F.lit("\x00"), F.lit(" "))
    return F.filter(F.split(clean, " "), lambda w: w != F.lit(""))


def _windows(words: Column, length: int) -> Column:
    """Hash of the ``length`` words from each word on; fewer words give none."""
    return F.when(
        F.size(words) >= length,
        F.transform(F.sequence(F.lit(1), F.size(words) - (length - 1)), lambda i: F.xxhash64(F.slice(words, i, length))),
    )


def item_windows(items: DataFrame, item_id: str, text: str, length: int) -> DataFrame:
    """``(item_id, n, words, hash)``: each window of each item once; n is its number of words."""
    words = items.select(F.col(item_id).alias("item_id"), plain_words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(length))
    return (
        words.withColumn("n", n)
        .select("item_id", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, F.col("n")))).alias("words"))
        .withColumn("hash", F.xxhash64("words"))
        .distinct()
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (positions of hit words) and ``hit_items`` (sorted strings).

    Words are those of ``plain_words``; null has none. A window is ``length``
    consecutive words of an item, or the whole of a shorter item; a document
    word inside any occurrence of a window is hit. Rows that share an id and
    text are judged alike; rows without id too. Items without id contaminate
    but are not listed. Empty tables give no hits, or no rows. All columns of
    ``docs`` stay, but for ones with the names that are added, which are replaced. Texts
    are told apart by two hashes, 128 bits together.
    """
    docs = docs.drop(*[c for c in ("n_words", "hit_words", "hit_items") if c not in (doc_id, text)])
    (key,) = free_names(docs.columns, "_leak_key")
    windows = materialize(item_windows(items, item_id, item_text, length))
    lengths = [r["n"] for r in windows.select("n").distinct().collect()]  # at most `length` numbers
    parts = [F.col(doc_id).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit(""))]
    keyed = docs.withColumn(key, F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")))
    own = F.col(key).alias("_leak_key")
    words = keyed.select(own, plain_words(F.col(text)).alias("w"))
    hashes = windows.select("n", "hash").distinct()
    small = hashes.count() <= BROADCAST_WINDOWS
    found = None
    for n in sorted(lengths):
        known = hashes.filter(F.col("n") == n).select("hash")
        scanned = words.select("_leak_key", F.posexplode(_windows(F.col("w"), n)).alias("pos", "hash"))
        hits = scanned.join(F.broadcast(known) if small else known, "hash").withColumn("n", F.lit(n))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.withColumns(
            {"n_words": F.size(plain_words(F.col(text))).cast("long"), "hit_words": F.array().cast("array<int>"), "hit_items": F.array().cast("array<string>")}
        )
    places = found.groupBy("_leak_key").agg(F.collect_set(F.struct("pos", "n", "hash")).alias("_leak_at"))
    places = materialize(places)
    keys = places.select("_leak_key")
    suspects = (
        keyed.select(own, F.col(text).alias("t"))
        .join(F.broadcast(keys) if keys.count() <= BROADCAST_TEXTS else keys, "_leak_key", "left_semi")
        .dropDuplicates(["_leak_key"])
        .select("_leak_key", plain_words(F.col("t")).alias("w"))
        .join(places, "_leak_key")
        .select("_leak_key", F.explode(F.transform("_leak_at", lambda a: F.struct(a["pos"].alias("pos"), a["n"].alias("n"), a["hash"].alias("hash"), F.slice("w", a["pos"] + 1, a["n"]).alias("words")))).alias("a"))
        .select("_leak_key", "a.*")
    )
    known = windows.select("hash", "n", "words", F.col("item_id").cast("string").alias("item"))
    known = known.groupBy("hash", "n", "words").agg(F.collect_set("item").alias("items"))
    # items of one window may be many, so their bytes are measured
    true = suspects.join(hinted(known, BROADCAST_WINDOWS), ["hash", "n", "words"])
    verified = materialize(true.groupBy("_leak_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1))))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("hit_items"),
    ))
    load = verified.agg(F.sum(F.size("hit_words") + F.size("hit_items") * 4 + 4)).first()[0] or 0
    verified = verified.withColumnRenamed("_leak_key", key)
    if load <= BROADCAST_FOUND:
        verified = F.broadcast(verified)
    return (
        keyed.withColumn("n_words", F.size(plain_words(F.col(text))).cast("long"))
        .join(verified, key, "left")
        .drop(key)
        .withColumn("hit_words", F.coalesce("hit_words", F.array().cast("array<int>")))
        .withColumn("hit_items", F.coalesce("hit_items", F.array().cast("array<string>")))
    )


def without_hits(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with ``clean_text``: the words that are not hit, joined by one space."""
    words = F.filter(plain_words(F.col(text)), lambda w, i: ~F.array_contains("hit_words", i))
    return found.withColumn("clean_text", F.array_join(words, " "))
