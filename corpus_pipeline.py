"""Raw documents to balanced training shards, as stages that are written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recensio.llm import leaks, mixing, quality, shards, similar_sets
from recensio.llm.names import on_apart
from recensio.llm.ship import ship
from recensio.session import materialize


#: The columns of documents that operators read or may add to; all others are set apart.
USED = ["doc_id", "text", "lang", "source"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject.

    Documents whose id's crc32 leaves remainder 2 after division by 4 are held out
    of the fit. Without labels all documents are scored alike, by a chance of one half,
    so none stays. A null text is scored as an empty one; repeated rows and equal texts get one
    score, so they stay or go together. An empty table gives no rows; all columns keep their values.
    """
    ship(spark)
    seen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(seen))
    return on_apart(docs, USED, lambda d: quality.score(d, forest, name="score").filter(F.col("score") >= quality.KEEP))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id from each group that similar shingle sets connect.

    Texts without words (null, empty) are similar to none and all stay; rows without id come after
    those that have one, ties are settled by a hash of the text, and repeated rows stay
    once. An empty table gives no rows; all columns keep their values.
    """
    ship(spark)
    return similar_sets.one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item.

    Null and empty texts have no window and stay; repeated rows stay or go together. Without items all
    stay; an empty table gives no rows; all columns keep their values.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return on_apart(docs, USED, lambda d: leaks.find_leaks(d, items).filter(F.size("hit_words") == 0))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens meet the target shares of sources, languages and topics.

    Null sources and languages are a value of their own; texts without tokens (null, empty) are never
    drawn; rows that share an id share the draw. An empty table gives no rows; all columns keep their values.
    """
    return on_apart(docs, USED, lambda d: mixing.mix(d).filter("sampled"))


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document; documents with a line or a longer passage in common are linked.

    Each row is placed once, repeated ones and those without id or text too (a null text has size 1);
    ties are settled by hashes. An empty table gives no rows; columns but ``doc_id`` and ``text`` are ignored.
    """
    ship(spark)
    return shards.shard_documents(shards.shared_keys(docs.select("doc_id", "text")), links=F.col("links"))


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", different_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing sources", mixed_documents),
    ("sharding", sharded_documents),
]

#: The classifier and the label propagation have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
