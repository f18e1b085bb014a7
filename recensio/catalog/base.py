"""Registry and the views that queries and SQL share word for word."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recensio.sources.readers import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

REVIEWS_SQL = """
select doc_id as review_id, text as review, lang as review_lang,
 cast(1 + (doc_id*7) % 5 as double) as rating,
 case when doc_id % 11 = 0 then null
      when (doc_id*7) % 5 <= 1 then case when doc_id % 2 = 0 then 'Negative' else ' negative' end
      when (doc_id*7) % 5 = 2 then 'Neutral' else 'positive' end as sentiment,
 case when doc_id % 13 = 0 then null
      when doc_id % 17 = 0 then concat('[', source)
      else concat('[', chr(39), source, chr(39), ', ', chr(39), 'src',
                  cast(doc_id % 7 as varchar(10)), chr(39), ']') end as labels,
 case when doc_id % 19 = 0 then null
      else date '2024-01-01' + cast(doc_id % 540 as int) end as review_date
from documents
"""

# The same rows with what app reviews also hold and the documents lack: missing
# and empty text, one-word and shouted reviews, emoji, links, mentions, hashtags.
NOISY_SQL = """
select review_id, review_lang, rating, sentiment, labels, review_date,
 case when review_id % 23 = 0 then null
      when review_id % 29 = 0 then ''
      when review_id % 31 = 0 then 'ok'
      when review_id % 37 = 0 then ' !!! '
      when review_id % 41 = 0 then 'PESSIMA APP'
      when review_id % 43 = 0 then ' Top '
      when review_id % 47 = 0 then '<URL>'
      when review_id % 7 = 0 then
        concat(review, ' 👍👍🏽  vedi http://a.example/x?y=1 @Perché noooooo #tag ❤️')
      when review_id % 5 = 0 then concat('😡', review, ' www.example.it 🇮🇹 ok 12345')
      else review end as review
from reviews
"""

TAXONOMY_SQL = """
select concat('src', cast(k as varchar(10))) as old_label_name,
       concat('topic_', cast(k % 8 as varchar(10))) as label,
       case when k % 4 = 3 then null
            else concat('area_', cast(k % 3 as varchar(10))) end as parent_label,
       k as pos
from (select distinct cast(doc_id % 20 as int) as k from documents) s
"""

WITH_REVIEWS = f"with reviews as ({REVIEWS_SQL})"
WITH_NOISY = f"{WITH_REVIEWS}, noisy as ({NOISY_SQL})"
WITH_TAXONOMY = f"{WITH_REVIEWS}, taxonomy as ({TAXONOMY_SQL})"

#: The home language of the test tables, which hold no Italian.
HOME = "en"


def query(name: str, oracle: str | None = None):
    """Register a query and, if given, its SQL counterpart."""

    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    if spread_out:
        documents = spread(documents, "doc_id")
    return spark.sql(REVIEWS_SQL.replace("from documents", "from {documents}"), documents=documents)


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread over the cores, since the text functions are CPU bound."""
    return spark.sql(NOISY_SQL.replace("from reviews", "from {reviews}"), reviews=reviews(spark, sf_dir, True))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = TAXONOMY_SQL.replace("from documents", "from {documents}")
    return spark.sql(sql, documents=table(spark, sf_dir, "documents"))
