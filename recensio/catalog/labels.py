"""Label lists, taxonomy lookups, subset updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from recensio.catalog.base import WITH_TAXONOMY, query, reviews, taxonomy
from recensio.operators import labels as lb
from recensio.operators.updates import write_back
from recensio.sources import readers

LABELS_CTE = f"""{WITH_TAXONOMY}, p as (select review_id, review_date, case when labels like '[%' and labels like '%]'
  then regexp_extract_all(labels, chr(39) || '([^' || chr(39) || ']*)' || chr(39), 1) else [] end as ls from reviews),
e as (select review_id, review_date, unnest(ls) as old, unnest(range(len(ls))) as pos from p),
t1 as (select e.*, coalesce(t.label, old) as cur from e left join taxonomy t on old_label_name = old),
parents as (select label, arg_max_null(parent_label, pos) as parent_label from taxonomy group by label),
t2 as (select t1.*, coalesce(parent_label, cur) as par from t1 left join parents on label = cur)"""


def parsed(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "review_id", "review_date", lb.parse_labels(F.col("labels")).alias("parsed_labels")
    )


def updated(spark, sf_dir):
    return lb.update_labels(parsed(spark, sf_dir), "review_id", taxonomy(spark, sf_dir))


def with_parents(spark, sf_dir):
    return lb.parent_labels(updated(spark, sf_dir), "review_id", taxonomy(spark, sf_dir))


def joined_labels(column: str) -> str:
    return f"""{LABELS_CTE}, g as (select review_id, string_agg({column}, '|' order by pos) as labels
    from t2 group by review_id) select reviews.review_id, coalesce(g.labels, '') as labels
    from reviews left join g on reviews.review_id = g.review_id"""


@query(
    "j01_write_back_subset",
    f"""{WITH_TAXONOMY} select review_id, case when rating <= 2 and sentiment is not null
    then concat('low ', sentiment) else sentiment end as sentiment from reviews""",
)
def j01(spark, sf_dir):
    df = reviews(spark, sf_dir).select("review_id", "sentiment", "rating")
    changed = df.filter(F.col("rating") <= 2).select(
        "review_id", F.concat(F.lit("low "), "sentiment").alias("sentiment")
    )
    return write_back(df, changed, "review_id", "sentiment").select("review_id", "sentiment")


@query("j02_current_labels", joined_labels("cur"))
def j02(spark, sf_dir):
    return updated(spark, sf_dir).select("review_id", F.array_join("new_labels", "|").alias("labels"))


@query("j03_parent_labels", joined_labels("par"))
def j03(spark, sf_dir):
    return with_parents(spark, sf_dir).select("review_id", F.array_join("parent_labels", "|").alias("labels"))


@query("a10_label_counts", f"{LABELS_CTE} select cur as label, count(*) as n from t2 group by cur")
def a10(spark, sf_dir):
    return lb.label_counts(updated(spark, sf_dir), "new_labels")


@query("a10b_parent_label_counts", f"{LABELS_CTE} select par as label, count(*) as n from t2 group by par")
def a10b(spark, sf_dir):
    return lb.label_counts(with_parents(spark, sf_dir), "parent_labels")


@query(
    "a11_distinct_labels",
    f"""{LABELS_CTE} select 'original' as level, count(distinct old) as n_labels from t2 union all
    select 'current', count(distinct cur) from t2 union all select 'parent', count(distinct par) from t2""",
)
def a11(spark, sf_dir):
    levels = {"original": "parsed_labels", "current": "new_labels", "parent": "parent_labels"}
    return lb.distinct_label_counts(with_parents(spark, sf_dir), levels)


@query(
    "a14_monthly_label_counts",
    f"""{LABELS_CTE}, d as (select * from p where review_date is not null),
    months as (select unnest(generate_series(date_trunc('month', (select min(review_date) from d))::timestamp,
      date_trunc('month', (select max(review_date) from d))::timestamp, interval 1 month)) as m),
    wanted as (select distinct label from taxonomy where pos > 0),
    c as (select date_trunc('month', review_date) as m, cur as label, count(distinct review_id) as n from t2
      where review_date is not null group by 1, 2)
    select cast(last_day(x.m) as varchar) as month_end, x.label, coalesce(n, 0) as n
    from (select * from months, wanted) x left join c on c.label = x.label and c.m = x.m""",
)
def a14(spark, sf_dir):
    # the trend leaves out the first taxonomy row
    wanted = taxonomy(spark, sf_dir).filter(F.col("pos") > 0)
    out = lb.monthly_label_counts(updated(spark, sf_dir), wanted)
    return out.withColumn("month_end", F.col("month_end").cast("string"))


@query(
    "a14b_trend_of_frequent_labels",
    f"""{LABELS_CTE}, d as (select * from p where review_date is not null),
    months as (select unnest(generate_series(date_trunc('month', (select min(review_date) from d))::timestamp,
      date_trunc('month', (select max(review_date) from d))::timestamp, interval 1 month)) as m),
    wanted as (select cur as label from t2 where review_date is not null group by cur order by count(*) desc, cur limit 20),
    c as (select date_trunc('month', review_date) as m, cur as label, count(distinct review_id) as n from t2
      where review_date is not null group by 1, 2)
    select cast(last_day(x.m) as varchar) as month_end, x.label, coalesce(n, 0) as n
    from (select * from months, wanted) x left join c on c.label = x.label and c.m = x.m""",
)
def a14b(spark, sf_dir):
    df = updated(spark, sf_dir)
    out = lb.monthly_label_counts(df, lb.frequent_labels(df, "new_labels"))
    return out.withColumn("month_end", F.col("month_end").cast("string"))


@query(
    "l01_sorted_label_counts",
    f"""{LABELS_CTE}, c as (select cur as label, count(*) as n from t2 group by cur)
    select label, n from c order by n desc, label""",
)
def l01(spark, sf_dir):
    return lb.label_counts(updated(spark, sf_dir), "new_labels").orderBy(F.desc("n"), "label")


@query(
    "l02_top_labels",
    f"""{LABELS_CTE}, c as (select par as label, count(*) as n from t2 group by par)
    select label, n from c order by n desc, label limit 5""",
)
def l02(spark, sf_dir):
    return lb.top_labels(lb.label_counts(with_parents(spark, sf_dir), "parent_labels"), 5)


@query(
    "l03_rare_labels",
    f"""{LABELS_CTE}, c as (select cur as label, count(*) as n from t2 group by cur)
    select label, n from c order by n, label desc limit 5""",
)
def l03(spark, sf_dir):
    return lb.rare_labels(lb.label_counts(updated(spark, sf_dir), "new_labels"), 5)


@query(
    "s02_taxonomy_labels",
    f"{WITH_TAXONOMY} select old_label_name as label, min(pos) as pos from taxonomy group by old_label_name",
)
def s02(spark, sf_dir):
    return readers.taxonomy_labels(taxonomy(spark, sf_dir), order="pos")


@query("s03_taxonomy", f"{WITH_TAXONOMY} select old_label_name, label, parent_label from taxonomy")
def s03(spark, sf_dir):
    return taxonomy(spark, sf_dir).drop("pos")
