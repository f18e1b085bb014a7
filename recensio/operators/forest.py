"""Which features tell the sentiment: one-hot matrix, stratified split, forest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recensio.operators.scale import lookup_join, number_in_order, rank_in_group
from recensio.session import materialize

CATEGORICAL = ["labels", "language"]
NUMERIC = ["review_length", "punctuation_count", "emoji_count", "rating"]
DATE = "review_date"


class FeatureNames:
    """Names of the columns of a matrix, as the table ``(place, feature)``; the driver holds their number."""

    def __init__(self, table: DataFrame, size: int):
        self.table, self.size = table, size

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[str]:
        """Names in the order of the columns, fetched part by part."""
        return (row["feature"] for row in self.table.orderBy("place").toLocalIterator())


def _categories(df: DataFrame, columns: Sequence[str]) -> Column:
    """Column and value of every category of a row; a list counts each of its labels."""
    kinds = dict(df.dtypes)

    def of(c: str) -> Column:
        values = F.array_distinct(F.col(c).cast("array<string>")) if kinds[c].startswith("array") else F.array(F.col(c).cast("string"))
        return F.transform(values, lambda v: F.struct(F.lit(c).alias("_column"), v.alias("_value")))

    return F.filter(F.concat(*[of(c) for c in columns]), lambda e: e["_value"].isNotNull())


def feature_matrix(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    date: str = DATE,
    target: str = "sentiment",
    learn_from: Column | None = None,
) -> tuple[DataFrame, FeatureNames]:
    """Rows without gaps plus ``features``; also the name of every feature.

    Categories become one-hot columns, each label of a list one of its own, the date its
    seconds since 1970. Only the rows of ``learn_from`` (default: all) say which categories
    there are; another value has no column and gives zeros. Categories are numbered
    by falling frequency and looked up by a join, so their names never reach the driver.
    """
    used = [*categorical, *numeric, date]
    full = df.na.drop(subset=[*used, target]).withColumn("_date", F.unix_date(F.col(date)).cast("double") * 86400)
    full = materialize(full.withColumn("_row", F.monotonically_increasing_id()))
    learned = full if learn_from is None else full.filter(learn_from)
    order = F.array_position(F.array(*[F.lit(c) for c in categorical]), F.col("_column"))
    counted = learned.select(F.inline(_categories(full, categorical))).groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    numbered = materialize(number_in_order(counted, [order, F.desc("_n"), F.col("_value")], "place"))
    size = numbered.count()
    rows = full.select("_row", F.inline(_categories(full, categorical)))
    places = lookup_join(rows, numbered.select("_column", "_value", "place"), ["_column", "_value"], "inner")
    held = places.groupBy("_row").agg(F.collect_list(F.col("place").cast("string")).alias("_places"))
    placed = full.join(held, "_row", "left").withColumn("_places", F.coalesce("_places", F.array().cast("array<string>")))
    inputs = [*numeric, "_date"]
    if size:
        hot = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], inputCol="_places", outputCol="_hot")
        placed, inputs = hot.transform(placed), ["_hot", *inputs]
    matrix = VectorAssembler(inputCols=inputs, outputCol="features").transform(placed)
    others = [(size + i, name) for i, name in enumerate([*numeric, date])]
    named = numbered.select(F.col("place").cast("long").alias("place"), F.concat_ws("_", "_column", "_value").alias("feature"))
    names = named.unionByName(df.sparkSession.createDataFrame(others, "place long, feature string"))
    return matrix.drop("_date", "_row", "_places", "_hot"), FeatureNames(names, size + len(others))


def stratified_split(
    df: DataFrame, key: str, target: str, train: float = 0.8, seed: int = 42
) -> DataFrame:
    """Flag ``is_train``: the same share of every class, by a seeded hash order."""
    ranked = rank_in_group(df, target, F.xxhash64(F.col(key), F.lit(seed)), key, "_order")
    return ranked.withColumn("is_train", F.col("_order") <= F.round(F.col("_size") * train)).drop("_order", "_size")


def feature_importance(
    matrix: DataFrame,
    names: FeatureNames,
    target: str = "sentiment",
    trees: int = 200,
    depth: int = 30,
    seed: int = 42,
) -> DataFrame:
    """``(feature, importance)`` of a random forest, by falling importance."""
    # labels, splits and trees read it again; its rows are so small that few tasks would hold them all
    cores = matrix.sparkSession.sparkContext.defaultParallelism
    matrix = materialize(matrix.select(target, "features").repartition(2 * cores))
    labelled = StringIndexer(inputCol=target, outputCol="_y", stringOrderType="alphabetAsc").fit(matrix).transform(matrix)
    forest = RandomForestClassifier(
        labelCol="_y", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True
    ).fit(labelled)
    rows = [(place, float(value)) for place, value in enumerate(forest.featureImportances.toArray())]
    found = matrix.sparkSession.createDataFrame(rows, "place long, importance double")
    return names.table.join(found, "place").select("feature", "importance").orderBy(F.desc("importance"), "feature")
