"""Checks run the operators as the operators' own queries do."""

from conftest import SF_DIR

from recensio.catalog import checks


def test_importance_check_uses_the_whole_forest(spark, monkeypatch):
    given = []

    def importance(matrix, names, **settings):
        given.append(settings)
        return spark.createDataFrame([(n, 1 / len(names)) for n in names], "feature string, importance double")

    monkeypatch.setattr(checks.forest, "feature_importance", importance)
    row = checks.m17b(spark, SF_DIR).first()
    assert given == [{}] and all(row)


def test_the_forest_reads_a_matrix_that_was_computed_once(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import functions as F

    from recensio.operators import forest

    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return Vectors.dense(float(v), float(v % 3))

    made = F.udf(counted, VectorUDT()).asNondeterministic()
    matrix = spark.range(40).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("sentiment"), made("id").alias("features"))
    names = forest.FeatureNames(spark.createDataFrame([(0, "x"), (1, "y")], "place long, feature string"), 2)
    assert forest.feature_importance(matrix, names, trees=2, depth=2).count() == 2
    assert seen.value == 40
