"""Readers for reviews and the label taxonomy."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recensio.session import materialize
from recensio.sources import writers
from recensio.sources.records import quoted_records

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.LongType()),
        T.StructField("review", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("review_date", T.DateType()),
    ]
)
TAXONOMY_SCHEMA = T.StructType(
    [
        T.StructField("old_label_name", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("parent_label", T.StringType()),
    ]
)
FORMATS = ("parquet", "orc", "csv", "json")


MODES = {"permissive": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW_SCHEMA,
    format: str | None = None,
    on_error: str = "raise",
    multi_line: bool | str = True,
    malformed: str = "permissive",
    rejected: str | None = None,
    **options: str,
) -> DataFrame:
    """Read ``path`` with an explicit schema.

    ``on_error='raise'`` turns a failed load into ``ValueError``; ``'empty'``
    gives an empty table of the same schema instead. A CSV file whose quoted
    fields may hold line breaks (``multi_line``) is one task, whatever its size;
    without them it is split. ``multi_line='split'`` splits it all the same, if
    quotes stand only around fields and are doubled inside them. ``malformed``
    says what becomes of CSV and JSON rows that do not fit the schema:
    ``'permissive'`` leaves their fields null, ``'drop'`` leaves them out,
    ``'fail'`` ends the job that reads them. ``rejected`` names a further text
    column with the record of such a row as it was read, null for the others.
    """
    if malformed not in MODES:
        raise ValueError(f"malformed is one of {tuple(MODES)}")
    if on_error not in ("raise", "empty"):
        raise ValueError("on_error is 'raise' or 'empty'")
    if multi_line not in (True, False, "split"):
        raise ValueError("multi_line is True, False or 'split'")
    if rejected is not None and rejected.lower() in {name.lower() for name in schema.names}:
        raise ValueError(f"the schema has a column {rejected!r} of its own")
    wanted = schema if rejected is None else T.StructType([*schema.fields, T.StructField(rejected, T.StringType())])
    try:
        kind = format or path.rstrip("/").rsplit(".", 1)[-1].lower()
        if kind not in FORMATS:
            raise ValueError(f"unsupported format {kind!r}; use one of {FORMATS}")
        if kind not in ("csv", "json"):
            found = spark.read.schema(schema).options(**options).format(kind).load(path)
            return found if rejected is None else found.withColumn(rejected, F.lit(None).cast("string"))
        if rejected is not None:
            options = {"columnNameOfCorruptRecord": rejected, **options}
        if kind == "csv" and multi_line == "split":
            return _split_csv(spark, path, schema, wanted, malformed, options)
        if kind == "csv":
            options = {"header": "true", "multiLine": str(multi_line).lower(), "escape": '"', **options}
        options = {"mode": MODES[malformed], **options}
        return spark.read.schema(wanted).options(**options).format(kind).load(path)
    except (PySparkException, ValueError) as error:
        if on_error == "empty":
            return spark.createDataFrame([], wanted)
        raise ValueError(f"failed to load {path}: {error}") from error


def _split_csv(
    spark: SparkSession, path: str, schema: T.StructType, wanted: T.StructType, malformed: str, options: dict[str, str]
) -> DataFrame:
    quote = options.get("quote", '"')
    if options.get("escape", quote) != quote:
        raise ValueError("a CSV file is split only where quotes are escaped by doubling")
    header = str(options.get("header", "true")).lower() == "true"
    records = quoted_records(spark, path, quote, header)
    bad = options.get("columnNameOfCorruptRecord", "_bad")
    while bad not in wanted.names and bad.lower() in {name.lower() for name in wanted.names}:
        bad += "_"
    inner = wanted if bad in wanted.names else T.StructType([*wanted.fields, T.StructField(bad, T.StringType())])
    mode = "FAILFAST" if malformed == "fail" else "PERMISSIVE"
    settings = {**options, "escape": quote, "multiLine": "true", "mode": mode, "columnNameOfCorruptRecord": bad}
    settings.pop("header", None)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in inner)
    rows = records.select(F.from_csv("record", ddl, settings).alias("row")).select("row.*")
    if malformed == "drop":
        rows = rows.filter(F.col(f"`{bad}`").isNull())
    return rows.select(*[F.col(f"`{name}`") for name in wanted.names])


def checked_table(
    spark: SparkSession, path: str, run_name: str, metrics: str, schema: T.StructType = REVIEW_SCHEMA, **settings
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``path`` that fit ``schema``, and ``(record)`` of those that do not.

    What was read is parsed and written once; ``rows_read`` and ``rows_rejected``
    are added to the metric log ``metrics``. ``settings`` are those of ``load_table``.
    """
    name = "_record"
    while name in {n.lower() for n in schema.names}:
        name += "_"
    table = materialize(load_table(spark, path, schema, rejected=name, **settings))
    counts = table.agg(F.count(F.lit(1)).alias("rows_read"), F.count(name).alias("rows_rejected"))
    writers.log_metrics(counts, run_name, metrics)
    kept = table.filter(F.col(name).isNull()).drop(name)
    return kept, table.filter(F.col(name).isNotNull()).select(F.col(name).alias("record"))


def load_taxonomy(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return load_table(spark, path, TAXONOMY_SCHEMA, **options)


def taxonomy_labels(taxonomy: DataFrame, column: str | None = None, order: str | None = None) -> DataFrame:
    """Distinct labels of one column (default: the first), as text.

    ``pos`` is the smallest ``order`` value of a label, for "first wins" ties;
    without ``order`` it is the label itself. A missing label is the word ``nan``.
    """
    label = F.coalesce(F.col(column or taxonomy.columns[0]).cast("string"), F.lit("nan"))
    rows = taxonomy.select(label.alias("label"), (F.col(order) if order else label).alias("pos"))
    return rows.groupBy("label").agg(F.min("pos").alias("pos"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy text work a task per core when the input has few splits.

    A file with one row group is read by one task however large the cluster is;
    inputs with a split for each core are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, key)
