"""Session settings and the one place that decides where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, app: str = "recensio") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="recensio-checkpoint-")
    sc.setCheckpointDir(folder)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, for functions that run in Python workers."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="recensio-package-")) / "recensio_package.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(top.rglob("*.py")):
            z.write(source, source.relative_to(top.parent))
    sc.addPyFile(str(file))
    _shipped.add(sc.applicationId)


_given: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, for tables that queries write."""
    _ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Delete the tables that this application has written so far; returns their number.

    Results that still read them must be written or collected before.
    """
    folders = _given.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(folders)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it back.

    Used where a result feeds several branches or an iteration: a lost executor
    costs a re-read and not a recomputation of the whole history. Unlike a
    checkpoint, the table is columnar, so later scans prune columns, push
    filters down and know its size.
    """
    folder = shared_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
