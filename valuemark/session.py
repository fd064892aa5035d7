"""Session and storage helpers shared by every part of the library."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Rows of an Arrow batch to Python, where the session has Spark's own number: ten thousand whole texts are too many to hold on both sides at once.
BATCH, BATCH_ROWS, SPARKS_OWN = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000, "10000"


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once an application, wherever they run; and batches of a size for texts."""
    if spark.conf.get(BATCH) == SPARKS_OWN:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only where none is configured."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    java_context = spark.sparkContext._jsc.sc()
    if java_context.getCheckpointDir().isEmpty():
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return java_context.getCheckpointDir().get().rstrip("/")


#: Folders of the scratches that are open, the innermost last.
_scratches: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{_scratches[-1] if _scratches else shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is written to the shared folder within goes when the block ends; results that are still lazy then are lost."""
    folder = fresh_path(spark, "scratch")
    _scratches.append(folder)
    try:
        yield folder
    finally:
        _scratches.remove(folder)
        _delete(spark, folder)


#: Files a core that a table of short rows is written to at most.
FILES_PER_CORE = 4


def materialize(df: DataFrame, label: str, short: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and lost executors cost nothing.

    ``short`` says that rows are a few numbers, so that a few files a core will do, however many partitions
    there are: what reads them later has as many tasks, and each of its shuffles as many files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    (df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism) if short else df).write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._folder = path
    return read


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` gave, once nothing that is still to run reads it."""
    _delete(df.sparkSession, df._folder)
