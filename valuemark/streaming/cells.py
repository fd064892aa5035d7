"""Stratum cells kept up to date from a folder that releases arrive in.

Cells are sums, so each micro-batch adds a small table of its own. A batch writes under its number and
overwrites itself when it is repeated, so every arriving file counts exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from valuemark.config import Settings
from valuemark.operators.clinical import CELL_KEYS, CELL_SUMS, cells, cohort, merge_cells


def maintain_cells(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, s: Settings) -> None:
    """Take in every file of ``source`` that has not been taken in yet, then stop."""

    def add(batch: DataFrame, number: int) -> None:
        cells(cohort(batch, s)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current_cells(spark: SparkSession, target: str) -> DataFrame:
    return merge_cells(spark.read.parquet(target).select(*CELL_KEYS, *CELL_SUMS))
