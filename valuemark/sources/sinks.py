"""Writers of staging tables, exports and snapshots."""

from __future__ import annotations

import datetime
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from valuemark.functions import scalars as S
from valuemark.operators.ranking import export_view


def without_empty_texts(df: DataFrame, but: str | None = None) -> DataFrame:
    text = {n for n, t in df.dtypes if t == "string"}
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in text and c != but else F.col(c) for c in df.columns])


def write_staging(df: DataFrame, path: str, mode: str = "overwrite", partition: str | None = "release") -> None:
    """Empty texts become null. Overwriting a table that is partitioned by release replaces the releases at hand only."""
    clean = without_empty_texts(df, partition)
    writer = clean.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(partition) if partition and partition in df.columns else writer).parquet(path)


def export_csv(view: DataFrame, folder: str, complete_only: bool = True, day: datetime.date | None = None) -> str:
    """Ranked rows by index as one dated CSV folder; a result is a row a provider."""
    rows = export_view(view) if complete_only else view
    if rows.isEmpty():
        warnings.warn("nothing to export", stacklevel=2)
    path = f"{folder}/value_scores_{(day or datetime.date.today()).isoformat()}"
    rows.orderBy(F.desc_nulls_last("value_index"), "provider_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def publish(combined: DataFrame, by_procedure: DataFrame, folder: str) -> dict[str, str]:
    """Both snapshots; a failing second one leaves the first in place."""
    done = {}
    for name, df, order in (("combined", combined, [F.desc_nulls_last("value_index"), "provider_id"]), ("by_procedure", by_procedure, ["procedure", F.desc_nulls_last("value_index"), "provider_id"])):
        try:
            df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            done[name] = "ok"
        except Exception as e:
            if name == "combined":
                raise
            done[name] = f"failed: {str(e).splitlines()[0]}"
    return done


def read_reviewed(spark: SparkSession, path: str) -> DataFrame:
    """A reviewed link file, with or without a byte-order mark."""
    df = spark.read.csv(path, header=True)
    return df.toDF(*[S.clean_header(c.lstrip("﻿")) for c in df.columns])


def read_or_fallback(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """The first snapshot that can be read, else an empty frame of the same shape."""
    for path in paths:
        try:
            kind = spark.read.csv(path, header=True, schema=schema) if path.endswith(".csv") or "csv" in path else spark.read.parquet(path)
            kind.limit(1).collect()
            return kind
        except Exception:  # the next source stands in
            continue
    return spark.createDataFrame([], schema)
