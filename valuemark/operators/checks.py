"""Data-quality checks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.operators.clinical import cohort

# Key columns of each derived table.
KEYS = {
    "benchmarks": ("procedure_code", "severity", "year"),
    "provider_metrics": ("provider_id",),
    "procedure_metrics": ("provider_id", "procedure_code"),
    "provider_pricing": ("facility_name",),
    "provider_costs": ("provider_id",),
    "market_benchmark": ("cost_basis",),
    "score_table": ("provider_id",),
    "procedure_pricing": ("provider_id", "procedure"),
    "procedure_benchmark": ("procedure", "cost_basis"),
    "procedure_scores": ("provider_id", "procedure"),
    "provider_outcomes": ("provider_id",),
    "links": ("provider_id",),
    "measure_links": ("provider_id",),
}


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself, once its keys are known to be present and unique."""
    bad = df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).limit(1).collect() or duplicates(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"{keys} is no key: {bad[0].asDict()}")
    return df


def watched(df: DataFrame, keys: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` with what its keys are like observed while it is written: rows, null_keys and repeated.

    Rows are numbered within their key, and that number is dropped again: a table that was just grouped by its keys is
    dealt out by them already, so watching costs a sort of each task's rows and no job of its own.
    """
    seen = Observation(f"keys-{uuid.uuid4().hex}")
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    marked = df.withColumn("_nth", nth).observe(seen, F.count("*").alias("rows"), F.count_if(null).alias("null_keys"), F.count_if((F.col("_nth") > 1) & ~null).alias("repeated"))
    return marked.drop("_nth"), seen


def settled_keys(seen: dict, written: DataFrame, keys: list[str]) -> None:
    """An error that shows a row, if what was observed of a written table says that its keys are none."""
    if seen["null_keys"] or seen["repeated"]:
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        suspects = written.filter(null).limit(1).collect() or duplicates(written, keys).limit(1).collect()
        raise ValueError(f"{keys} is no key: {seen['null_keys']} rows without it, {seen['repeated']} that repeat it, as {suspects[0].asDict() if suspects else None}")


def stage_counts(**tables: DataFrame) -> DataFrame:
    """Row counts of several tables in one action."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("stage"), "rows") for n, t in tables.items()])


def cohort_by_year(discharges: DataFrame, s: Settings) -> DataFrame:
    own = cohort(discharges, s)
    return own.groupBy("year").agg(F.count("*").alias("discharges"), F.count_if("in_market").alias("in_market"), F.count_distinct(F.when(F.col("in_market"), F.col("provider_id"))).alias("market_providers"))


def dispositions(discharges: DataFrame) -> DataFrame:
    from valuemark.functions.scalars import adverse_flag

    return discharges.groupBy("disposition", adverse_flag(F.col("disposition")).alias("adverse")).agg(F.count("*").alias("n"))


def unmapped(metrics: DataFrame, links: DataFrame) -> DataFrame:
    """Providers without a link row, and those whose link has no name."""
    none = metrics.join(links, "provider_id", "left_anti").agg(F.count("*").alias("without_row"))
    blank = metrics.join(links.filter("facility_name IS NULL"), "provider_id", "left_semi").agg(F.count("*").alias("without_name"))
    return none.crossJoin(blank)  # one row each


def implausible(scores: DataFrame) -> DataFrame:
    return scores.filter("clinical_oe > 3 OR clinical_oe < 0.25 OR cost > 500000 OR cost < 5000")


def best(scores: DataFrame, n: int = 15) -> DataFrame:
    return scores.filter("value_index IS NOT NULL").orderBy(F.desc("value_index"), "provider_id").limit(n)
