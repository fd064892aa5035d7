"""Risk adjustment by indirect standardization over additive stratum cells.

The discharge table is grouped once, by provider, procedure, severity, year and market. Benchmarks, provider
metrics and per-procedure metrics are sums over those cells, so the large table is shuffled once, after
partial aggregation, and never joined row by row. Cells are sums and counts: new releases merge by addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.functions import scalars as S

CELL_KEYS = ("provider_id", "procedure_code", "severity", "year", "in_market")
STRATUM = ("procedure_code", "severity", "year")
CELL_SUMS = ("n", "n_flag", "sum_los", "sum_flag", "sum_severity")


def cohort(discharges: DataFrame, s: Settings) -> DataFrame:
    """Rows that count, with los, adverse and in_market derived."""
    keep = F.col("procedure_code").isin(*s.procedure_codes) & F.col("severity").between(1, 4) & F.col("provider_id").isNotNull() & (F.trim("provider_name") != "") & F.col("year").isNotNull()
    if s.elective_only:
        keep &= F.lower("admission") == "elective"
    if s.exclude_extreme_risk:
        keep &= F.coalesce(F.lower("risk") != "extreme", F.lit(True))
    return discharges.filter(keep).select(
        "provider_id", "provider_name", "certificate", "county", S.zip3(F.col("zip3")).alias("zip3"), "procedure_code", F.col("severity").cast("int").alias("severity"), "year",
        S.in_market(F.col("county"), F.col("area"), s).alias("in_market"), S.parse_los(F.col("los_raw"), s.los_censor).alias("los"), S.adverse_flag(F.col("disposition")).alias("adverse"),
    ).filter("los IS NOT NULL")


def drop_reasons(discharges: DataFrame, s: Settings) -> DataFrame:
    """Why rows leave the cohort: one pass, one row."""
    c = F.col
    return discharges.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~F.coalesce(c("procedure_code").isin(*s.procedure_codes), F.lit(False))).alias("other_procedure"),
        F.count_if(~F.coalesce(c("severity").between(1, 4), F.lit(False))).alias("bad_severity"),
        F.count_if(S.parse_los(c("los_raw"), s.los_censor).isNull()).alias("bad_los"),
        F.count_if(c("provider_id").isNull()).alias("no_provider"),
        F.count_if(~F.coalesce(F.lower("admission") == "elective", F.lit(False))).alias("not_elective"),
        F.count_if(F.coalesce(F.lower("risk") == "extreme", F.lit(False))).alias("extreme_risk"),
    )


def cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL_KEYS).agg(
        F.count("*").alias("n"), F.count("adverse").alias("n_flag"), F.sum("los").alias("sum_los"),
        F.coalesce(F.sum("adverse"), F.lit(0)).alias("sum_flag"), F.sum("severity").alias("sum_severity"),
    )


def merge_cells(*parts: DataFrame) -> DataFrame:
    """Cells of several releases as one."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy(*CELL_KEYS).agg(*[F.sum(c).alias(c) for c in CELL_SUMS])


def _mean(total: str, count: str) -> Column:
    return F.sum(total).cast("double") / F.nullif(F.sum(count), F.lit(0)).cast("double")


def benchmarks(cell: DataFrame, s: Settings) -> DataFrame:
    """Expected stay and adverse rate of every stratum, rounded before use."""
    reference = cell if s.benchmark_scope == "statewide" else cell.filter("in_market")
    return reference.groupBy(*STRATUM).agg(F.sum("n").alias("stratum_n"), F.round(_mean("sum_los", "n"), 4).alias("expected_los"), F.round(_mean("sum_flag", "n_flag"), 6).alias("expected_adverse"))


def _metrics(cell: DataFrame, bench: DataFrame, keys: list[str], extra: list[Column]) -> DataFrame:
    """Observed against expected; the expected rate weighs every row that has one, the observed rate only known flags."""
    joined = cell.filter("in_market").join(F.broadcast(bench), list(STRATUM))  # at most procedures x 4 x years rows
    n = F.col("n").cast("double")
    has = F.when(F.col("expected_adverse").isNotNull(), n)
    g = joined.groupBy(*keys).agg(
        F.sum("n").alias("patient_volume"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), _mean("sum_severity", "n").alias("avg_severity"),
        _mean("sum_los", "n").alias("obs_los"), (F.sum(n * F.col("expected_los")) / F.sum(n)).alias("exp_los"),
        _mean("sum_flag", "n_flag").alias("obs_adv"), (F.sum(n * F.col("expected_adverse")) / F.nullif(F.sum(has), F.lit(0.0))).alias("exp_adv"), *extra,
    )
    los, adv = S.ratio(F.col("obs_los"), F.col("exp_los")), S.ratio(F.col("obs_adv"), F.col("exp_adv"))
    thin = F.col("obs_adv").isNull() | (F.col("obs_adv") == 0) | F.col("exp_adv").isNull() | (F.col("exp_adv") == 0)
    composite = F.when(F.col("exp_los").isNull() | (F.col("exp_los") == 0), F.lit(None).cast("double")).when(thin, los).otherwise(F.sqrt(los * adv))
    return g.select(
        *keys, "patient_volume", "first_year", "last_year", *[c for c in ("hip_volume", "knee_volume") if c in g.columns], F.round("avg_severity", 2).alias("avg_severity"),
        F.round("obs_los", 2).alias("observed_los"), F.round("exp_los", 2).alias("expected_los"), F.round(los, 3).alias("oe_los"),
        F.round(F.col("obs_adv") * 100, 2).alias("observed_adverse_pct"), F.round(F.col("exp_adv") * 100, 2).alias("expected_adverse_pct"), F.round(adv, 3).alias("oe_adverse"), F.round(composite, 3).alias("oe_composite"),
    )


def _select_metric(df: DataFrame, s: Settings) -> DataFrame:
    return df.withColumn("clinical_oe", F.coalesce("oe_composite", "oe_los") if s.oe_metric == "composite" else F.col("oe_los"))


def provider_metrics(cell: DataFrame, bench: DataFrame, s: Settings) -> DataFrame:
    volume = lambda code, name: F.coalesce(F.sum(F.when(F.col("procedure_code") == code, F.col("n"))), F.lit(0)).alias(name)
    done = _metrics(cell, bench, ["provider_id"], [volume(s.hip_code, "hip_volume"), volume(s.knee_code, "knee_volume")])
    return _select_metric(done.filter(F.col("patient_volume") >= s.min_volume), s)


def procedure_metrics(cell: DataFrame, bench: DataFrame, s: Settings) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in s.procedure_of_code for x in pair])
    done = _metrics(cell, bench, ["provider_id", "procedure_code"], []).withColumn("procedure", names[F.col("procedure_code")])
    return _select_metric(done.filter(F.col("patient_volume") >= s.procedure_floor), s)


def provider_attributes(rows: DataFrame) -> DataFrame:
    """Latest display name (least on ties) and the most frequent certificate, county and ZIP3 (least on ties).

    Values are counted first, so no list grows with a provider's rows.
    """
    market = rows.filter("in_market")
    names = market.groupBy("provider_id").agg(F.min_by("provider_name", F.struct(-F.col("year"), F.col("provider_name"))).alias("provider_name"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in ("certificate", "county", "zip3")])).alias("x")
    counted = market.select("provider_id", pairs).select("provider_id", "x.attribute", "x.value").filter("value IS NOT NULL").groupBy("provider_id", "attribute", "value").count()
    top = counted.groupBy("provider_id", "attribute").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value"))
    wide = top.groupBy("provider_id").agg(*[F.max(F.when(F.col("attribute") == c, F.col("value"))).alias(c) for c in ("certificate", "county", "zip3")])
    return names.join(wide, "provider_id", "left")
