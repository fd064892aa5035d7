"""Long-format outcome measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = {"COMP_HIP_KNEE": "complication_rate", "READM_30_HIP_KNEE": "readmission_rate", "CMS_OVERALL_RATING": "overall_rating"}


def provider_outcomes(links: DataFrame, measures: DataFrame, names: dict[str, str] = MEASURES) -> DataFrame:
    """Linked providers with one column a measure: grouping with a fixed list, so no discovery job."""
    joined = links.select("provider_id", "ccn").join(measures, "ccn")
    return joined.groupBy("provider_id", "ccn").agg(*[F.max(F.when(F.col("measure_id") == k, F.col("score"))).alias(v) for k, v in names.items()])


def proxy_validation(scores: DataFrame, outcomes: DataFrame, proxy: str = "clinical_oe", outcome: str = "complication_rate") -> DataFrame:
    """How far the proxy goes with a reported outcome, over providers that have both."""
    both = scores.join(outcomes, "provider_id").filter(F.col(proxy).isNotNull() & F.col(outcome).isNotNull())
    return both.agg(F.count("*").alias("n"), F.round(F.corr(F.col(proxy).cast("double"), F.col(outcome).cast("double")), 4).alias("correlation"))
