"""The value index: clinical, financial and experience terms with exponents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.functions import scalars as S
from valuemark.operators.pricing import name_key


def index_terms(oe: Column, market: Column, cost: Column, volume: Column) -> tuple[Column, Column, Column]:
    return S.ratio(F.lit(1.0), oe), S.ratio(market, cost), F.ln(volume.cast("double") + 1.0)


def value_index(oe: Column, market: Column, cost: Column, volume: Column, s: Settings) -> Column:
    a, b, c = index_terms(oe, market, cost, volume)
    return F.round(F.pow(a, F.lit(s.weight_clinical)) * F.pow(b, F.lit(s.weight_financial)) * F.pow(c, F.lit(s.weight_experience)), 3)


def score_table(metrics: DataFrame, attributes: DataFrame, links: DataFrame, pricing: DataFrame, costs: DataFrame, market: DataFrame, s: Settings) -> DataFrame:
    """One row a provider: linked, priced, benchmarked against providers of the same cost basis, and scored."""
    price = pricing.select(name_key("facility_name").alias("price_key"), "median_cash", "median_negotiated", "min_negotiated", "max_negotiated", F.col("procedure_cost").alias("mrf_cost"), "price_file_basis", "pricing_system", "payer_count")
    link = links.select("provider_id", F.col("facility_name").alias("price_name"), "match_method", "match_score", "reviewed")
    joined = metrics.join(attributes, "provider_id", "left").join(link, "provider_id", "left")
    joined = joined.join(price, name_key("price_name") == F.col("price_key"), "left").drop("price_key").join(costs, "provider_id", "left")
    priced = joined.withColumn("cost", F.coalesce("mrf_cost", "list_charge")).withColumn("cost_basis", F.when(F.col("mrf_cost").isNotNull(), "mrf_negotiated").when(F.col("list_charge").isNotNull(), "sparcs_charge"))
    m = F.broadcast(market.select("cost_basis", "market_median"))  # a row for each of two bases
    scored = priced.join(m, "cost_basis", "left")
    a, b, c = index_terms(F.col("clinical_oe"), F.col("market_median"), F.col("cost"), F.col("patient_volume"))
    status = F.when(F.col("price_name").isNull(), "unmapped_facility").when(F.col("cost").isNull(), "no_published_price").when(F.col("clinical_oe").isNull(), "no_clinical_benchmark").otherwise("complete")
    return (
        scored.withColumn("clinical_multiplier", F.round(a, 4))
        .withColumn("financial_multiplier", F.round(b, 4))
        .withColumn("experience_modifier", F.round(c, 4))
        .withColumn("value_index", value_index(F.col("clinical_oe"), F.col("market_median"), F.col("cost"), F.col("patient_volume"), s))
        .withColumn("clinical_only_index", F.round(a * c, 3))
        .withColumn("data_status", status)
    )


def procedure_scores(metrics: DataFrame, priced: DataFrame, bench: DataFrame, s: Settings) -> DataFrame:
    joined = metrics.join(priced, ["provider_id", "procedure"], "left").join(F.broadcast(bench.select("procedure", "cost_basis", "market_median")), ["procedure", "cost_basis"], "left")
    return joined.withColumn("value_index", value_index(F.col("clinical_oe"), F.col("market_median"), F.col("procedure_cost"), F.col("patient_volume"), s))
