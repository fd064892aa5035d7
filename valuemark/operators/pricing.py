"""Price lines, cost summaries and market benchmarks. Every median is exact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.operators.selection import with_quantiles
from valuemark.session import materialize


def name_key(c: Column | str) -> Column:
    return F.lower(F.trim(c))


def _positive(c: str) -> Column:
    return F.when(F.col(c) > 0, F.col(c))


def priced_lines(prices: DataFrame, s: Settings) -> DataFrame:
    """Target (system, code) pairs in an inpatient or unstated setting, with the rank of the system."""
    codes = [*s.apr_codes, *s.apr_legacy_codes]
    pair = ((F.col("system") == "MS-DRG") & (F.col("code") == s.ms_code)) | ((F.col("system") == "APR-DRG") & F.col("code").isin(*codes))
    setting = F.col("setting").isNull() | (F.trim("setting") == "") | F.col("setting").ilike("%inpatient%")
    return prices.filter(pair & setting).withColumn("system_rank", F.when(F.col("system") == "MS-DRG", 1).otherwise(2))


def provider_pricing(prices: DataFrame, s: Settings, written: bool = False) -> DataFrame:
    """One row a facility name, from its preferred code system only (MS over APR).

    The best system of a facility is an aggregate that is written, a row a facility, and joined back, and medians come by
    selection, so a facility with a large share of all lines is spread over tasks. With ``written``, prices are read from a written
    table, so their lines are not written again.
    """
    columns = [c for c in ("facility_name", "system", "payer", "cash", "negotiated", "ccn") if c in prices.columns]
    lines = priced_lines(prices, s).select(*columns, "system_rank")
    if not written:
        lines = materialize(lines, "lines")
    best = materialize(lines.groupBy(F.col("facility_name").alias("_name")).agg(F.min("system_rank").alias("best")), "best-systems", short=True)
    lines = lines.join(best, F.col("facility_name").eqNullSafe(F.col("_name")) & (F.col("system_rank") == F.col("best"))).drop("_name", "best")
    g = with_quantiles(
        lines, ["facility_name"], {"median_cash": (_positive("cash"), 0.5), "median_negotiated": (_positive("negotiated"), 0.5)},
        F.max("system").alias("pricing_system"), F.count("*").alias("line_count"), F.size(F.collect_set("payer")).cast("long").alias("payer_count"), F.count(_positive("negotiated")).alias("negotiated_lines"),
        F.min(_positive("negotiated")).alias("min_negotiated"), F.max(_positive("negotiated")).alias("max_negotiated"),
        *[F.mode(c, True).alias(c) for c in ("ccn",) if c in prices.columns],  # a file has one, so a facility has few
    ).withColumns({c: F.round(c, 2) for c in ("median_cash", "median_negotiated")})
    basis = F.when(F.col("median_negotiated").isNotNull(), "median_negotiated").when(F.col("median_cash").isNotNull(), "median_cash_price")
    return g.withColumn("procedure_cost", F.coalesce("median_negotiated", "median_cash")).withColumn("price_file_basis", basis)


def weighted_mean(amount: Column, weight: Column) -> Column:
    """Weight of rows without a positive amount is left out below the line, as their amount is above it."""
    return F.round(F.sum(amount * weight) / F.nullif(F.sum(F.when(amount > 0, weight)).cast("double"), F.lit(0.0)), 2)


def latest_only(df: DataFrame, key: list[str], year: str = "year") -> DataFrame:
    """The rows of each key's last year; the years are aggregated first, so a key with many rows is no single task."""
    last = df.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max(year).alias("_latest"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return df.join(last, reduce(lambda a, b: a & b, [*same, F.col(year) == F.col("_latest")])).drop("_latest", *[f"_{k}" for k in key])


def provider_costs(costs: DataFrame, s: Settings) -> DataFrame:
    """Discharge-weighted charge and cost of each provider in its latest year that has a positive charge."""
    own = costs.filter(F.col("procedure_code").isin(*s.procedure_codes))
    year = own.groupBy("provider_id").agg(F.max(F.when(F.col("median_charge") > 0, F.col("year"))).alias("year")).filter("year IS NOT NULL")
    return own.join(year, ["provider_id", "year"]).groupBy("provider_id").agg(weighted_mean(F.col("median_charge"), F.col("discharges")).alias("list_charge"), weighted_mean(F.col("median_cost"), F.col("discharges")).alias("list_cost"), F.max("year").alias("cost_year"))


def market_benchmark(pricing: DataFrame, costs: DataFrame) -> DataFrame:
    """Spread of provider-level costs for each basis; both bases over all priced providers."""
    both = pricing.select(F.lit("mrf_negotiated").alias("cost_basis"), F.col("procedure_cost").alias("cost")).unionByName(costs.select(F.lit("sparcs_charge").alias("cost_basis"), F.col("list_charge").alias("cost")))
    g = with_quantiles(both.filter("cost IS NOT NULL"), ["cost_basis"], {"market_median": (F.col("cost"), 0.5), "p25": (F.col("cost"), 0.25), "p75": (F.col("cost"), 0.75)}, F.count("*").alias("providers"), F.min("cost").alias("least"), F.max("cost").alias("most"))
    return g.withColumns({c: F.round(c, 2) for c in ("market_median", "p25", "p75")})


def procedure_pricing(prices: DataFrame, costs: DataFrame, links: DataFrame, s: Settings) -> DataFrame:
    """Cost of each (provider, procedure): the price file's APR median if there is one, else the weighted list charge."""
    names = F.create_map(*[F.lit(x) for code, n in s.procedure_of_code for x in (f"{code:03d}", n)])
    named = links.filter("facility_name IS NOT NULL").select("provider_id", name_key("facility_name").alias("key"))
    lines = priced_lines(prices, s).filter("system = 'APR-DRG'").withColumn("procedure", names[F.col("code")]).withColumn("key", name_key("facility_name"))
    offers = materialize(lines.filter("procedure IS NOT NULL").join(named, "key").select("provider_id", "procedure", "negotiated"), "offers")
    mrf = with_quantiles(offers, ["provider_id", "procedure"], {"mrf_price": (_positive("negotiated"), 0.5)}).withColumn("mrf_price", F.round("mrf_price", 2)).filter("mrf_price IS NOT NULL")
    by_code = F.create_map(*[F.lit(x) for pair in s.procedure_of_code for x in pair])
    latest = latest_only(costs.withColumn("procedure", by_code[F.col("procedure_code")]).filter("procedure IS NOT NULL"), ["provider_id", "procedure"])
    charge = latest.groupBy("provider_id", "procedure").agg(weighted_mean(F.col("median_charge"), F.col("discharges")).alias("charge"))
    both = mrf.join(charge, ["provider_id", "procedure"], "full_outer")
    return both.select("provider_id", "procedure", F.coalesce("mrf_price", "charge").alias("procedure_cost"), F.when(F.col("mrf_price").isNotNull(), "mrf_negotiated").when(F.col("charge").isNotNull(), "sparcs_charge").alias("cost_basis")).filter("procedure_cost IS NOT NULL")


def procedure_benchmark(priced: DataFrame) -> DataFrame:
    return with_quantiles(priced, ["procedure", "cost_basis"], {"market_median": (F.col("procedure_cost"), 0.5)}, F.count("*").alias("providers")).withColumn("market_median", F.round("market_median", 2))
