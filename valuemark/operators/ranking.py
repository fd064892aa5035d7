"""Ranks, percentiles and tiers, also over tables too large for one task, and the consumer views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuemark.functions import scalars as S
from valuemark.session import materialize


def pct_vs_market(cost: str = "cost", market: str = "market_median") -> Column:
    return F.round(S.ratio((F.col(cost) - F.col(market)) * 100.0, F.col(market)), 1)


def ranked(df: DataFrame, partition: list[str] | None = None, key: str = "provider_id") -> DataFrame:
    """value_rank, value_percentile and star_rating of rows with an index; the others keep nulls. Ties in tiers go by ``key``.

    With ``partition`` each group is ranked. Positions come from ``global_positions`` either way, so no task holds the
    whole table, nor a group with a large share of it.
    """
    rest = df.filter("value_index IS NULL").withColumns({"value_rank": F.lit(None).cast("long"), "value_percentile": F.lit(None).cast("double"), "star_rating": F.lit(None).cast("int")})
    return global_ranks(df.filter("value_index IS NOT NULL"), "value_index", key, groups=partition or []).unionByName(rest)


def _same(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(columns)])


def global_positions(df: DataFrame, value: str, key: str, groups: list[str] | None = None) -> DataFrame:
    """pos (0 upwards by value, then key), least_pos and most_pos of equal values, and total, each within its group.

    No window holds a group or the table: rows are range-partitioned by group, value and key, so a large group and equal
    values spread over tasks as others do, and written once with their partition; positions are places in a partition
    behind the counts of the partitions before, less where the group starts.
    """
    groups = groups or []
    part, nth, order = "_part", "_nth", [*groups, value, key]
    spread = materialize(df.repartitionByRange(*[F.col(c) for c in order]).withColumn(part, F.spark_partition_id()), "spread")
    sizes = spread.groupBy(part).agg(F.count("*").alias("_size"))  # a row for each partition
    starts = sizes.select(part, F.coalesce(F.sum("_size").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    placed = spread.withColumn(nth, F.row_number().over(Window.partitionBy(part).orderBy(*order))).join(F.broadcast(starts), part)
    placed = materialize(placed.withColumn("pos", F.col("_start") + F.col(nth) - 1).drop(part, nth, "_start"), "positions")
    named = lambda columns: [F.col(c).alias(f"_{k}") for k, c in enumerate(columns)]
    ends = placed.groupBy(*named([*groups, value])).agg(F.min("pos").alias("least_pos"), F.max("pos").alias("most_pos"))
    placed = placed.join(ends, _same([*groups, value])).drop(*[f"_{k}" for k in range(len(groups) + 1)])
    if not groups:
        return placed.crossJoin(F.broadcast(placed.agg(F.count("*").alias("total"))))  # one row
    totals = placed.groupBy(*named(groups)).agg(F.count("*").alias("total"), F.min("pos").alias("_first"))
    placed = placed.join(totals, _same(groups))
    return placed.withColumns({c: F.col(c) - F.col("_first") for c in ("pos", "least_pos", "most_pos")}).drop("_first", *[f"_{k}" for k in range(len(groups))])


def global_ranks(df: DataFrame, value: str, key: str, tiers: int = 5, groups: list[str] | None = None) -> DataFrame:
    """rank (descending), percent rank (ascending) and ntile by arithmetic on positions."""
    p = global_positions(df, value, key, groups)
    small, extra = F.floor(F.col("total") / tiers), F.col("total") % tiers
    edge = extra * (small + 1)
    tile = F.when(F.col("pos") < edge, F.floor(F.col("pos") / (small + 1)) + 1).otherwise(extra + F.floor((F.col("pos") - edge) / F.greatest(small, F.lit(1))) + 1)
    share = F.when(F.col("total") > 1, F.col("least_pos") / (F.col("total") - 1)).otherwise(F.lit(0.0))
    return p.withColumns({"value_rank": (F.col("total") - F.col("most_pos")).cast("long"), "value_percentile": F.round(share * 100, 1), "star_rating": tile.cast("int")}).drop("pos", "least_pos", "most_pos", "total")


def consumer_view(scores: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Combined ranking: boroughs, years observed, percent against the market, ranks and tiers, outcomes beside."""
    view = ranked(scores).withColumn("borough", S.borough(F.col("county"))).withColumn("years_observed", F.col("last_year") - F.col("first_year") + 1).withColumn("pct_vs_market", pct_vs_market())
    return view.join(outcomes, "provider_id", "left") if outcomes is not None else view


def chosen_view(combined: DataFrame, by_procedure: DataFrame | None, choice: str | None) -> DataFrame:
    """The rows that a reader looks at: all procedures together, or one of them where its scores are published.

    ``choice`` is None (combined) or a procedure's name; without a per-procedure table the combined rows stay.
    """
    if choice is None or by_procedure is None or "procedure" not in by_procedure.columns:
        return combined
    return by_procedure.filter(F.col("procedure") == choice)


def column_or(view: DataFrame, name: str, default: object = None) -> Column:
    """A column of a view that may lack it, then a set value."""
    return F.col(name) if name in view.columns else F.lit(default)


def procedure_view(scores: DataFrame) -> DataFrame:
    return ranked(scores.filter("value_index IS NOT NULL"), ["procedure"]).withColumn("pct_vs_market", pct_vs_market("procedure_cost"))


def export_view(view: DataFrame) -> DataFrame:
    return view.filter("value_index IS NOT NULL")


def market_view(view: DataFrame, boroughs: list[str] | None = None, max_cost: float | None = None, min_volume: int | None = None, min_stars: int | None = None) -> DataFrame:
    """Interactive filters; nulls drop out, and a filter on a missing column is passed over."""
    rules = (("borough", boroughs, lambda c, v: c.isin(*v)), ("cost", max_cost, lambda c, v: c <= v), ("patient_volume", min_volume, lambda c, v: c >= v), ("star_rating", min_stars, lambda c, v: c >= v))
    for name, value, rule in rules:
        if value is not None and name in view.columns:
            view = view.filter(rule(F.col(name), value))
    return view


def headline(view: DataFrame) -> DataFrame:
    spread = F.when(F.count("cost") > 1, F.max("cost") - F.min("cost"))
    return view.agg(F.count("*").alias("providers"), F.round(F.median("cost"), 2).alias("median_cost"), F.round(spread, 2).alias("spread"), F.coalesce(F.sum("patient_volume"), F.lit(0)).alias("volume"))


def basis_lines(view: DataFrame) -> DataFrame:
    return view.groupBy("cost_basis").agg(F.max("market_median").alias("market_median"))
