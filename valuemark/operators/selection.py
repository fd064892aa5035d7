"""Exact quantiles of groups of any size.

Small groups sort their values in one task. A group with more rows than that is never brought together: its values are
counted in ranges between its least and its greatest, the range that holds a wanted place is cut again, and so on until
a range is small or all its values are equal. Each round is counts, with most of the work done before any shuffle, and
keeps only the rows of the ranges that are still open.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuemark.session import materialize

#: Values that one task may sort for a group, and ranges that a group is cut into.
MOST_SORTED, RANGES = 1 << 16, 1024


def selected(rows: DataFrame, places: DataFrame, most: int = MOST_SORTED, ranges: int = RANGES) -> DataFrame:
    """gid, k and the value at place ``k`` (from 0) in the order of each group's values.

    rows: gid (a text that names the group) and v (a double, no nulls); places: gid and k.
    """
    open_rows, wanted, found = rows.select("gid", "v", F.lit("").alias("path")), places.select("gid", F.col("k").alias("at"), "k", F.lit("").alias("path")), []
    while True:
        ends = open_rows.groupBy("gid", "path").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
        wanted = materialize(wanted.join(ends, ["gid", "path"]), "places")
        found.append(wanted.filter("lo = hi").select("gid", "k", F.col("lo").alias("value")))
        few = wanted.filter(F.expr("lo < hi") & (F.col("n") <= most))
        lists = open_rows.join(few.select("gid", "path").distinct(), ["gid", "path"]).groupBy("gid", "path").agg(F.array_sort(F.collect_list("v")).alias("vs"))  # at most ``most`` values each
        found.append(few.join(lists, ["gid", "path"]).select("gid", "k", F.get("vs", F.col("at").cast("int")).alias("value")))
        wide = wanted.filter(F.expr("lo < hi") & (F.col("n") > most))
        if wide.isEmpty():
            return functools.reduce(DataFrame.unionByName, found)
        # Any digit that does not fall as values grow will do; so rounding does no harm.
        digit = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * ranges), F.lit(ranges - 1)).cast("int")
        cut = open_rows.join(wide.select("gid", "path", "lo", "hi").distinct(), ["gid", "path"]).withColumn("digit", digit).select("gid", "path", "v", "digit")
        counts = cut.groupBy("gid", "path", "digit").agg(F.count("*").alias("size"))
        before = Window.partitionBy("gid", "path").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # at most ``ranges`` rows
        counts = counts.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        hit = wide.join(counts, ["gid", "path"]).filter("at >= before AND at < before + size")
        longer = F.concat("path", F.lit("."), F.col("digit").cast("string"))
        wanted = materialize(hit.select("gid", (F.col("at") - F.col("before")).alias("at"), "k", longer.alias("path")), "places")
        open_rows = materialize(cut.select("gid", longer.alias("path"), "v").join(wanted.select("gid", "path").distinct(), ["gid", "path"], "left_semi"), "ranges")


def _hot(rows: DataFrame, wanted: Mapping[str, tuple[Column, float]], most: int, ranges: int) -> DataFrame:
    """gid and each wanted quantile of groups too large for a task; ``rows`` are theirs, with gid."""
    values = materialize(rows.select("gid", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("v")) for n, (c, _) in wanted.items()])).alias("x")).select(F.concat("gid", F.lit("|"), F.col("x.name")).alias("gid"), F.col("gid").alias("own"), "x.name", "x.v").filter("v IS NOT NULL"), "values")
    sizes = values.groupBy("gid", "own", "name").agg(F.count("*").alias("n"))
    share = functools.reduce(lambda a, n: a.when(F.col("name") == n, wanted[n][1]), wanted, F.when(F.lit(False), 0.0))
    place = sizes.withColumn("place", (F.col("n") - 1) * share)
    places = place.select("gid", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("k"))
    at = selected(values.select("gid", "v"), places, most, ranges)
    low, high = (at.select("gid", F.col("k").alias(f"{side}_k"), F.col("value").alias(side)) for side in ("low", "high"))
    both = place.join(low, "gid").filter(F.col("low_k") == F.floor("place")).join(high, "gid").filter(F.col("high_k") == F.ceil("place"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.ceil("place") - F.col("place")) * F.col("low") + (F.col("place") - F.floor("place")) * F.col("high"))
    return both.groupBy(F.col("own").alias("gid")).agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n in wanted])


def _between(values: str, share: float) -> Column:
    """The quantile of a sorted list, between neighbours; null if it is empty."""
    place = (F.size(values) - 1) * F.lit(share)
    low, high = (F.get(values, side.cast("int")) for side in (F.floor(place), F.ceil(place)))
    return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)


def with_quantiles(df: DataFrame, keys: list[str], wanted: Mapping[str, tuple[Column, float]], *others: Column, most: int = MOST_SORTED, ranges: int = RANGES) -> DataFrame:
    """``df`` grouped by ``keys`` with ``others`` (aggregates) and the wanted quantiles, a column and a share each; exact, as between neighbours.

    Groups of at most ``most`` rows are aggregated as they stand; the counts that tell them apart are one pass.
    """
    if any(not (0 <= p <= 1) or math.isnan(p) for _, p in wanted.values()):
        raise ValueError("a share lies between 0 and 1")
    lists = [F.sort_array(F.collect_list(c.cast("double"))).alias(n) for n, (c, _) in wanted.items()]  # eight bytes a value; what counts values by hash moves thrice that
    plain = lambda grouped: grouped.agg(*others, *lists).withColumns({n: _between(n, p) for n, (_, p) in wanted.items()})
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*[F.col(k).alias(f"_{k}") for k in keys])
    large = materialize(sizes, "large-groups")  # one group in ``most`` rows at most
    if large.isEmpty():
        return plain(df.groupBy(*keys))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    small = plain(df.join(large, same, "left_anti").groupBy(*keys))
    hot = df.join(large, same, "left_semi")
    gid = F.to_json(F.struct(*keys))
    about = hot.groupBy(*keys).agg(*others).withColumn("gid", gid) if others else hot.select(*keys).distinct().withColumn("gid", gid)
    told = about.join(_hot(hot.withColumn("gid", gid), wanted, most, ranges), "gid", "left").drop("gid")
    return small.unionByName(told)
