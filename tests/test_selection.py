"""Quantiles of groups of any size, and positions within groups, against sorting them."""

import random

import pytest
from pyspark.sql import functions as F

from valuemark.operators import ranking
from valuemark.operators.selection import with_quantiles


def interpolated(values, p):
    values = sorted(values)
    if not values:
        return None
    place = (len(values) - 1) * p
    low, high = int(place), min(int(place) + (place > int(place)), len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("most, ranges", [(1 << 16, 1024), (10, 3), (1, 2)])
def test_quantiles_equal_sorting(spark, most, ranges):
    rng = random.Random(most)
    rows = [(g, v) for g, n in (("a", 300), (None, 90), ("b", 7), ("c", 40), ("d", 30)) for v in [None if rng.random() < 0.1 else 5.0 if g == "c" else rng.choice([-1e9, 0.0, 0.1, 7.25, 1e-300, 1e12]) if g == "d" else rng.uniform(-9, 9) for _ in range(n)]] + [("e", None)] * 20
    wanted = {"mid": (F.col("v"), 0.5), "low": (F.col("v"), 0.1), "top": (F.when(F.col("v") > 0, F.col("v")), 1.0)}
    got = {r.g: r for r in with_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], wanted, F.count("*").alias("n"), most=most, ranges=ranges).collect()}
    assert set(got) == {"a", None, "b", "c", "d", "e"}
    for g, r in got.items():
        own = [v for k, v in rows if k == g and v is not None]
        want = [interpolated(own, 0.5), interpolated(own, 0.1), interpolated([v for v in own if v > 0], 1.0)]
        assert r.n == sum(k == g for k, _ in rows) and all(a == b or abs(a - b) <= 1e-9 * abs(b) for a, b in zip((r.mid, r.low, r.top), want)), (g, r, want)
    assert with_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], wanted, most=most).count() == 0
    with pytest.raises(ValueError):
        with_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], {"x": (F.col("v"), 1.5)})


def test_positions_within_groups(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["x", "x", "x", "y", None]), rng.choice("pq"), float(rng.randrange(8)), k) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, h string, value_index double, provider_id int")
    got = {r.provider_id: r for r in ranking.ranked(df, ["g", "h"]).collect()}
    assert len(got) == 400
    for g in ("x", "y", None):
        for h in "pq":
            own = sorted((v, k) for a, b, v, k in rows if (a, b) == (g, h))
            for at, (v, k) in enumerate(own):
                size, extra = divmod(len(own), 5)
                tile = at // (size + 1) + 1 if at < extra * (size + 1) else extra + (at - extra * (size + 1)) // max(size, 1) + 1
                assert got[k].value_rank == 1 + sum(w > v for w, _ in own) and got[k].star_rating == tile
                assert abs(got[k].value_percentile - 100 * sum(w < v for w, _ in own) / max(len(own) - 1, 1)) <= 0.051
