"""Lines and years that count are all that the score table's queries write and move; results are those of all lines."""

import pytest

from valuemark.operators import pricing
from valuemark.plans import binding as B
from valuemark.plans import pipeline, registry

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_lines_that_count_are_written(spark, monkeypatch):
    written, was = {}, pipeline.materialize
    monkeypatch.setattr(pipeline, "materialize", lambda df, label, *a, **b: written.setdefault(label, was(df, label, *a, **b)))
    got = rows(registry.REGISTRY["V12_score_table"][0](spark, SF))
    assert written["lines-joined"].count() < 0.6 * spark.read.parquet(f"{SF}/lineitem.parquet").count()
    whole = pipeline.Stages(spark, SF)
    assert got == rows(whole.scores.select(*registry.SCORES.split(", "))) and len(got) > 0


def test_tables_of_all_procedures_are_whole(spark):
    whole, counted = pipeline.Stages(spark, SF).shared(), pipeline.Stages(spark, SF, B.CODES).shared()
    for name in ("cohort", "provider_pricing", "provider_costs", "procedure_pricing"):
        assert rows(getattr(whole, name)) == rows(getattr(counted, name)), name
    assert counted.costs.count() < whole.costs.count() / 2
    with pytest.raises(ValueError):
        pipeline.Stages(spark, SF, B.OWN_CODES).procedure_pricing


def test_years_that_may_be_the_latest_stay(spark):
    """1: all paid. 2: the last year unpaid in part, so its median is none. 3: one procedure ends early. 4: no year. 5: charges of zero and none."""
    charged = [(1, 324, 2020, 5.0), (1, 326, 2021, 7.0), (1, 324, 2021, 9.0), (2, 324, 2019, 4.0), (2, 324, 2021, 3.0), (2, 324, 2021, -3.0), (2, 324, 2021, None), (2, 324, 2021, -4.0)]
    charged += [(3, 324, 2018, 6.0), (3, 326, 2021, 8.0), (3, 301, 2016, 2.0), (3, 302, 2015, 2.0), (3, 302, 2014, 2.0), (4, 324, None, 1.0), (5, 324, 2020, 2.0), (5, 326, 2021, 0.0), (5, 326, 2021, None)]
    df = spark.createDataFrame(charged, "provider_id int, procedure_code int, year int, charge double").selectExpr("*", "1 AS severity")
    middles = lambda d: d.groupBy("provider_id", "procedure_code", "severity", "year").agg({"charge": "median", "*": "count"}).toDF("provider_id", "procedure_code", "severity", "year", "median_charge", "discharges").selectExpr("*", "floor(median_charge / 2) AS median_cost")
    kept = B.recent(df, B.CODES)
    assert kept.count() < df.count()
    whole, few = middles(df), middles(kept)
    assert rows(pricing.provider_costs(whole, B.SETTINGS)) == rows(pricing.provider_costs(few, B.SETTINGS))
    links, none = spark.createDataFrame([], "provider_id int, facility_name string"), pipeline.Stages(spark, SF).prices.limit(0)
    assert rows(pricing.procedure_pricing(none, whole, links, B.SETTINGS)) == rows(pricing.procedure_pricing(none, few, links, B.SETTINGS))
    assert 1 == len(rows(pricing.provider_costs(few, B.SETTINGS).filter("provider_id = 2 AND cost_year = 2019")))


def test_lines_and_orders_move_as_numbers(spark):
    plan = B.counted_lines(spark, SF, B.OWN_CODES)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    assert plan.left().output().size() <= 5 and plan.right().output().size() <= 3  # the first join is that with orders


def test_price_lines_are_not_written_twice(spark, monkeypatch):
    written, was = [], pricing.materialize
    monkeypatch.setattr(pricing, "materialize", lambda df, label, *a, **b: written.append(label) or was(df, label, *a, **b))
    assert rows(pipeline.Stages(spark, SF, B.OWN_CODES).shared().provider_pricing) and "lines" not in written
    assert rows(pipeline.Stages(spark, SF).provider_pricing) and "lines" in written


def test_values_without_a_number_stay_as_they_are(spark, tmp_path):
    """Prices, quantities, flags, keys, sizes, dates and priorities that are none, negative, broken or beyond what is numbered."""
    odd = {
        "lineitem": {
            "l_extendedprice": "CASE l_orderkey % 23 WHEN 1 THEN NULL WHEN 2 THEN 5e9 WHEN 3 THEN -7.5 WHEN 4 THEN double('NaN') WHEN 5 THEN 0.2D ELSE l_extendedprice END",
            "l_quantity": "CASE l_orderkey % 19 WHEN 1 THEN NULL WHEN 2 THEN 5.5D WHEN 3 THEN -3D WHEN 4 THEN 44.5D WHEN 5 THEN 900D WHEN 6 THEN 0D ELSE l_quantity END",
            "l_linenumber": "CASE l_orderkey % 17 WHEN 1 THEN NULL WHEN 2 THEN -1 WHEN 3 THEN 0 ELSE l_linenumber END",
            "l_returnflag": "CASE l_orderkey % 13 WHEN 1 THEN NULL WHEN 2 THEN 'odd' ELSE l_returnflag END",
            "l_linestatus": "CASE l_orderkey % 11 WHEN 1 THEN NULL WHEN 2 THEN 'x' ELSE l_linestatus END",
            "l_partkey": "CASE WHEN l_partkey % 7 = 0 THEN -l_partkey ELSE l_partkey END",
        },
        "part": {
            "p_type": "CASE p_partkey % 13 WHEN 1 THEN NULL WHEN 2 THEN 'odd' ELSE p_type END",
            "p_size": "CASE p_partkey % 11 WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN 300 WHEN 4 THEN -20 WHEN 5 THEN 104 ELSE p_size END",
            "p_retailprice": "CASE p_partkey % 17 WHEN 1 THEN NULL WHEN 2 THEN 1e7 WHEN 3 THEN -2D WHEN 4 THEN 0D WHEN 5 THEN 0.01D WHEN 6 THEN 3276.7D ELSE p_retailprice END",
            "p_partkey": "CASE WHEN p_partkey % 7 = 0 THEN -p_partkey ELSE p_partkey END",
        },
        "orders": {
            "o_orderdate": "CASE o_orderkey % 29 WHEN 1 THEN NULL WHEN 2 THEN timestamp'0001-01-01' WHEN 3 THEN timestamp'9999-12-31' ELSE o_orderdate END",
            "o_orderstatus": "CASE o_orderkey % 7 WHEN 1 THEN NULL ELSE o_orderstatus END",
            "o_orderpriority": "CASE o_orderkey % 5 WHEN 1 THEN NULL WHEN 2 THEN 'odd' ELSE o_orderpriority END",
        },
    }
    for name in ("lineitem", "part", "orders", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        df.selectExpr(*[f"CAST({odd.get(name, {}).get(c, c)} AS {t}) AS {c}" for c, t in df.dtypes]).write.parquet(f"{tmp_path}/{name}.parquet")
    whole, counted = pipeline.Stages(spark, str(tmp_path)).shared(), pipeline.Stages(spark, str(tmp_path), B.CODES).shared()
    for name in ("cohort", "attributes", "provider_pricing", "provider_costs", "procedure_pricing"):
        got = repr(rows(getattr(counted, name)))  # a text, as NaN is not NaN
        assert len(got) > 2 and repr(rows(getattr(whole, name))) == got, name
    priced = lambda t: repr(rows(pricing.priced_lines(t.prices, B.SETTINGS)))
    assert priced(whole) == priced(counted)
