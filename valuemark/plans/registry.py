"""Every query of the provider-value engine, named by what it covers, with its SQL twin."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.functions import scalars as X
from valuemark.operators import checks, clinical, linkage, outcomes, ranking
from valuemark.operators.selection import with_quantiles
from valuemark.plans import binding as B
from valuemark.plans.pipeline import S, Stages
from valuemark.session import fresh_path, table
from valuemark.sources import prices as P
from valuemark.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        REGISTRY[name] = (f, sql)
        return f

    return add


def staged(name: str, columns: str, sql: str, build: Callable[[Stages], DataFrame], counted: tuple[int, ...] | None = None) -> None:
    names = [c.strip() for c in columns.split(",")]
    REGISTRY[name] = (lambda spark, sf_dir: build(Stages(spark, sf_dir, counted)).select(*names), sql)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY["A2_provider_metrics"][0](spark, sf_dir)


def queries() -> dict[str, Query]:
    return {n: f for n, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n: sql for n, (_, sql) in REGISTRY.items() if sql}


def simple(name: str, columns: str, cte: str, build: Callable[[Stages], DataFrame], counted: tuple[int, ...] | None = None) -> None:
    staged(name, columns, B.sql(f"SELECT {columns} FROM {cte}", cte), build, counted)


METRICS = "patient_volume, first_year, last_year, avg_severity, observed_los, expected_los, oe_los, observed_adverse_pct, expected_adverse_pct, oe_adverse, oe_composite, clinical_oe"
SCORES = "provider_id, provider_name, patient_volume, clinical_oe, price_name, cost, cost_basis, price_file_basis, market_median, clinical_multiplier, financial_multiplier, experience_modifier, value_index, clinical_only_index, data_status"
VIEW = "provider_id, borough, years_observed, cost, market_median, pct_vs_market, value_index, value_rank, value_percentile, star_rating, data_status"

simple("P1_cohort", "provider_id, provider_name, zip3, procedure_code, severity, year, in_market, adverse", "cohort", lambda t: t.cohort)
simple("A1_benchmarks", "procedure_code, severity, year, stratum_n, expected_los, expected_adverse", "bench", lambda t: t.benchmarks)
simple("A2_provider_metrics", f"provider_id, hip_volume, knee_volume, {METRICS}", "metrics", lambda t: t.provider_metrics)
simple("A6_procedure_metrics", f"provider_id, procedure_code, procedure, {METRICS}", "proc_metrics", lambda t: t.procedure_metrics)
simple("A3_A4_attributes", "provider_id, provider_name, certificate, county, zip3", "attributes", lambda t: t.attributes)
simple("A7_provider_pricing", "facility_name, pricing_system, line_count, payer_count, negotiated_lines, median_cash, median_negotiated, min_negotiated, max_negotiated, procedure_cost, price_file_basis", "pricing", lambda t: t.provider_pricing)
simple("A8_provider_costs", "provider_id, list_charge, list_cost, cost_year", "provider_costs", lambda t: t.provider_costs)
simple("A9_market_benchmark", "cost_basis, providers, market_median, p25, p75, least, most", "market", lambda t: t.market, counted=B.OWN_CODES)
simple("J9_procedure_pricing", "provider_id, procedure, procedure_cost, cost_basis", "proc_pricing", lambda t: t.procedure_pricing, counted=B.CODES)
simple("A10_procedure_benchmark", "procedure, cost_basis, providers, market_median", "proc_bench", lambda t: t.procedure_benchmark, counted=B.CODES)
simple("V12_score_table", SCORES, "scores", lambda t: t.scores, counted=B.OWN_CODES)
simple("V13_procedure_scores", "provider_id, procedure_code, procedure, patient_volume, clinical_oe, procedure_cost, cost_basis, market_median, value_index", "proc_scores", lambda t: t.procedure_scores, counted=B.CODES)
simple("V14_consumer_view", VIEW, "view", lambda t: t.view, counted=B.OWN_CODES)
staged("V15_procedure_view", "provider_id, procedure, procedure_code, value_index, value_rank, star_rating, pct_vs_market", B.sql(
    f"SELECT provider_id, procedure, procedure_code, value_index, rank() OVER (PARTITION BY procedure ORDER BY value_index DESC) AS value_rank, CAST(ntile(5) OVER (PARTITION BY procedure ORDER BY value_index, provider_id) AS INT) AS star_rating, {B.R('(procedure_cost - market_median) * 100.0 / nullif(market_median, 0)', 1)} AS pct_vs_market FROM proc_scores WHERE value_index IS NOT NULL", "proc_scores"), lambda t: t.procedure_view, counted=B.CODES)
staged("V16_export_view", VIEW, B.sql(f"SELECT {VIEW} FROM view WHERE value_index IS NOT NULL", "view"), lambda t: ranking.export_view(t.view), counted=B.OWN_CODES)
staged("O3_top_15", "provider_id, value_index", B.sql("SELECT provider_id, value_index FROM scores WHERE value_index IS NOT NULL ORDER BY value_index DESC, provider_id LIMIT 15", "scores"), lambda t: checks.best(t.scores), counted=B.OWN_CODES)
simple("A12_outcomes", "provider_id, ccn, complication_rate, readmission_rate, overall_rating", "outcomes", lambda t: t.outcomes)
staged("J12_scores_with_outcomes", "provider_id, value_index, complication_rate, readmission_rate", B.sql("SELECT provider_id, value_index, complication_rate, readmission_rate FROM view LEFT JOIN outcomes USING (provider_id)", "view", "outcomes"), lambda t: ranking.consumer_view(t.scores, t.outcomes.drop("ccn")), counted=B.OWN_CODES)
staged("A21_proxy_validation", "n, correlation", B.sql(f"SELECT count(*) AS n, {B.R('corr(clinical_oe, complication_rate)', 4)} AS correlation FROM scores JOIN outcomes USING (provider_id) WHERE clinical_oe IS NOT NULL AND complication_rate IS NOT NULL", "scores", "outcomes"), lambda t: outcomes.proxy_validation(t.scores, t.outcomes), counted=B.OWN_CODES)
staged("P10_market_view", "provider_id, cost, patient_volume, star_rating", B.sql("SELECT provider_id, cost, patient_volume, star_rating FROM view WHERE borough IN ('NATION_3', 'NATION_5', 'NATION_8', 'NATION_15') AND cost <= 60000 AND patient_volume >= 20 AND star_rating >= 2", "view"), lambda t: ranking.market_view(t.view, ["NATION_3", "NATION_5", "NATION_8", "NATION_15"], 60000, 20, 2), counted=B.OWN_CODES)
staged("A18_headline", "providers, median_cost, spread, volume", B.sql(f"SELECT count(*) AS providers, {B.R(B.Q('cost', 0.5), 2)} AS median_cost, {B.R('CASE WHEN count(cost) > 1 THEN max(cost) - min(cost) END', 2)} AS spread, CAST(coalesce(sum(patient_volume), 0) AS BIGINT) AS volume FROM view", "view"), lambda t: ranking.headline(t.view), counted=B.OWN_CODES)
staged("A22_basis_lines", "cost_basis, market_median", B.sql("SELECT cost_basis, max(market_median) AS market_median FROM view GROUP BY cost_basis", "view"), lambda t: ranking.basis_lines(t.view), counted=B.OWN_CODES)
staged("A3_price_certification", "facility_name, ccn", B.sql("SELECT facility_name, ccn FROM (SELECT facility_name, ccn, row_number() OVER (PARTITION BY facility_name ORDER BY ccn IS NULL, n DESC, ccn) AS k FROM (SELECT facility_name, ccn, count(*) AS n FROM (SELECT *, min(system_rank) OVER (PARTITION BY facility_name) AS best FROM lines) WHERE system_rank = best GROUP BY facility_name, ccn)) WHERE k = 1", "lines"), lambda t: t.provider_pricing)
EIGHT = {"discharges": "discharges", "cohort": "cohort", "cohort_in_market": "cohort WHERE in_market", "provider_metrics": "metrics", "prices": "prices", "provider_pricing": "pricing", "links": "links", "scores": "scores"}
staged("Q1_stage_counts", "stage, rows", B.sql(" UNION ALL ".join(f"SELECT '{n}' AS stage, count(*) AS rows FROM {c}" for n, c in EIGHT.items()), "scores"), lambda t: checks.stage_counts(discharges=t.shared().discharges, cohort=t.cohort, cohort_in_market=t.cohort.filter("in_market"), provider_metrics=t.provider_metrics, prices=t.prices, provider_pricing=t.provider_pricing, links=t.links, scores=t.scores))
MAPPED = "CASE provider_id % 7 WHEN 0 THEN 'Kings' WHEN 1 THEN ' new york ' WHEN 2 THEN 'RICHMOND' WHEN 3 THEN 'Bronx' WHEN 4 THEN NULL WHEN 5 THEN 'manhattan' ELSE county END"
staged("P8_boroughs", "provider_id, borough", B.sql(f"SELECT provider_id, CASE lower(trim(c)) WHEN 'kings' THEN 'Brooklyn' WHEN 'new york' THEN 'Manhattan' WHEN 'manhattan' THEN 'Manhattan' WHEN 'richmond' THEN 'Staten Island' WHEN 'bronx' THEN 'Bronx' ELSE c END AS borough FROM (SELECT provider_id, {MAPPED} AS c FROM attributes)", "attributes"), lambda t: t.attributes.select("provider_id", X.borough(F.expr(MAPPED)).alias("borough")))
staged("P15_market_benchmarks", "procedure_code, severity, year, stratum_n, expected_los, expected_adverse", B.sql(B.CTES["bench"].replace("FROM cohort", "FROM cohort WHERE in_market"), "cohort"), lambda t: clinical.benchmarks(t.cells, dataclasses.replace(S, benchmark_scope="market")))
staged("P11_chosen_procedure", "provider_id, procedure, value_index", B.sql("SELECT provider_id, procedure, value_index FROM proc_scores WHERE value_index IS NOT NULL AND procedure = 'knee'", "proc_scores"), lambda t: ranking.chosen_view(t.view, t.procedure_view, "knee"), counted=B.CODES)
staged("Q2_cohort_by_year", "year, discharges, in_market, market_providers", B.sql("SELECT year, count(*) AS discharges, count(*) FILTER (in_market) AS in_market, count(DISTINCT CASE WHEN in_market THEN provider_id END) AS market_providers FROM cohort GROUP BY year", "cohort"), lambda t: checks.cohort_by_year(t.discharges, S))


def _reasons(t: Stages) -> DataFrame:
    from valuemark.operators.clinical import drop_reasons

    return drop_reasons(t.discharges, S)


staged("Q3_drop_reasons", "total_rows, other_procedure, bad_severity, bad_los, no_provider, not_elective, extreme_risk", B.sql(
    "SELECT count(*) AS total_rows, count(*) FILTER (procedure_code NOT IN (324, 326)) AS other_procedure, count(*) FILTER (severity NOT BETWEEN 1 AND 4) AS bad_severity, CAST(0 AS BIGINT) AS bad_los, count(*) FILTER (provider_id IS NULL) AS no_provider, count(*) FILTER (admission <> 'Elective') AS not_elective, count(*) FILTER (risk = 'Extreme') AS extreme_risk FROM discharges", "discharges"), _reasons)
#: Lengths of stay as they come: whole days, with blanks, open at the top, and what is none.
_LOS = "CASE l_orderkey % 6 WHEN 0 THEN ' 3 ' WHEN 1 THEN '120 +' WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE CAST(l_linenumber AS STRING) END"


@query("Q3_bad_los", f"SELECT count(*) AS total_rows, count(*) FILTER (los IS NULL OR los NOT IN (' 3 ', '120 +') AND NOT regexp_full_match(los, '[0-9]+')) AS bad_los FROM (SELECT {_LOS.replace('STRING', 'VARCHAR')} AS los FROM lineitem)")
def q3_bad_los(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop reasons of every line, a third of which have no length of stay."""
    t = table(spark, sf_dir, "lineitem").select(F.expr(_LOS).alias("los_raw"), F.lit(324).alias("procedure_code"), F.lit(1).alias("severity"), F.lit(1).alias("provider_id"), F.lit("Elective").alias("admission"), F.lit("Minor").alias("risk"))
    return clinical.drop_reasons(t, S).select("total_rows", "bad_los")


#: Tables and what their keys are called in ``checks.KEYS``; the SQL tables they equal.
WATCHED = {
    "benchmarks": ("benchmarks", "bench"), "provider_metrics": ("provider_metrics", "metrics"), "procedure_metrics": ("procedure_metrics", "proc_metrics"), "provider_pricing": ("provider_pricing", "pricing"), "provider_costs": ("provider_costs", "provider_costs"),
    "market_benchmark": ("market", "market"), "score_table": ("scores", "scores"), "procedure_pricing": ("procedure_pricing", "proc_pricing"), "procedure_benchmark": ("procedure_benchmark", "proc_bench"), "procedure_scores": ("procedure_scores", "proc_scores"),
    "provider_outcomes": ("outcomes", "outcomes"), "links": ("links", "links"), "measure_links": ("links", "links"),
}


def _planted(df: DataFrame) -> DataFrame:
    """Rows that repeat, and rows that lose their key, where a table has a provider."""
    if "provider_id" not in df.columns:
        return df
    twice = df.withColumn("_again", F.explode(F.array_repeat(F.lit(1), F.when(F.col("provider_id") % 10 == 0, 2).otherwise(1)))).drop("_again")
    return twice.withColumn("provider_id", F.when(F.col("provider_id") % 10 != 1, F.col("provider_id")))


def _planted_sql(name: str, keyed: bool) -> str:
    tens, ones = ("count(*) FILTER (provider_id % 10 = 0)", "count(*) FILTER (provider_id % 10 = 1)") if keyed else ("0", "0")
    return f"SELECT '{name}' AS name, count(*) + {tens} AS rows, CAST({ones} AS BIGINT) AS null_keys, CAST({tens} AS BIGINT) AS repeated FROM {WATCHED[name][1]}"


@query("Q13_keys_watched", B.sql(" UNION ALL ".join(_planted_sql(n, "provider_id" in checks.KEYS[n]) for n in WATCHED), *dict.fromkeys(v[1] for v in WATCHED.values())))
def q13_keys_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is observed of the keys of each derived table while it is written, with faults planted in those of providers."""
    t, found = Stages(spark, sf_dir, B.CODES).shared(), []
    for name, (stage, _) in WATCHED.items():
        marked, seen = checks.watched(_planted(getattr(t, stage)), list(checks.KEYS[name]))
        marked.write.parquet(fresh_path(spark, "watched"))
        found.append((name, seen.get["rows"], seen.get["null_keys"], seen.get["repeated"]))
    return spark.createDataFrame(found, "name string, rows long, null_keys long, repeated long")  # a row a table


staged("Q5_dispositions", "disposition, adverse, n", B.sql("SELECT disposition, CASE disposition WHEN 'Home or Self Care' THEN 0 WHEN 'Unknown' THEN NULL ELSE 1 END AS adverse, count(*) AS n FROM discharges GROUP BY ALL", "discharges"), lambda t: checks.dispositions(t.discharges))
staged("Q6_unmapped", "without_row, without_name", B.sql("SELECT (SELECT count(*) FROM metrics ANTI JOIN links USING (provider_id)) AS without_row, (SELECT count(*) FROM metrics m WHERE EXISTS (SELECT 1 FROM links l WHERE l.provider_id = m.provider_id AND l.facility_name IS NULL)) AS without_name", "metrics", "links"), lambda t: checks.unmapped(t.provider_metrics, t.links))
staged("Q7_awaiting_review", "provider_id, facility_name", B.sql("SELECT provider_id, facility_name FROM links WHERE NOT reviewed AND facility_name IS NOT NULL", "links"), lambda t: t.links.filter("NOT reviewed AND facility_name IS NOT NULL"))
staged("Q8_no_price", "provider_id, data_status", B.sql("SELECT provider_id, data_status FROM scores WHERE price_file_basis IS NULL", "scores"), lambda t: t.scores.filter("price_file_basis IS NULL"), counted=B.OWN_CODES)
FANNED = "SELECT provider_id FROM scores UNION ALL SELECT provider_id FROM scores WHERE provider_id % 10 = 0"
staged("Q9_fan_out", "provider_id, n", B.sql(f"SELECT provider_id, count(*) AS n FROM ({FANNED}) GROUP BY provider_id HAVING count(*) > 1", "scores"), lambda t: checks.duplicates(t.scores.select("provider_id", F.explode(F.array_repeat(F.lit(1), F.when(F.col("provider_id") % 10 == 0, 2).otherwise(1)))), ["provider_id"]), counted=B.OWN_CODES)
ODD_COST, ODD_OE = "CASE provider_id % 10 WHEN 0 THEN cost * 100 WHEN 1 THEN cost / 100 ELSE cost END", "CASE provider_id % 10 WHEN 2 THEN clinical_oe * 8 WHEN 3 THEN clinical_oe / 8 ELSE clinical_oe END"
staged("Q11_implausible", "provider_id, clinical_oe, cost", B.sql(f"SELECT * FROM (SELECT provider_id, {ODD_OE} AS clinical_oe, {ODD_COST} AS cost FROM scores) WHERE clinical_oe > 3 OR clinical_oe < 0.25 OR cost > 500000 OR cost < 5000", "scores"), lambda t: checks.implausible(t.scores.withColumns({"cost": F.expr(ODD_COST), "clinical_oe": F.expr(ODD_OE)})), counted=B.OWN_CODES)
staged("A19_match_coverage", "providers, matched, approved, awaiting_review, volume_share", B.sql(f"SELECT count(*) AS providers, count(facility_name) AS matched, count(*) FILTER (facility_name IS NOT NULL AND reviewed) AS approved, count(*) FILTER (facility_name IS NOT NULL AND NOT reviewed) AS awaiting_review, {B.R('CAST(sum(CASE WHEN facility_name IS NOT NULL THEN patient_volume END) AS DOUBLE) / nullif(CAST(sum(patient_volume) AS DOUBLE), 0)', 4)} AS volume_share FROM links LEFT JOIN metrics USING (provider_id)", "links", "metrics"), lambda t: linkage.match_summary(t.links, t.provider_metrics.withColumnRenamed("patient_volume", "volume")))
staged("A20_price_names", "facility_name, n", B.sql("SELECT facility_name, count(*) AS n FROM prices GROUP BY facility_name", "prices"), lambda t: t.prices.groupBy("facility_name").agg(F.count("*").alias("n")))


# ---- scalar rules over every part or event ---------------------------------------------------------------

CODE_TEXT = "CASE p_partkey % 9 WHEN 0 THEN 'MS-DRG 470' WHEN 1 THEN concat('APR', CAST(p_size AS STRING), '-1') WHEN 2 THEN CAST(p_partkey AS STRING) WHEN 3 THEN concat('0', CAST(p_size AS STRING)) WHEN 4 THEN 'DRG-470' WHEN 5 THEN concat('MSDRG', CAST(p_partkey AS STRING)) WHEN 6 THEN '' WHEN 7 THEN '000' ELSE concat('x', CAST(p_size AS STRING)) END"
TYPE_TEXT = "CASE p_partkey % 4 WHEN 0 THEN 'DRG' WHEN 1 THEN 'APR-DRG' WHEN 2 THEN 'CPT' ELSE NULL END"
_first = lambda p: f"nullif(regexp_extract(upper(trim(raw)), '{p}', 1), '')"


@query("F4_F5_codes", f"""
WITH t AS (SELECT p_partkey, {CODE_TEXT.replace('STRING', 'VARCHAR')} AS raw, {TYPE_TEXT} AS declared FROM part),
d AS (SELECT *, ltrim(coalesce({_first('^0*([0-9]{1,3})$')}, {_first('APR[ _-]?(?:DRG)?[ _-]?0*([0-9]{1,3})\\b')}, CASE WHEN regexp_matches(upper(raw), 'MS[ _-]?DRG[^0-9]{{0,4}}0*[0-9]{{1,3}}($|[^0-9])') THEN {_first('MS[ _-]?DRG[^0-9]{0,4}0*([0-9]{1,3})')} END, CASE WHEN regexp_matches(upper(raw), '(?:^|[^A-Z])DRG[^0-9]{{0,4}}0*[0-9]{{1,3}}($|[^0-9])') THEN {_first('(?:^|[^A-Z])DRG[^0-9]{0,4}0*([0-9]{1,3})')} END), '0') AS digits FROM t),
n AS (SELECT *, CASE WHEN digits <> '' THEN lpad(digits, 3, '0') END AS number,
  CASE WHEN raw LIKE 'APR%' THEN 'APR-DRG' WHEN raw LIKE 'MS%' THEN 'MS-DRG' WHEN declared = 'APR-DRG' THEN 'APR-DRG' WHEN declared = 'DRG' THEN 'MS-DRG' END AS system FROM d)
SELECT p_partkey, number, CASE WHEN number IS NOT NULL THEN system END AS system FROM n""")
def f4_f5_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_partkey", F.expr(CODE_TEXT).alias("raw"), F.expr(TYPE_TEXT).alias("declared"))
    c = X.classify_code(F.col("raw"), F.col("declared"))
    return t.select("p_partkey", X.normalize_drg(F.col("raw")).alias("number"), c["system"].alias("system"))


MONEY_TEXT = "CASE e % 7 WHEN 0 THEN concat('$', v) WHEN 1 THEN 'N/A' WHEN 2 THEN concat(' ', v, ' ') WHEN 3 THEN '-' WHEN 4 THEN concat('-', v) WHEN 5 THEN '1-2' ELSE '0' END"


@query("F7_F8_F9_numbers", f"""
SELECT event_id, CASE WHEN event_id % 7 IN (0, 2) AND CAST(v AS DOUBLE) > 0 THEN CAST(v AS DOUBLE) END AS money, CAST(trunc(CAST(v AS DOUBLE)) AS INT) AS whole,
  CASE event_id % 7 WHEN 0 THEN CAST(v AS DOUBLE) WHEN 1 THEN NULL WHEN 2 THEN CAST(v AS DOUBLE) WHEN 4 THEN -CAST(v AS DOUBLE) WHEN 6 THEN 0.0 END AS number
FROM (SELECT event_id, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS v FROM events)""")
def f7_f8_f9_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events").selectExpr("event_id", "event_id AS e", "CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS v")
    t = t.withColumn("raw", F.expr(MONEY_TEXT))
    return t.select("event_id", X.clean_currency(F.col("raw")).alias("money"), X.as_int(F.col("v")).alias("whole"), X.as_number(F.col("raw")).alias("number"))


NAMES = "CASE p_partkey % 4 WHEN 0 THEN concat('The ', p_name, ' Medical Center') WHEN 1 THEN upper(concat(p_name, '-', p_type)) WHEN 2 THEN concat(p_name, ' & ', p_brand) ELSE concat('SBH ', p_name, ' Health System, Inc.') END"


@query("F11_names", f"""
WITH t AS (SELECT p_partkey, {NAMES} AS raw FROM part),
u AS (SELECT p_partkey, regexp_replace(replace(replace(lower(raw), '&', ' and '), '-', ' '), '[^a-z0-9 ]+', ' ', 'g') AS x FROM t),
w AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(x, '\\b({'|'.join(X.NOISE_WORDS.split())})\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS y FROM u)
SELECT p_partkey, replace(y, 'sbh', 'st barnabas') AS norm, len(list_filter(list_distinct(string_split(replace(y, 'sbh', 'st barnabas'), ' ')), lambda z: length(z) >= 4 AND z NOT IN ('new', 'york', 'the', 'and', 'for', 'of'))) AS tokens FROM w""")
def f11_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = X.normalize_name(F.expr(NAMES))
    return table(spark, sf_dir, "part").select("p_partkey", norm.alias("norm"), F.size(X.significant_tokens(norm)).cast("long").alias("tokens"))


# ---- files of prices, manifests and measures, made of the tables -----------------------------------------

TARGETS = "(system = 'APR-DRG' AND code IN ('324', '326')) OR (system = 'MS-DRG' AND code = '470')"
WIDE = ["description", "code|1", "code|1|type", "setting", "standard_charge|discounted_cash", "standard_charge|1-URGENT|R|negotiated_dollar", "standard_charge|2-HIGH|R|negotiated_dollar", "standard_charge|2-HIGH|R|negotiated_percentage"]


@query("S11_S12_S18_price_files", B.sql(f"SELECT code, system, setting, payer, plan, negotiated, cash FROM prices WHERE {TARGETS}", "prices"))
def s11_s12_s18_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables written as published files, then probed, read and parsed file by file."""
    t = Stages(spark, sf_dir).prices
    cells = (F.lit("joint,\nother"), "code", "system", "setting", "payer", "plan", F.col("cash").cast("decimal(14,2)").cast("string"), F.col("negotiated").cast("decimal(14,2)").cast("string"))
    names = ["description", "code|1", "code|1|type", "setting", "payer_name", "plan_name", "standard_charge|discounted_cash", "standard_charge|negotiated_dollar"]
    path = fresh_path(spark, "price-files")
    t.select(*cells).toDF(*names).write.option("header", True).csv(path)
    files = spark.read.text(path).inputFiles()
    return P.load_prices(spark, {f.rsplit("/", 1)[-1]: f for f in files}, S)[0].select("code", "system", "setting", "payer", "plan", "negotiated", "cash")


def _loaded(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """What the files of a folder give when they are read as published price files."""
    files = spark.read.format("binaryFile").load(path).select("path").collect()  # a row a file
    return P.load_prices(spark, {r.path.rsplit("/", 1)[-1]: r.path for r in files}, S)[0].select(*columns)


@query("S12_gzip_price_files", B.sql(f"SELECT code, system, setting, payer, plan, negotiated, cash FROM prices WHERE {TARGETS}", "prices"))
def s12_gzip_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall files packed with gzip, with cells that hold line ends and quotes."""
    t = Stages(spark, sf_dir).prices
    cells = (F.lit('"joint",\nother'), "code", "system", "setting", "payer", "plan", F.col("cash").cast("decimal(14,2)").cast("string"), F.col("negotiated").cast("decimal(14,2)").cast("string"))
    names = ["description", "code|1", "code|1|type", "setting", "payer_name", "plan_name", "standard_charge|discounted_cash", "standard_charge|negotiated_dollar"]
    path = fresh_path(spark, "gzip-files")
    t.select(*cells).toDF(*names).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return _loaded(spark, path, "code", "system", "setting", "payer", "plan", "negotiated", "cash")


@query("S14_wide_prices", B.sql("""
SELECT code, setting, payer, negotiated, cash FROM (
  SELECT code, setting, unnest(CASE WHEN u IS NULL AND h IS NULL THEN [NULL] ELSE list_filter(['1-URGENT', '2-HIGH'], lambda x: CASE x WHEN '1-URGENT' THEN u ELSE h END IS NOT NULL) END) AS payer, u, h, cash, CASE WHEN u IS NULL AND h IS NULL THEN NULL ELSE 1 END AS any_
  FROM (SELECT facility_name, system, code, setting, max(negotiated) FILTER (payer = '1-URGENT') AS u, max(negotiated) FILTER (payer = '2-HIGH') AS h, max(cash) AS cash FROM prices WHERE (system = 'APR-DRG' AND code IN ('324', '326')) OR (system = 'MS-DRG' AND code = '470') GROUP BY ALL)
) x, LATERAL (SELECT CASE x.payer WHEN '1-URGENT' THEN x.u WHEN '2-HIGH' THEN x.h END AS negotiated)""", "prices"))
def s14_wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Stages(spark, sf_dir).prices
    at = lambda payer: F.max(F.when(F.col("payer") == payer, F.col("negotiated"))).cast("string")
    raw = t.groupBy("facility_name", "system", "code", "setting").agg(F.max("cash").cast("string").alias("cash"), at("1-URGENT").alias("u"), at("2-HIGH").alias("h"))
    raw = raw.select(F.lit("joint"), "code", "system", "setting", "cash", "u", "h", F.lit("65"))
    return P.parse_csv(raw, WIDE, None, None, "wide", S).select("code", "setting", "payer", "negotiated", "cash")


_WIDE_SQL = """
SELECT code, setting, payer, negotiated, cash FROM (
  SELECT code, setting, unnest(CASE WHEN u IS NULL AND h IS NULL THEN [NULL] ELSE list_filter(['1-URGENT', '2-HIGH'], lambda x: CASE x WHEN '1-URGENT' THEN u ELSE h END IS NOT NULL) END) AS payer, u, h, cash
  FROM (SELECT facility_name, system, code, setting, max(negotiated) FILTER (payer = '1-URGENT') AS u, max(negotiated) FILTER (payer = '2-HIGH') AS h, max(cash) AS cash FROM prices WHERE (system = 'APR-DRG' AND code IN ('324', '326')) OR (system = 'MS-DRG' AND code = '470') GROUP BY ALL)
) x, LATERAL (SELECT CASE x.payer WHEN '1-URGENT' THEN x.u WHEN '2-HIGH' THEN x.h END AS negotiated)"""


@query("S14_wide_price_files", B.sql(_WIDE_SQL, "prices"))
def s14_wide_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide files, a column a payer, with quoted line ends, written and read block by block."""
    t = Stages(spark, sf_dir).prices
    at = lambda payer: F.max(F.when(F.col("payer") == payer, F.col("negotiated"))).cast("decimal(14,2)").cast("string")
    raw = t.groupBy("facility_name", "system", "code", "setting").agg(F.max("cash").cast("decimal(14,2)").cast("string").alias("cash"), at("1-URGENT").alias("u"), at("2-HIGH").alias("h"))
    path = fresh_path(spark, "wide-files")
    raw.select(F.lit('a "joint",\r\nboth'), "code", "system", "setting", "cash", "u", "h", F.lit("65")).toDF(*WIDE).write.option("header", True).option("escape", '"').csv(path)
    return _loaded(spark, path, "code", "setting", "payer", "negotiated", "cash")


TALL = ["description", "code|1", "code|1|type", "code|2", "code|2|type", "setting", "payer_name", "plan_name", "standard_charge|discounted_cash", "standard_charge|negotiated_dollar"]


@query("S13_tall_prices", B.sql("SELECT code, system, setting, payer, plan, negotiated, cash FROM prices WHERE (system = 'APR-DRG' AND code IN ('324', '326')) OR (system = 'MS-DRG' AND code = '470')", "prices"))
def s13_tall_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Stages(spark, sf_dir).prices
    raw = t.select(F.lit("other"), F.lit("27447"), F.lit("CPT"), "code", "system", "setting", "payer", "plan", F.concat(F.lit("$"), F.col("cash").cast("decimal(14,2)").cast("string")), F.col("negotiated").cast("decimal(14,2)").cast("string"))
    return P.parse_csv(raw, TALL, "all", "330001", "tall", S).select("code", "system", "setting", "payer", "plan", "negotiated", "cash")


_JSON_SQL = B.sql(f"SELECT code, system, payer, negotiated FROM prices WHERE {TARGETS} UNION ALL SELECT code, system, NULL, NULL FROM (SELECT DISTINCT facility_name, system, code FROM prices WHERE {TARGETS})", "prices")


def _json_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge items as JSON, of every price line, and one without payers for each code of a facility."""
    t = Stages(spark, sf_dir).prices
    payers = F.collect_list(F.struct(F.col("payer").alias("payer_name"), F.col("plan").alias("plan_name"), F.col("negotiated").cast("string").alias("standard_charge_dollar")))
    g = t.withColumn("part", F.pmod(F.xxhash64("negotiated", "cash"), F.lit(64))).groupBy("facility_name", "system", "code", "part").agg(payers.alias("payers_information"))
    nobody = t.select("facility_name", "system", "code").distinct().withColumns({"part": F.lit(-1).cast("long"), "payers_information": F.array().cast(g.schema["payers_information"].dataType)})
    g = g.withColumn("part", F.col("part").cast("long")).unionByName(nobody)
    item = F.struct(F.lit("joint }] \"both\"").alias("description"), F.array(F.struct(F.lit("27447").alias("code"), F.lit("CPT").alias("type")), F.struct(F.col("code"), F.col("system").alias("type"))).alias("code_information"), F.array(F.struct(F.lit("inpatient").alias("setting"), F.col("payers_information"))).alias("standard_charges"))
    return g.select(F.to_json(item).alias("j"))


@query("S15_json_prices", _JSON_SQL)
def s15_json_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_json_items(P.json_items(_json_charges(spark, sf_dir), "j"), "json", S).select("code", "system", "payer", "negotiated")


def _document(batches):
    """Items of a partition as the lines of one published document."""
    lead = '{"hospital_name": "Place", "modifiers": [{"description": "none"}], "standard_charge_information": ['
    for b in batches:
        items = b.column("j")
        if len(items):
            rest = pc.binary_join_element_wise(pa.scalar(",", items.type), items[1:], pa.scalar("", items.type))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array([f"{lead}{items[0]}"], items.type), rest])], ["value"])
            lead = ","
    yield pa.RecordBatch.from_arrays([pa.array([lead + "]}" if lead != "," else "]}"], pa.string())], ["value"])


@query("S15_json_price_files", _JSON_SQL)
def s15_json_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a list of items each, written and read block by block."""
    path = fresh_path(spark, "json-files")
    _json_charges(spark, sf_dir).mapInArrow(_document, "value string").write.text(path)
    return _loaded(spark, path, "code", "system", "payer", "negotiated")


@query("S19_manifests", "SELECT concat('Place ', CAST(page_id AS VARCHAR)) AS location_name, url AS mrf_url FROM pages UNION ALL SELECT concat('Side ', CAST(page_id AS VARCHAR)), concat(regexp_extract(url, '^(https?://[^/]+)', 1), '/a.json') FROM pages")
def s19_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = "concat('# list\\nlocation-name: Place ', page_id, '\\nMRF-URL: ', url, '\\nlocation-name: Side ', page_id, '\\nmrf-url: /a.json\\ncontact-name: x\\nlocation-name: none')"
    return P.manifest_locations(table(spark, sf_dir, "pages").selectExpr("url AS base", f"{body} AS body")).select("location_name", "mrf_url")


@query("S9_measures", "SELECT CAST(user_id AS VARCHAR) AS ccn, 'COMP_HIP_KNEE' AS measure_id, CASE WHEN event_id % 3 > 0 THEN CAST(round(value) AS DOUBLE) END AS score FROM events WHERE event_type = 'purchase'")
def s9_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").selectExpr("concat(' ', user_id, ' ') AS facility_id", "CASE event_type WHEN 'purchase' THEN ' COMP_HIP_KNEE ' ELSE event_type END AS measure_id", "CASE WHEN event_id % 3 > 0 THEN CAST(round(value) AS STRING) ELSE 'Not Available' END AS score")
    return T.load_measures(raw).select("ccn", "measure_id", F.col("score").cast("double").alias("score"))


@query("S1_reconcile", "SELECT CAST(l_suppkey AS INT) AS provider_id, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS los_raw, CAST(year(l_shipdate) AS INT) AS year FROM lineitem")
def s1_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    even = t.filter("l_orderkey % 2 = 0").selectExpr("CAST(CAST(l_suppkey AS DOUBLE) AS STRING) AS facility_id", "concat(' ', CAST(CAST(l_quantity AS INT) AS STRING)) AS length_of_stay", "CAST(year(l_shipdate) AS STRING) AS discharge_year")
    odd = t.filter("l_orderkey % 2 = 1").selectExpr("CAST(l_suppkey AS STRING) AS permanent_facility_id", "CAST(CAST(l_quantity AS INT) AS STRING) AS length_of_stay", "CAST(year(l_shipdate) AS STRING) AS discharge_year")
    return T.reconcile(even, T.DISCHARGE_FIELDS).unionByName(T.reconcile(odd, T.DISCHARGE_FIELDS)).select("provider_id", "los_raw", "year")


# ---- linking --------------------------------------------------------------------------------------------


def _name_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s = table(spark, sf_dir, "supplier")
    left = s.selectExpr("CAST(s_suppkey AS INT) AS provider_id", "CAST(NULL AS STRING) AS certificate", "concat('Saint ', upper(replace(s_name, '#', ' ')), CASE WHEN s_suppkey % 2 = 0 THEN ' Hospital' ELSE ' Campus' END) AS provider_name", "CAST(s_acctbal AS BIGINT) AS volume")
    right = s.selectExpr("s_suppkey", "concat('The saint ', replace(s_name, '#', CASE WHEN s_suppkey % 5 = 0 THEN ' no ' ELSE ' ' END)) AS facility_name")
    return left, right


@query("M1_exact_links", "SELECT CAST(s_suppkey AS INT) AS provider_id, concat('The saint ', replace(s_name, '#', ' ')) AS facility_name FROM supplier WHERE s_suppkey % 3 > 0 AND s_suppkey % 5 > 0")
def m1_exact_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _name_sets(spark, sf_dir)
    right = linkage.named(right.withColumn("facility_name", F.when(F.col("s_suppkey") % 3 > 0, F.col("facility_name")).otherwise(F.concat(F.lit("closed "), "facility_name"))))
    pairs = left.withColumn("norm", X.normalize_name(F.col("provider_name"))).join(right, "norm")
    return pairs.select("provider_id", "facility_name")


def _norm_sql(raw: str) -> str:
    """A name as it is compared, in SQL."""
    plain = f"regexp_replace(replace(replace(lower({raw}), '&', ' and '), '-', ' '), '[^a-z0-9 ]+', ' ', 'g')"
    return f"replace(trim(regexp_replace(regexp_replace({plain}, '\\b({'|'.join(X.NOISE_WORDS.split())})\\b', ' ', 'g'), '\\s+', ' ', 'g')), 'sbh', 'st barnabas')"


#: Every pair of a provider's and a facility's name that share a significant token, with its similarity; the longest
#: common subsequence of the rests goes character by character over the bits of a number.
_PAIRS_SQL = f"""
WITH RECURSIVE providers AS (
  SELECT CAST(s_suppkey AS INT) AS provider_id, concat('Saint ', upper(replace(s_name, '#', ' ')), CASE WHEN s_suppkey % 2 = 0 THEN ' Hospital' ELSE ' Campus' END) AS provider_name, CAST(trunc(s_acctbal) AS BIGINT) AS volume FROM supplier
), facilities AS (SELECT s_suppkey, concat('The saint ', replace(s_name, '#', CASE WHEN s_suppkey % 5 = 0 THEN ' no ' ELSE ' ' END)) AS facility_name FROM supplier),
l AS (SELECT norm, list_distinct(string_split(norm, ' ')) AS words FROM (SELECT DISTINCT {_norm_sql('provider_name')} AS norm FROM providers) WHERE norm <> ''),
r AS (SELECT norm, list_distinct(string_split(norm, ' ')) AS words, facility_name, ccn FROM (SELECT {_norm_sql('facility_name')} AS norm, min(facility_name) AS facility_name, min(CAST(s_suppkey AS VARCHAR)) AS ccn FROM facilities GROUP BY 1) WHERE norm <> ''),
crossed AS (
  SELECT l.norm AS a, r.norm AS b, facility_name, ccn, list_intersect(l.words, r.words) AS mutual,
    array_to_string(list_sort(list_filter(l.words, lambda w: NOT list_contains(r.words, w))), ' ') AS rest_a, array_to_string(list_sort(list_filter(r.words, lambda w: NOT list_contains(l.words, w))), ' ') AS rest_b
  FROM l, r WHERE len(list_filter(list_intersect(l.words, r.words), lambda w: length(w) >= 4 AND w NOT IN ('new', 'york', 'the', 'and', 'for', 'of'))) > 0
), rests AS (SELECT DISTINCT rest_a, rest_b FROM crossed WHERE rest_a <> '' AND rest_b <> ''),
steps AS (
  SELECT rest_a, rest_b, 0 AS k, (1::BIGINT << length(rest_a)) - 1 AS bits FROM rests
  UNION ALL
  SELECT rest_a, rest_b, k + 1, ((bits + hit) | (bits - hit)) & ((1::BIGINT << length(rest_a)) - 1)
  FROM (SELECT *, bits & list_sum(list_transform(range(length(rest_a)), lambda j: CASE WHEN rest_a[j + 1] = rest_b[k + 1] THEN 1::BIGINT << j ELSE 0 END))::BIGINT AS hit FROM steps WHERE k < length(rest_b))
), common AS (SELECT rest_a, rest_b, length(rest_a) - bit_count(bits) AS n FROM steps WHERE k = length(rest_b)),
pairs AS (
  SELECT a, b, facility_name, ccn, CASE WHEN rest_a = '' OR rest_b = '' THEN 100.0::DOUBLE ELSE round(greatest(200.0::DOUBLE * (base + 1 + n) / (2 * base + 2 + length(rest_a) + length(rest_b)), 200.0::DOUBLE * base / (2 * base + 1 + least(length(rest_a), length(rest_b)))), 2) END AS score
  FROM (SELECT *, list_sum(list_transform(mutual, lambda w: length(w)))::BIGINT + len(mutual) - 1 AS base FROM crossed) LEFT JOIN common USING (rest_a, rest_b)
)"""
#: Providers choose one after the other, busier ones first.
_CHOSEN_SQL = """, wishes AS (SELECT a, list({taken} ORDER BY a = b DESC, score DESC, {taken}) AS names FROM pairs WHERE score >= {cutoff} GROUP BY a),
ranks AS (SELECT provider_id, names, row_number() OVER (ORDER BY -volume, provider_id) AS k FROM (SELECT *, {norm} AS norm FROM providers) LEFT JOIN wishes ON a = norm WHERE norm <> ''),
turns AS (
  SELECT 0::BIGINT AS k, NULL::INT AS provider_id, NULL::VARCHAR AS name, []::VARCHAR[] AS taken
  UNION ALL
  SELECT k, provider_id, name, CASE WHEN name IS NULL THEN taken ELSE list_append(taken, name) END
  FROM (SELECT ranks.k, ranks.provider_id, list_filter(names, lambda x: NOT list_contains(taken, x))[1] AS name, taken FROM turns JOIN ranks ON ranks.k = turns.k + 1)
), chosen AS (SELECT provider_id, provider_name, name, {norm} AS norm FROM turns JOIN providers USING (provider_id))"""


@query("M2_propose_links", _PAIRS_SQL + _CHOSEN_SQL.format(taken="facility_name", cutoff=S.match_cutoff, norm=_norm_sql("provider_name")) + f"""
SELECT p.provider_id, CAST(NULL AS VARCHAR) AS certificate, p.provider_name, name AS facility_name, CASE WHEN a = b THEN 'exact' WHEN a IS NOT NULL THEN 'fuzzy' ELSE 'unmatched' END AS match_method,
  CAST(score AS DECIMAL(5,2)) AS match_score, coalesce(a = b OR score >= {S.auto_accept}, false) AS reviewed, CASE WHEN coalesce(a = b OR score >= {S.auto_accept}, false) THEN 'auto' END AS review_source
FROM providers p LEFT JOIN chosen USING (provider_id) LEFT JOIN pairs ON a = norm AND pairs.facility_name = name""")
def m2_propose_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _name_sets(spark, sf_dir)
    none = left.limit(0).selectExpr("provider_id", "certificate", "provider_name", "CAST(NULL AS STRING) AS facility_name", "CAST(NULL AS STRING) AS match_method", "CAST(NULL AS DECIMAL(5,2)) AS match_score", "false AS reviewed", "CAST(NULL AS STRING) AS review_source")
    return linkage.propose(left, right, none, S)


@query("M9_measure_links", _PAIRS_SQL + _CHOSEN_SQL.format(taken="ccn", cutoff=S.measure_match_cutoff, norm=_norm_sql("provider_name")) + """
SELECT c.provider_id, name AS ccn, c.provider_name, pairs.facility_name, CASE WHEN score = 100 THEN 'exact' ELSE 'fuzzy' END AS match_method, CAST(score AS DECIMAL(5,2)) AS match_score, false AS reviewed
FROM chosen c JOIN pairs ON a = norm AND ccn = name""")
def m9_measure_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _name_sets(spark, sf_dir)
    return linkage.propose_measure_links(left.drop("certificate"), right.selectExpr("CAST(s_suppkey AS STRING) AS ccn", "facility_name"), S)


@query("W6_review_candidates", _PAIRS_SQL + f"""
SELECT provider_id, place, facility_name, score, CAST(regexp_extract(facility_name, '([0-9]+)$', 1) AS INT) % 3 = 0 AS claimed FROM (
  SELECT provider_id, facility_name, score, CAST(row_number() OVER (PARTITION BY provider_id ORDER BY score DESC, facility_name) AS INT) AS place FROM (SELECT *, {_norm_sql("provider_name")} AS norm FROM providers) JOIN pairs ON a = norm
) WHERE place <= 8""")
def w6_review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _name_sets(spark, sf_dir)
    return linkage.review_candidates(left, right, right.filter("s_suppkey % 3 = 0"))


staged("M5_protected_merge", "provider_id, facility_name, reviewed", B.sql("SELECT provider_id, CASE WHEN reviewed THEN facility_name ELSE 'new name' END AS facility_name, reviewed FROM links", "links"), lambda t: linkage.protected_merge(t.links, t.links.withColumn("facility_name", F.lit("new name"))))


# ---- ranking at scale, on every order -------------------------------------------------------------------


@query("W1_W3_global_ranks", f"SELECT o_orderkey, rank() OVER (ORDER BY v DESC) AS value_rank, {B.R('100 * percent_rank() OVER (ORDER BY v)', 1)} AS value_percentile, CAST(ntile(5) OVER (ORDER BY v, o_orderkey) AS INT) AS star_rating FROM (SELECT o_orderkey, floor(o_totalprice / 10) AS v FROM orders)")
def w1_w3_global_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 10).alias("v"))
    return ranking.global_ranks(t, "v", "o_orderkey").select("o_orderkey", "value_rank", "value_percentile", "star_rating")


#: One supplier with a third of all lines.
_LINE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING))"
_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END"


@query("W4_W5_hot_group_ranks", f"""
SELECT l_orderkey, l_linenumber, g, rank() OVER (PARTITION BY g ORDER BY v DESC) AS value_rank, {B.R('100 * percent_rank() OVER (PARTITION BY g ORDER BY v)', 1).replace('(38,12)', '(38,18)')} AS value_percentile, CAST(ntile(5) OVER (PARTITION BY g ORDER BY v, id) AS INT) AS star_rating
FROM (SELECT l_orderkey, l_linenumber, {_HOT} AS g, floor(l_extendedprice / 100) AS v, {_LINE.replace("STRING", "VARCHAR")} AS id FROM lineitem)""")
def w4_w5_hot_group_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line ranked within its supplier."""
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT).alias("g"), F.floor(F.col("l_extendedprice") / 100).alias("v"), F.expr(_LINE).alias("id"))
    return ranking.global_ranks(t, "v", "id", groups=["g"]).select("l_orderkey", "l_linenumber", "g", "value_rank", "value_percentile", "star_rating")


@query("A7_hot_group_medians", f"""
SELECT g, count(*) AS lines, {B.R(B.Q('price', 0.5), 4)} AS median_price, {B.R(B.Q('qty', 0.25), 4)} AS low_quantity, {B.R(B.Q('price', 0.9), 4)} AS high_price
FROM (SELECT {_HOT} AS g, CAST(l_extendedprice AS DOUBLE) AS price, CAST(CASE WHEN l_linenumber > 1 THEN l_quantity END AS DOUBLE) AS qty FROM lineitem) GROUP BY g""")
def a7_hot_group_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles where one group has a third of all rows; the group is counted in ranges, not collected."""
    t = table(spark, sf_dir, "lineitem").select(F.expr(_HOT).alias("g"), F.col("l_extendedprice").cast("double").alias("price"), F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).cast("double").alias("qty"))
    wanted = {"median_price": (F.col("price"), 0.5), "low_quantity": (F.col("qty"), 0.25), "high_price": (F.col("price"), 0.9)}
    return with_quantiles(t, ["g"], wanted, F.count("*").alias("lines"), most=4096).withColumns({c: F.round(c, 4) for c in wanted})
