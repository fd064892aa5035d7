"""Provider-value tables out of the generic test tables, in Spark and as SQL for the checks."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.session import materialize, table

SETTINGS = Settings(counties=("NATION_0", "NATION_3", "NATION_5", "NATION_8", "NATION_12", "NATION_15", "NATION_16", "NATION_20"), service_area="ASIA", weight_clinical=2.0)

PROCEDURE = "CASE p_type WHEN 'STANDARD' THEN 324 WHEN 'ECONOMY' THEN 326 WHEN 'MEDIUM' THEN 301 WHEN 'PROMO' THEN 302 ELSE 999 END"
NAME = "CASE WHEN s_suppkey % 3 = 0 THEN concat('The ', s_name, ' Hospital') ELSE s_name END"

DISCHARGE = f"""
  CAST(l_suppkey AS INT) AS provider_id, CASE WHEN year(o_orderdate) % 2 = 0 THEN upper(s_name) ELSE s_name END AS provider_name,
  concat('C', CAST(l_partkey % 5 AS STRING)) AS certificate, n_name AS county, r_name AS area,
  CASE WHEN l_partkey % 11 = 0 THEN 'OOS' ELSE lpad(CAST(l_partkey % 120 AS STRING), 3, '0') END AS zip3,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Emergency' ELSE 'Elective' END AS admission, {PROCEDURE} AS procedure_code,
  CAST(floor((p_size - 1) / 13.0) AS INT) + 1 AS severity, CASE WHEN o_orderstatus = 'P' THEN 'Extreme' ELSE 'Minor' END AS risk,
  CASE WHEN l_quantity >= 45 THEN '45+' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS los_raw,
  CASE l_returnflag WHEN 'N' THEN 'Home or Self Care' WHEN 'R' THEN 'Expired' ELSE 'Unknown' END AS disposition, CAST(year(o_orderdate) AS INT) AS year"""

CODE = f"CASE WHEN s_suppkey % 4 = 3 THEN '027' WHEN s_suppkey % 3 = 0 AND l_partkey % 2 = 0 THEN '470' ELSE CAST({PROCEDURE} AS STRING) END"
SETTING = "CASE WHEN l_linestatus = 'O' THEN 'Inpatient' WHEN l_linenumber = 1 THEN NULL ELSE 'Outpatient' END"
PRICE = f"""
  {NAME} AS facility_name, CASE WHEN s_suppkey % 3 = 0 AND l_partkey % 2 = 0 THEN 'MS-DRG' ELSE 'APR-DRG' END AS system,
  {CODE} AS code,
  {SETTING} AS setting,
  o_orderpriority AS payer, l_returnflag AS plan, CASE WHEN l_quantity > 5 THEN round(l_extendedprice) END AS negotiated, round(p_retailprice * 20) AS cash,
  CASE WHEN l_linenumber > 2 THEN concat('33', CAST(s_suppkey % 7 AS STRING), l_returnflag) END AS ccn"""

#: Of lines, orders and parts, what discharges, prices and costs are made of.
LINE_COLUMNS = ("l_suppkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "o_orderdate", "o_orderstatus", "o_orderpriority", "p_type", "p_size", "p_retailprice")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order and part."""
    t = lambda n: table(spark, sf_dir, n)
    return t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey")).select(*LINE_COLUMNS)


#: Procedures of the score table and of all tables.
OWN_CODES, CODES = tuple(SETTINGS.procedure_codes), tuple(code for code, _ in SETTINGS.procedure_of_code)
#: Codes of prices that may be targets, whatever their system.
PRICE_CODES = (SETTINGS.ms_code, *SETTINGS.apr_codes, *SETTINGS.apr_legacy_codes)


#: How a column's values are numbered where lines move: the number (null where a value has none), how many there are, and a value of
#: that number, ``k``. Values share a number where nothing that is made of lines tells them apart.
Codes = dict[str, tuple[str, int, str]]
LINE_CODES: Codes = {
    "l_extendedprice": ("CASE WHEN l_extendedprice BETWEEN 0D AND 1048575D THEN CAST(l_extendedprice AS BIGINT) END", 1 << 20, "k"),  # rounded before
    "l_quantity": ("CASE WHEN l_quantity >= 45D THEN 45 WHEN l_quantity >= 0D AND l_quantity = floor(l_quantity) THEN CAST(l_quantity AS INT) END", 46, "k"),
    "l_linenumber": ("CASE WHEN l_linenumber > 2 THEN 3 WHEN l_linenumber >= 0 THEN l_linenumber END", 4, "k"),
    "l_returnflag": ("CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 WHEN 'A' THEN 2 END", 3, "elt(CAST(k AS INT) + 1, 'N', 'R', 'A')"),
    "l_linestatus": ("CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END", 2, "elt(CAST(k AS INT) + 1, 'F', 'O')"),
}
PART_CODES: Codes = {
    "p_partkey": ("CASE WHEN p_partkey >= 0 THEN p_partkey % 1320 END", 1320, "k"),  # 5, 11 and 120 divide it
    "p_type": ("CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 ELSE 0 END", 5, "elt(CAST(k AS INT) + 1, 'OTHER', 'STANDARD', 'ECONOMY', 'MEDIUM', 'PROMO')"),
    "p_size": ("CASE WHEN p_size BETWEEN 1 AND 104 THEN (p_size - 1) div 13 END", 8, "k * 13 + 1"),
    "p_retailprice": ("CASE WHEN p_retailprice IS NULL THEN 0 WHEN round(p_retailprice * 20) BETWEEN 0D AND 65534D THEN CAST(round(p_retailprice * 20) AS INT) + 1 END", 65536, "CASE WHEN k > 0 THEN (k - 1) / 20D END"),
}
PARTS = math.prod(size for _, size, _ in PART_CODES.values())
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PRIORITY = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN {k}" for k, p in enumerate(PRIORITIES)) + " ELSE 5 END"
#: An order's year (none: one that no timestamp has), whether its status is P, and its priority, any other of which goes beside.
ORDER_NUMBER = f"(coalesce(year(o_orderdate), 1000000) - 2000) * 12 + CASE WHEN o_orderstatus = 'P' THEN 6 ELSE 0 END + {PRIORITY}"
ORDER_VALUES = {
    "o_orderdate": "make_date(nullif(CAST(floor(_order / 12D) AS INT) + 2000, 1000000), 1, 1)",
    "o_orderstatus": "if(pmod(_order, 12) >= 6, 'P', 'O')",
    "o_orderpriority": f"elt(pmod(_order, 6) + 1, {', '.join(map(repr, PRIORITIES))}, _priority)",
}


def packed(rows: DataFrame, codes: Codes, name: str, *keep: str) -> DataFrame:
    """``keep`` and these columns as one number; rows with a value that has no number are 0 and have all the values beside, in ``odd{name}``."""
    number = reduce(lambda a, c: a * c[1] + F.expr(c[0]).cast("long"), codes.values(), F.lit(0).cast("long"))
    return rows.withColumn(name, number).select(F.coalesce(name, F.lit(0).cast("long")).alias(name), *keep, F.when(F.col(name).isNull(), F.struct(*codes)).alias(f"odd{name}"))


def values(rows: DataFrame, codes: Codes, name: str, number: str) -> dict[str, Column]:
    """The columns of ``packed``, in their own types, of the number as it is now."""
    odd, place, columns = F.col(f"odd{name}"), 1, {}
    types = {f.name: f.dataType for f in rows.schema[f"odd{name}"].dataType}
    for column, (_, size, value) in reversed(codes.items()):
        one = F.expr(re.sub(r"\bk\b", f"({number} div {place} % {size})", value)).cast(types[column])
        columns[column] = F.when(odd.isNull(), one).otherwise(odd[column])
        place *= size
    return columns


def counted_lines(spark: SparkSession, sf_dir: str, codes: tuple[int, ...]) -> DataFrame:
    """Of ``lines`` those that are of these procedures or a target's price; of their columns what all that is made of them reads.

    The cohort, the costs of these procedures and the target's prices are whole. Parts tell most of the others, so they are
    joined first and those lines never go to their orders. Where lines and orders move, their columns are one number.
    """
    t = lambda n: table(spark, sf_dir, n)
    line = t("lineitem").withColumn("l_extendedprice", F.round("l_extendedprice")).withColumn("_inpatient", F.expr(f"({SETTING}) IS NULL OR ({SETTING}) = 'Inpatient'"))
    line = packed(line, LINE_CODES, "_line", "l_orderkey", "l_partkey", "l_suppkey", "_inpatient")
    part = packed(t("part").withColumn("_code", F.expr(f"CAST({PROCEDURE} AS STRING)")), PART_CODES, "_part", F.col("p_partkey").alias("_key"), "_code")
    code = CODE.replace(f"CAST({PROCEDURE} AS STRING)", "_code").replace("s_suppkey", "l_suppkey")
    texts = lambda values: ", ".join(f"'{v}'" for v in values)
    line = line.join(part, F.col("l_partkey") == F.col("_key")).filter(f"_code IN ({texts(codes)}) OR _inpatient AND ({code}) IN ({texts(PRICE_CODES)})")
    line = line.select(F.expr(f"_line * {PARTS} + _part").alias("_number"), "l_suppkey", "l_orderkey", "odd_line", "odd_part")
    order = t("orders").select("o_orderkey", F.expr(ORDER_NUMBER).alias("_order"), F.expr(f"CASE WHEN {PRIORITY} = 5 THEN o_orderpriority END").alias("_priority"))
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    told = values(line, LINE_CODES, "_line", f"(_number div {PARTS})") | values(line, PART_CODES, "_part", f"(_number % {PARTS})") | {c: F.expr(e) for c, e in ORDER_VALUES.items()}
    told["l_partkey"] = told.pop("p_partkey")
    return joined.select("l_suppkey", *[c.alias(n) for n, c in told.items()]).select(*LINE_COLUMNS)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "n_name", "r_name")


#: Lines and suppliers as they are made when asked for, or as they were written.
Joined = tuple[DataFrame, DataFrame]


def _joined(joined: Joined) -> None:
    line, supplier = joined
    line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).createOrReplaceTempView("_vm_joined")


def discharges(spark: SparkSession, joined: Joined) -> DataFrame:
    _joined(joined)
    return spark.sql(f"SELECT {DISCHARGE} FROM _vm_joined")


def prices(spark: SparkSession, joined: Joined) -> DataFrame:
    _joined(joined)
    return spark.sql(f"SELECT {PRICE} FROM _vm_joined")


def recent(rows: DataFrame, codes: tuple[int, ...]) -> DataFrame:
    """Rows of providers' years that can be the latest of one of these procedures, or the latest with a positive median of their own ones.

    Where all charges of a provider's latest year are positive, so is every median of it; else all its years stay.
    """
    latest = lambda of, name: F.max(F.when(of, F.col("year"))).alias(name)
    own = F.col("procedure_code").isin(*OWN_CODES)
    ends = rows.groupBy("provider_id").agg(*[latest(F.col("procedure_code") == c, f"_{c}") for c in codes], latest(own, "_own"), latest(own & ~F.coalesce(F.col("charge") > 0, F.lit(False)), "_unpaid"))
    paid = F.coalesce(F.col("_unpaid") < F.col("_own"), F.lit(True))
    first = materialize(ends.select("provider_id", F.when(paid, F.least(*[f"_{c}" for c in codes])).alias("_first")), "first-years", short=True)
    return rows.join(first, "provider_id").filter("_first IS NULL OR year >= _first").drop("_first")


def costs(spark: SparkSession, joined: Joined, codes: tuple[int, ...] | None = None) -> DataFrame:
    """Median charges and costs; with ``codes``, those of these procedures in the years that ``recent`` leaves."""
    _joined(joined)
    rows = spark.sql(f"SELECT CAST(s_suppkey AS INT) AS provider_id, {PROCEDURE} AS procedure_code, CAST(floor((p_size - 1) / 13.0) AS INT) + 1 AS severity, CAST(year(o_orderdate) AS INT) AS year, round(l_extendedprice) AS charge FROM _vm_joined").filter("procedure_code <> 999")
    if codes is not None:
        rows = recent(rows.filter(F.col("procedure_code").isin(*codes)), codes)
    middle = lambda c: F.percentile(c, F.lit(0.5))
    return rows.groupBy("provider_id", "procedure_code", "severity", "year").agg(F.count("*").alias("discharges"), middle(F.col("charge")).alias("median_charge"), middle(F.floor(F.col("charge") / 2).cast("double")).alias("median_cost"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "supplier").createOrReplaceTempView("_vm_supplier")
    return spark.sql(LINKS.format(source="_vm_supplier", string="STRING"))


LINKS = (
    "SELECT CAST(s_suppkey AS INT) AS provider_id, s_name AS provider_name, CASE WHEN s_suppkey % 5 <> 4 THEN lower(" + NAME + ") END AS facility_name, "
    "'manual' AS match_method, 100.0 AS match_score, s_suppkey % 2 = 0 AS reviewed, CAST(s_suppkey AS {string}) AS ccn FROM {source}"
)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("_vm_events")
    return spark.sql(MEASURES.format(source="_vm_events", string="STRING"))


MEASURES = (
    "SELECT CAST(user_id AS {string}) AS ccn, CASE event_type WHEN 'purchase' THEN 'COMP_HIP_KNEE' WHEN 'click' THEN 'READM_30_HIP_KNEE' WHEN 'view' THEN 'CMS_OVERALL_RATING' ELSE event_type END AS measure_id, "
    "value AS score FROM {source}"
)

# ---- the same as SQL -------------------------------------------------------------------------------------


def R(x: str, n: int) -> str:
    """Round half away from zero on the shortest decimal form, as Spark does."""
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def Q(x: str, p: float) -> str:
    """Interpolated quantile by the formula Spark uses."""
    c, s = f"(count({x}) - 1)", f"(list({x} ORDER BY {x}) FILTER (WHERE {x} IS NOT NULL))"
    pos = f"({c} * {p})"
    low, high = f"CAST(floor({pos}) AS BIGINT)", f"CAST(ceil({pos}) AS BIGINT)"
    return f"(CASE WHEN count({x}) = 0 THEN NULL WHEN {low} = {high} THEN CAST({s}[{low} + 1] AS DOUBLE) ELSE ({high} - {pos}) * {s}[{low} + 1] + ({pos} - {low}) * {s}[{high} + 1] END)"


S_ = SETTINGS
COUNTIES = ", ".join(f"'{c}'" for c in S_.counties)
JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
duck = lambda text: text.replace("AS STRING", "AS VARCHAR")

OE = {
    "los": "o_los / nullif(e_los, 0)",
    "adv": "o_adv / nullif(e_adv, 0)",
}
COMPOSITE = f"CASE WHEN e_los IS NULL OR e_los = 0 THEN NULL WHEN o_adv IS NULL OR o_adv = 0 OR e_adv IS NULL OR e_adv = 0 THEN {OE['los']} ELSE sqrt(({OE['los']}) * ({OE['adv']})) END"


def _metric(keys: str, extra: str, floor: int, more: str) -> str:
    return f"""
  SELECT {keys}, patient_volume, first_year, last_year{more}, {R('sev', 2)} AS avg_severity, {R('o_los', 2)} AS observed_los, {R('e_los', 2)} AS expected_los, {R(OE['los'], 3)} AS oe_los,
    {R('o_adv * 100', 2)} AS observed_adverse_pct, {R('e_adv * 100', 2)} AS expected_adverse_pct, {R(OE['adv'], 3)} AS oe_adverse, {R(COMPOSITE, 3)} AS oe_composite, coalesce({R(COMPOSITE, 3)}, {R(OE['los'], 3)}) AS clinical_oe
  FROM (SELECT {keys}, count(*) AS patient_volume, min(year) AS first_year, max(year) AS last_year{extra}, avg(severity) AS sev, CAST(sum(los) AS DOUBLE) / count(*) AS o_los, sum(expected_los) / count(*) AS e_los,
      CAST(sum(adverse) AS DOUBLE) / nullif(count(adverse), 0) AS o_adv, sum(expected_adverse) / nullif(count(expected_adverse), 0) AS e_adv
    FROM cohort JOIN bench USING (procedure_code, severity, year) WHERE in_market GROUP BY {keys}) WHERE patient_volume >= {floor}"""


CODE_NAME = lambda c: f"CASE {c} WHEN 324 THEN 'hip' WHEN 301 THEN 'hip' WHEN 326 THEN 'knee' WHEN 302 THEN 'knee' END"
WMEAN = lambda a: R(f"sum({a} * discharges) / nullif(CAST(sum(CASE WHEN {a} > 0 THEN discharges END) AS DOUBLE), 0)", 2)
INDEX = lambda cost: R(f"power(1.0 / nullif(clinical_oe, 0), {S_.weight_clinical}) * power(market_median / nullif({cost}, 0), {S_.weight_financial}) * power(ln(1.0 + patient_volume), {S_.weight_experience})", 3)

CTES: dict[str, str] = {
    "discharges": f"SELECT {duck(DISCHARGE)} FROM {JOINED}",
    "prices": f"SELECT {duck(PRICE)} FROM {JOINED}",
    "costs": f"SELECT provider_id, procedure_code, severity, year, count(*) AS discharges, {Q('charge', 0.5)} AS median_charge, {Q('half', 0.5)} AS median_cost FROM (SELECT CAST(s_suppkey AS INT) AS provider_id, {PROCEDURE} AS procedure_code, CAST(floor((p_size - 1) / 13.0) AS INT) + 1 AS severity, CAST(year(o_orderdate) AS INT) AS year, round(l_extendedprice) AS charge, CAST(floor(round(l_extendedprice) / 2) AS DOUBLE) AS half FROM {JOINED}) WHERE procedure_code <> 999 GROUP BY ALL",
    "links": LINKS.format(source="supplier", string="VARCHAR"),
    "measures": MEASURES.format(source="events", string="VARCHAR"),
    "cohort": f"""SELECT provider_id, provider_name, certificate, county, CASE WHEN regexp_full_match(zip3, '[0-9]{{3}}') THEN zip3 END AS zip3, procedure_code, severity, year, county IN ({COUNTIES}) OR area = '{S_.service_area}' AS in_market,
    CASE WHEN los_raw LIKE '%+' THEN {S_.los_censor} ELSE CAST(los_raw AS INT) END AS los, CASE disposition WHEN 'Home or Self Care' THEN 0 WHEN 'Unknown' THEN NULL ELSE 1 END AS adverse
    FROM discharges WHERE procedure_code IN (324, 326) AND severity BETWEEN 1 AND 4 AND admission = 'Elective' AND risk <> 'Extreme'""",
    "bench": f"SELECT procedure_code, severity, year, count(*) AS stratum_n, {R('CAST(sum(los) AS DOUBLE) / count(*)', 4)} AS expected_los, {R('CAST(sum(adverse) AS DOUBLE) / nullif(count(adverse), 0)', 6)} AS expected_adverse FROM cohort GROUP BY ALL",
    "metrics": _metric("provider_id", ", count(*) FILTER (procedure_code = 324) AS hip_volume, count(*) FILTER (procedure_code = 326) AS knee_volume", S_.min_volume, ", hip_volume, knee_volume"),
    "proc_metrics": f"SELECT *, {CODE_NAME('procedure_code')} AS procedure FROM ({_metric('provider_id, procedure_code', '', S_.procedure_floor, '')})",
    "attributes": """SELECT provider_id, (SELECT provider_name FROM cohort c WHERE c.provider_id = p.provider_id AND in_market ORDER BY year DESC, provider_name LIMIT 1) AS provider_name,
    """ + ", ".join(f"(SELECT {a} FROM (SELECT {a}, count(*) AS n FROM cohort c WHERE c.provider_id = p.provider_id AND in_market AND {a} IS NOT NULL GROUP BY {a}) ORDER BY n DESC, {a} LIMIT 1) AS {a}" for a in ("certificate", "county", "zip3")) + " FROM (SELECT DISTINCT provider_id FROM cohort WHERE in_market) p",
    "lines": "SELECT *, CASE system WHEN 'MS-DRG' THEN 1 ELSE 2 END AS system_rank FROM prices WHERE ((system = 'MS-DRG' AND code = '470') OR (system = 'APR-DRG' AND code IN ('324', '326', '301', '302'))) AND (setting IS NULL OR setting ILIKE '%inpatient%')",
    "pricing": f"""SELECT *, coalesce(median_negotiated, median_cash) AS procedure_cost, CASE WHEN median_negotiated IS NOT NULL THEN 'median_negotiated' WHEN median_cash IS NOT NULL THEN 'median_cash_price' END AS price_file_basis FROM (
    SELECT facility_name, max(system) AS pricing_system, count(*) AS line_count, count(DISTINCT payer) AS payer_count, count(neg) AS negotiated_lines, {R(Q('cash', 0.5), 2)} AS median_cash, {R(Q('neg', 0.5), 2)} AS median_negotiated, min(neg) AS min_negotiated, max(neg) AS max_negotiated
    FROM (SELECT *, CASE WHEN negotiated > 0 THEN negotiated END AS neg, min(system_rank) OVER (PARTITION BY facility_name) AS best FROM lines) WHERE system_rank = best GROUP BY facility_name)""",
    "provider_costs": f"SELECT provider_id, {WMEAN('median_charge')} AS list_charge, {WMEAN('median_cost')} AS list_cost, max(year) AS cost_year FROM (SELECT *, max(CASE WHEN median_charge > 0 THEN year END) OVER (PARTITION BY provider_id) AS latest FROM costs WHERE procedure_code IN (324, 326)) WHERE year = latest GROUP BY provider_id",
    "market": f"SELECT cost_basis, count(*) AS providers, {R(Q('cost', 0.5), 2)} AS market_median, {R(Q('cost', 0.25), 2)} AS p25, {R(Q('cost', 0.75), 2)} AS p75, min(cost) AS least, max(cost) AS most FROM (SELECT 'mrf_negotiated' AS cost_basis, procedure_cost AS cost FROM pricing UNION ALL SELECT 'sparcs_charge', list_charge FROM provider_costs) WHERE cost IS NOT NULL GROUP BY cost_basis",
    "proc_pricing": f"""SELECT coalesce(m.provider_id, c.provider_id) AS provider_id, coalesce(m.procedure, c.procedure) AS procedure, coalesce(mrf_price, charge) AS procedure_cost, CASE WHEN mrf_price IS NOT NULL THEN 'mrf_negotiated' ELSE 'sparcs_charge' END AS cost_basis
    FROM (SELECT provider_id, procedure, {R(Q('neg', 0.5), 2)} AS mrf_price FROM (SELECT l.provider_id, {CODE_NAME('CAST(code AS INT)')} AS procedure, CASE WHEN negotiated > 0 THEN negotiated END AS neg FROM lines p JOIN links l ON lower(trim(p.facility_name)) = lower(trim(l.facility_name)) WHERE system = 'APR-DRG') GROUP BY ALL HAVING count(neg) > 0) m
    FULL JOIN (SELECT provider_id, procedure, {WMEAN('median_charge')} AS charge FROM (SELECT *, max(year) OVER (PARTITION BY provider_id, procedure) AS latest FROM (SELECT *, {CODE_NAME('procedure_code')} AS procedure FROM costs)) WHERE year = latest GROUP BY ALL) c ON m.provider_id = c.provider_id AND m.procedure = c.procedure
    WHERE coalesce(mrf_price, charge) IS NOT NULL""",
    "proc_bench": f"SELECT procedure, cost_basis, count(*) AS providers, {R(Q('procedure_cost', 0.5), 2)} AS market_median FROM proc_pricing GROUP BY ALL",
    "scores": f"""SELECT *, {R('1.0 / nullif(clinical_oe, 0)', 4)} AS clinical_multiplier, {R('market_median / nullif(cost, 0)', 4)} AS financial_multiplier, {R('ln(1.0 + patient_volume)', 4)} AS experience_modifier, {INDEX('cost')} AS value_index, {R('(1.0 / nullif(clinical_oe, 0)) * ln(1.0 + patient_volume)', 3)} AS clinical_only_index,
    CASE WHEN price_name IS NULL THEN 'unmapped_facility' WHEN cost IS NULL THEN 'no_published_price' WHEN clinical_oe IS NULL THEN 'no_clinical_benchmark' ELSE 'complete' END AS data_status
    FROM (SELECT x.*, k.market_median FROM (SELECT m.*, a.provider_name, a.certificate, a.county, a.zip3, l.facility_name AS price_name, l.reviewed, p.median_cash, p.median_negotiated, p.price_file_basis, p.payer_count, c.list_charge, coalesce(p.procedure_cost, c.list_charge) AS cost, CASE WHEN p.procedure_cost IS NOT NULL THEN 'mrf_negotiated' WHEN c.list_charge IS NOT NULL THEN 'sparcs_charge' END AS cost_basis
      FROM metrics m LEFT JOIN attributes a USING (provider_id) LEFT JOIN links l USING (provider_id) LEFT JOIN pricing p ON lower(trim(p.facility_name)) = lower(trim(l.facility_name)) LEFT JOIN provider_costs c USING (provider_id)) x LEFT JOIN market k USING (cost_basis))""",
    "proc_scores": f"SELECT m.*, p.procedure_cost, p.cost_basis, b.market_median, {INDEX('procedure_cost')} AS value_index FROM proc_metrics m LEFT JOIN proc_pricing p USING (provider_id, procedure) LEFT JOIN proc_bench b ON b.procedure = m.procedure AND b.cost_basis = p.cost_basis",
    "view": f"""SELECT *, CAST(NULL AS VARCHAR) AS _x, county AS borough, last_year - first_year + 1 AS years_observed, {R('(cost - market_median) * 100.0 / nullif(market_median, 0)', 1)} AS pct_vs_market,
    CASE WHEN value_index IS NOT NULL THEN rank() OVER (PARTITION BY value_index IS NULL ORDER BY value_index DESC) END AS value_rank, CASE WHEN value_index IS NOT NULL THEN {R('100 * percent_rank() OVER (PARTITION BY value_index IS NULL ORDER BY value_index)', 1)} END AS value_percentile, CASE WHEN value_index IS NOT NULL THEN CAST(ntile(5) OVER (PARTITION BY value_index IS NULL ORDER BY value_index, provider_id) AS INT) END AS star_rating FROM scores""",
    "outcomes": "SELECT provider_id, ccn, max(score) FILTER (measure_id = 'COMP_HIP_KNEE') AS complication_rate, max(score) FILTER (measure_id = 'READM_30_HIP_KNEE') AS readmission_rate, max(score) FILTER (measure_id = 'CMS_OVERALL_RATING') AS overall_rating FROM links JOIN measures USING (ccn) GROUP BY ALL",
}
NEEDS = {
    "cohort": ["discharges"], "bench": ["cohort"], "metrics": ["bench"], "proc_metrics": ["bench"], "attributes": ["cohort"], "lines": ["prices"], "pricing": ["lines"], "provider_costs": ["costs"], "market": ["pricing", "provider_costs"],
    "proc_pricing": ["lines", "links", "costs"], "proc_bench": ["proc_pricing"], "scores": ["metrics", "attributes", "links", "market"], "proc_scores": ["proc_metrics", "proc_bench"], "view": ["scores"], "outcomes": ["links", "measures"],
}


def sql(select: str, *needs: str) -> str:
    """``select`` with the common table expressions that it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order) + f"\n{select}"
