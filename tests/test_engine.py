"""The hand-computed fixture, the file readers, links, ranks and plans."""

import gzip
import json
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from valuemark.config import Settings
from valuemark.operators import checks, clinical, linkage, pricing, ranking, scoring
from valuemark.plans import registry
from valuemark.sources import prices as P
from valuemark.sources import sinks
from valuemark.sources import tables as T
from valuemark.streaming.cells import current_cells, maintain_cells

S = Settings(min_volume=3, oe_metric="los", weight_clinical=1.0)
NYC = "New York City"
DISCHARGES = [
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Elective", 326, 1, "Minor", "2", "Home or Self Care", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Elective", 326, 1, "Minor", "4", "Home or Self Care", 2022),
    (1001, "FACILITY A HOSPITAL", "New York", NYC, "100", "Elective", 324, 2, "Moderate", "6", "Skilled Nursing Home", 2024),
    (1001, "FACILITY A HOSPITAL", "New York", NYC, "100", "Elective", 324, 2, "Moderate", "8", "Home w/ Home Health Services", 2024),
    (1002, "FACILITY B MEDICAL CENTER", "Kings", NYC, "112", "Elective", 326, 1, "Minor", "1", "Home or Self Care", 2022),
    (1002, "FACILITY B MEDICAL CENTER", "Kings", NYC, "112", "Elective", 326, 1, "Minor", "1", "Home or Self Care", 2022),
    (1002, "FACILITY B MEDICAL CENTER", "Kings", NYC, "112", "Elective", 326, 1, "Minor", "1", "Home or Self Care", 2024),
    (1002, "FACILITY B MEDICAL CENTER", "Kings", NYC, "112", "Elective", 326, 1, "Minor", "1", "Hospice - Home", 2024),
    (1003, "FACILITY C SMALL", "Queens", NYC, "113", "Elective", 326, 1, "Minor", "3", "Home or Self Care", 2022),
    (1003, "FACILITY C SMALL", "Queens", NYC, "113", "Elective", 326, 1, "Minor", "3", "Home or Self Care", 2024),
    *[(1004, "FACILITY D UPSTATE", "Albany", "Capital/Adirond", "122", "Elective", 324, 2, "Moderate", "10", "Home or Self Care", y) for y in (2022, 2022, 2024, 2024)],
    (1004, "FACILITY D UPSTATE", "Albany", "Capital/Adirond", "122", "Elective", 324, 4, "Major", "120+", "Skilled Nursing Home", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Elective", 326, 1, "Minor", "", "Home or Self Care", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Emergency", 326, 1, "Minor", "5", "Home or Self Care", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Elective", 326, 4, "Extreme", "30", "Expired", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "OOS", "Elective", 999, 1, "Minor", "3", "Home or Self Care", 2022),
    (1001, "Facility A Hospital", "Manhattan", NYC, "100", "Elective", 325, 1, "Minor", "9", "Home or Self Care", 2022),
    (None, "FACILITY E NOPFI", "Bronx", NYC, "104", "Elective", 326, 1, "Minor", "2", "Home or Self Care", 2022),
]
PRICES = [
    ("Facility A Hospital", "470", "MS-DRG", "inpatient", "Aetna", "PPO", 25000.0, 28000.0), ("Facility A Hospital", "470", "MS-DRG", "inpatient", "Cigna", "HMO", 25000.0, 30000.0), ("Facility A Hospital", "470", "MS-DRG", "inpatient", "United", "EPO", 25000.0, 32000.0),
    ("Facility A Hospital", "324", "APR-DRG", "inpatient", "Aetna", "PPO", 99999.0, 99999.0), ("Facility A Hospital", "470", "CPT", "outpatient", "Aetna", "PPO", 888888.0, 888888.0), ("Facility A Hospital", "470", "APR-DRG", "inpatient", "Aetna", "PPO", 777777.0, 777777.0),
    ("Facility A Hospital", "470", "MS-DRG", "outpatient", "Aetna", "PPO", 666666.0, 666666.0), ("Facility B Medical Center", "324", "APR-DRG", "inpatient", "Aetna", "PPO", 55000.0, 55000.0), ("Facility B Medical Center", "326", "APR-DRG", "inpatient", "Cigna", "HMO", 55000.0, 65000.0),
]


@pytest.fixture(scope="module")
def t(spark):
    d = spark.createDataFrame(DISCHARGES, "provider_id int, provider_name string, county string, area string, zip3 string, admission string, procedure_code int, severity int, risk string, los_raw string, disposition string, year int").withColumn("certificate", F.lit("c1"))
    prices = spark.createDataFrame(PRICES, "facility_name string, code string, system string, setting string, payer string, plan string, cash double, negotiated double")
    links = spark.createDataFrame([(1001, "Facility A Hospital", "manual", 100.0, True), (1002, "Facility B Medical Center", "manual", 100.0, True)], "provider_id int, facility_name string, match_method string, match_score double, reviewed boolean")
    costs = spark.createDataFrame([(1001, 324, 1, 2023, 10, 20000.0, 1.0), (1001, 324, 2, 2023, 30, 40000.0, 1.0), (1001, 324, 3, 2023, 5, None, 1.0), (1001, 324, 1, 2020, 90, 9.0, 1.0)], "provider_id int, procedure_code int, severity int, year int, discharges int, median_charge double, median_cost double")
    out = {"discharges": d, "prices": prices, "links": links, "costs": costs}
    out["cohort"] = clinical.cohort(d, S)
    out["cells"] = clinical.cells(out["cohort"])
    out["bench"] = clinical.benchmarks(out["cells"], S)
    out["metrics"] = clinical.provider_metrics(out["cells"], out["bench"], S)
    out["attributes"] = clinical.provider_attributes(out["cohort"])
    out["pricing"] = pricing.provider_pricing(prices, S)
    none = costs.limit(0)
    out["market"] = pricing.market_benchmark(out["pricing"], pricing.provider_costs(none, S))
    out["scores"] = scoring.score_table(out["metrics"], out["attributes"], links, out["pricing"], pricing.provider_costs(none, S), out["market"], S)
    return out


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_cohort(t):
    rows = t["cohort"].collect()
    assert len(rows) == 15 and sum(r.los == 120 for r in rows) == 1 and all(r.procedure_code != 325 for r in rows)
    own = [r for r in rows if r.provider_id == 1001]
    assert len(own) == 4 and all(r.in_market for r in own)
    assert clinical.drop_reasons(t["discharges"], S).first().not_elective == 1


def test_strata(t):
    b = by(t["bench"], "procedure_code", "severity", "year")
    got = {k: (r.stratum_n, r.expected_los, r.expected_adverse) for k, r in b.items()}
    assert got == {(326, 1, 2022): (5, 2.2, 0.0), (326, 1, 2024): (3, 1.6667, 0.333333), (324, 2, 2022): (2, 10.0, 0.0), (324, 2, 2024): (4, 8.5, 0.25), (324, 4, 2022): (1, 120.0, 1.0)}


def test_provider_metrics(t):
    m = by(t["metrics"], "provider_id")
    assert set(m) == {(1001,), (1002,)}
    a, b = m[1001,], m[1002,]
    assert (a.patient_volume, a.observed_los, a.expected_los, a.oe_los, a.observed_adverse_pct, a.oe_adverse, a.oe_composite, a.hip_volume) == (4, 5.0, 5.35, 0.935, 25.0, 2.0, 1.367, 2)
    assert (b.patient_volume, b.observed_los, b.expected_los, b.oe_los, b.observed_adverse_pct, b.oe_adverse, b.oe_composite) == (4, 1.0, 1.93, 0.517, 25.0, 1.5, 0.881)
    assert by(t["attributes"], "provider_id")[1001,].provider_name == "FACILITY A HOSPITAL" and by(t["attributes"], "provider_id")[1001,].zip3 == "100"
    assert clinical.procedure_metrics(t["cells"], t["bench"], S).count() == 0


def test_cells_merge(t):
    parts = [clinical.cells(t["cohort"].filter(F.col("year") == y)) for y in (2022, 2024)]
    assert sorted(map(str, clinical.merge_cells(*parts).collect())) == sorted(map(str, t["cells"].select(*clinical.CELL_KEYS, *clinical.CELL_SUMS).collect()))


def test_cells_follow_arriving_files(spark, t, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "cells", "mark"))
    for year in (2022, 2024):
        t["discharges"].filter(F.col("year") == year).write.mode("append").parquet(source)
        maintain_cells(spark, source, t["discharges"].schema, target, mark, S)
    maintain_cells(spark, source, t["discharges"].schema, target, mark, S)  # nothing new
    same = lambda df: sorted(map(str, df.select(*clinical.CELL_KEYS, *[F.col(c).cast("double").alias(c) for c in clinical.CELL_SUMS]).collect()))
    assert same(current_cells(spark, target)) == same(t["cells"])


def test_pricing(t):
    p = by(t["pricing"], "facility_name")
    a, b = p["Facility A Hospital",], p["Facility B Medical Center",]
    assert (a.line_count, a.pricing_system, a.median_negotiated, b.line_count, b.pricing_system, b.median_negotiated) == (3, "MS-DRG", 30000.0, 2, "APR-DRG", 60000.0)
    assert [(r.cost_basis, r.market_median) for r in t["market"].collect()] == [("mrf_negotiated", 45000.0)]
    assert pricing.provider_costs(t["costs"], S).first().list_charge == 35000.0
    q = by(pricing.procedure_pricing(t["prices"], t["costs"].limit(0), t["links"], S), "provider_id", "procedure")
    assert {k: r.procedure_cost for k, r in q.items()} == {(1001, "hip"): 99999.0, (1002, "hip"): 55000.0, (1002, "knee"): 65000.0}


def test_scores_and_view(t):
    s = by(t["scores"], "provider_id")
    assert len(s) == 2 and abs(s[1001,].value_index - 2.582) < 0.01 and abs(s[1002,].value_index - 2.335) < 0.01
    v = by(ranking.consumer_view(t["scores"]), "provider_id")
    assert [(v[k].value_rank, v[k].value_percentile, v[k].star_rating) for k in ((1001,), (1002,))] == [(1, 100.0, 2), (2, 0.0, 1)]
    assert checks.assert_key(t["scores"], ["provider_id"]) is t["scores"]
    with pytest.raises(ValueError):
        checks.assert_key(t["cohort"], ["provider_id"])


def test_price_files(spark, tmp_path):
    tall = tmp_path / "tall.csv"
    tall.write_text("hospital_name,last_updated_on,version,license_number\nSample Hospital,2024-01-01,2.0.0,330001\ndescription,code|1,code|1|type,code|2,code|2|type,setting,payer_name,plan_name,standard_charge|gross,standard_charge|discounted_cash,standard_charge|negotiated_dollar,standard_charge|negotiated_percentage,standard_charge|min,standard_charge|max\n"
                    'Major joint,27447,CPT,MS-DRG 470,MS-DRG,inpatient,Aetna,PPO,"$68,016.00",25000,30000,65,20000,40000\nHIP JOINT REPLACEMENT,APR301-1,DRG,,,inpatient,Cigna,HMO,,,22288,,,\nOTHER PROCEDURE,APR301-1,DRG,,,inpatient,Cigna,HMO,,,1,,,\n')  # fmt: skip
    wide = tmp_path / "wide.csv"
    wide.write_text("hospital_name,license_number\nSample Hospital,330001\ndescription,code|1,code|1|type,setting,standard_charge|discounted_cash,standard_charge|Aetna|PPO|negotiated_dollar,standard_charge|Aetna|PPO|negotiated_percentage,standard_charge|Cigna|HMO|negotiated_dollar\nKnee,326,APR-DRG,inpatient,50000,60000,70,61000\nKnee,326,APR-DRG,inpatient,50000,,,\n")
    deep = tmp_path / "deep.json"
    deep.write_text('{"hospital_name":"Ignored","standard_charge_information":[{"description":"Knee","code_information":[{"code":"27447","type":"CPT"},{"code":"326","type":"APR-DRG"}],"standard_charges":[{"setting":"inpatient","gross_charge":90000,"discounted_cash":50000,"minimum":1,"maximum":2,"payers_information":[{"payer_name":"Aetna","plan_name":"PPO","standard_charge_dollar":60000}]},{"setting":"inpatient","discounted_cash":45000}]}]}')
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    lines, status = P.load_prices(spark, {"tall": str(tall), "wide": str(wide), "deep": str(deep), "bad": str(bad)}, Settings())
    got = {(r.source, r.facility_name, r.ccn, r.code, r.system, r.payer, r.negotiated, r.cash) for r in lines.collect()}
    assert got == {("tall", "Sample Hospital", "330001", "470", "MS-DRG", "Aetna", 30000.0, 25000.0), ("tall", "Sample Hospital", "330001", "301", "APR-DRG", "Cigna", 22288.0, None), ("wide", "Sample Hospital", "330001", "326", "APR-DRG", "Aetna", 60000.0, 50000.0), ("wide", "Sample Hospital", "330001", "326", "APR-DRG", "Cigna", 61000.0, 50000.0), ("wide", "Sample Hospital", "330001", "326", "APR-DRG", None, None, 50000.0), ("deep", "deep", None, "326", "APR-DRG", "Aetna", 60000.0, 50000.0), ("deep", "deep", None, "326", "APR-DRG", None, None, 45000.0)}
    assert {s["source"]: s["status"].split(":")[0] for s in status} == {"tall": "ok", "wide": "ok", "deep": "ok", "bad": "failed"}
    _, status = P.load_prices(spark, {"tall": str(tall)}, Settings(), max_rows=1)
    assert status[0]["status"] == "partial" and status[0]["rows"] == 1


def test_many_packed_and_broken_price_files(spark, tmp_path):
    rows = "hospital_name,license_number\nPlace {0},{0}\ndescription,code|1,code|1|type,setting,payer_name,standard_charge|negotiated_dollar\n\"Knee,\nboth\",326,APR-DRG,inpatient,Aetna,{0}\n"
    item = {"description": "Knee \\ } {", "code_information": [{"code": "326", "type": "APR-DRG"}], "standard_charges": [{"setting": "inpatient", "gross_charge": 7, "payers_information": [{"payer_name": "A}", "standard_charge_dollar": 9}]}]}
    deep = json.dumps({"hospital_name": "standard_charge_information", "modifier": [{"description": "x", "code": "326"}], "standard_charge_information": [item] * 3, "tail": {"a": [1]}})
    labels = {}
    for k in range(1, 41):
        (tmp_path / f"tall {k}.csv").write_text(rows.format(k))
        labels[f"t{k}"] = str(tmp_path / f"tall {k}.csv")
    with zipfile.ZipFile(tmp_path / "z.aspx", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("inner.json", deep)
    with zipfile.ZipFile(tmp_path / "y.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("inner.csv", rows.format(77))
    (tmp_path / "g.csv.gz").write_bytes(gzip.compress(rows.format(78).encode()))
    (tmp_path / "g.bin").write_bytes(gzip.compress(deep.encode()))
    (tmp_path / "flat.json").write_text(deep + "\n")
    (tmp_path / "cut.json").write_text(deep[: deep.index('"tail"') - 40])
    (tmp_path / "short.json").write_text('{"standard_charge_information": [{"description": "Kn')
    (tmp_path / "none.json").write_text('[{"standard_charge_information": []}]')
    (tmp_path / "blank").write_text("  ")
    more = {"zip": "z.aspx", "zipcsv": "y.zip", "gz": "g.csv.gz", "gzbin": "g.bin", "flat": "flat.json", "cut": "cut.json", "short": "short.json", "none": "none.json", "blank": "blank", "lost": "missing.csv"}
    labels |= {k: str(tmp_path / v) for k, v in more.items()}
    lines, status = P.load_prices(spark, labels, Settings(), hints={str(tmp_path / "blank"): "application/json"})
    told = {s["source"]: (s["rows"], s["status"].split(":")[0]) for s in status}
    assert all(told[f"t{k}"] == (1, "ok") for k in range(1, 41)), told
    assert {k: told[k] for k in more} == {"zip": (3, "ok"), "zipcsv": (1, "ok"), "gz": (1, "ok"), "gzbin": (3, "ok"), "flat": (3, "ok"), "cut": (2, "partial"), "short": (0, "failed"), "none": (0, "empty"), "blank": (0, "empty"), "lost": (0, "failed")}
    got = {(r.source, r.ccn, r.description, r.payer, r.negotiated) for r in lines.collect()}
    assert {("t40", "40", "Knee,\nboth", "Aetna", 40.0), ("zipcsv", "77", "Knee,\nboth", "Aetna", 77.0), ("gz", "78", "Knee,\nboth", "Aetna", 78.0), ("flat", None, "Knee \\ } {", "A}", 9.0), ("gzbin", None, "Knee \\ } {", "A}", 9.0)} <= got


def test_manifest_and_targets(spark):
    df = spark.createDataFrame([("https://h.org/cms-hpt.txt", "location-name: A\nMRF-URL: /a.json\nlocation-name: B\nmrf-url: https://h/b.csv\n# note: x\nlocation-name: C"), ("https://x.org/", "<HTML> location-name: q\nmrf-url: /z")], "base string, body string")
    got = P.manifest_locations(df).collect()
    assert [(r.location_name, r.mrf_url) for r in got] == [("A", "https://h.org/a.json"), ("B", "https://h/b.csv")]
    targets = spark.createDataFrame([("S1", "https://m/f.csv"), ("S2", ""), ("", "x"), ("S3", None)], "system_name string, manual_mrf_url string")
    found = spark.createDataFrame([("S1", "l", "https://d/1"), ("S2", "l", "https://d/2")], "system_name string, location_name string, mrf_url string")
    have, lack = P.price_targets(targets, found)
    assert {r.system_name: r.url for r in have.collect()} == {"S1": "https://m/f.csv", "S2": "https://d/2"} and [r.system_name for r in lack.collect()] == ["S3"]


def test_releases_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Facility Id,APR DRG Code,Length of Stay,Zip Code,Discharge Year\n12.0,326, 3 ,100,2022\n,999,1,1,2022\n")
    (tmp_path / "b.csv").write_text("permanent_facility_id,apr_drg_code,length_of_stay,zip_code_3_digits,discharge_year\n13,324,120+,OOS,2024\n")
    df, failed = T.load_discharges(spark, {"2022": str(tmp_path / "a.csv"), "2024": str(tmp_path / "b.csv"), "2025": str(tmp_path / "none.csv")}, [324, 326])
    assert {(r.provider_id, r.los_raw, r.zip3, r.release) for r in df.collect()} == {(12, "3", "100", "2022"), (13, "120+", "OOS", "2024")} and set(failed) == {"2025"}
    with pytest.raises(ValueError):
        T.filter_codes(df, "procedure_code", [1])
    with pytest.warns(UserWarning):
        assert T.capped(df, 1).count() == 1
    path = str(tmp_path / "stage")
    sinks.write_staging(df, path)
    sinks.write_staging(df.filter("release = '2024'").withColumn("los_raw", F.lit("")), path)
    back = {r.provider_id: r.los_raw for r in spark.read.parquet(path).collect()}
    assert back == {12: "3", 13: None}
    view = spark.createDataFrame([(1, 2.0, "hip"), (2, None, "hip"), (3, 5.0, "knee")], "provider_id int, value_index double, procedure string")
    out = spark.read.csv(sinks.export_csv(view, str(tmp_path)), header=True).collect()
    assert [r.provider_id for r in out] == ["3", "1"]
    assert sinks.publish(view, view.drop("procedure"), str(tmp_path / "p")) | {"by_procedure": ""} == {"combined": "ok", "by_procedure": ""}
    (tmp_path / "r.csv").write_text("﻿provider_id,reviewed\n1,yes\n")
    assert sinks.read_reviewed(spark, str(tmp_path / "r.csv")).columns == ["provider_id", "reviewed"]
    assert sinks.read_or_fallback(spark, [str(tmp_path / "missing")], view.schema).count() == 0


def test_cost_and_measure_loaders(spark):
    raw = spark.createDataFrame([("12", "HIP JOINT REPLACEMENT", "$1,000.50", "2021"), ("13", "OTHER", "1", "2021"), (None, "knee joint  replacement", "2", "2021")], "pfi string, apr_drg_description string, mean_charge string, year string").withColumn("apr_drg_code", F.lit("324"))
    assert [(r.provider_id, float(r.mean_charge)) for r in T.load_costs(raw, [324]).collect()] == [(12, 1000.5)]
    rating = spark.createDataFrame([("33", "4", "Gov"), ("34", "Not Available", "Gov"), ("", "5", "x")], "facility_id string, hospital_overall_rating string, hospital_ownership string")
    assert [(r.ccn, float(r.score), r.compared_to_national) for r in T.load_overall_rating(rating).collect()] == [("33", 4.0, "Gov")]


@pytest.mark.parametrize("seed", range(3))
def test_matching_equals_a_sequential_greedy(spark, seed):
    rng = random.Random(seed)
    prefs = [(p, f"t{n}", rng.random() < 0.2, float(rng.randrange(60, 100))) for p in range(9) for n in rng.sample(range(7), 4)]
    taken, want = set(), set()
    for p in range(9):
        for _, x, s, name in sorted((not e, e, -s, n) for q, n, e, s in prefs if q == p):
            if name not in taken:
                taken.add(name)
                want.add((p, name))
                break
    df = spark.createDataFrame(prefs, "provider_id int, facility_name string, exact boolean, score double").withColumn("priority", F.col("provider_id"))
    assert {(r.provider_id, r.facility_name) for r in linkage.one_to_one(df).collect()} == want


def test_links_are_proposed_merged_and_imported(spark):
    providers = spark.createDataFrame([(1, "c", "MOUNT SINAI HOSPITAL", 50), (2, "c", "LENOX HILL HOSPITAL", 90), (3, "c", "Nowhere Clinic", 10), (4, "c", "Lenox Hill Campus", 5)], "provider_id int, certificate string, provider_name string, volume int")
    names = spark.createDataFrame([("The Mount Sinai Hospital",), ("Lenox Hill Hospital Inc",), ("Lenox Hills Annex",)], "facility_name string")
    none = linkage.propose(providers.limit(0), names, providers.limit(0).selectExpr("provider_id", "provider_name AS facility_name", "false AS reviewed"), S)
    links = linkage.propose(providers, names, none, S)
    got = {r.provider_id: (r.facility_name, r.match_method, r.reviewed) for r in links.collect()}
    assert got[1] == ("The Mount Sinai Hospital", "exact", True) and got[2] == ("Lenox Hill Hospital Inc", "exact", True) and got[3] == (None, "unmatched", False) and got[4][:2] == ("Lenox Hills Annex", "fuzzy")
    merged = linkage.protected_merge(links, links.withColumn("facility_name", F.lit("x")))
    assert {r.provider_id: r.facility_name for r in merged.collect()}[1] == "The Mount Sinai Hospital" and merged.count() == 4
    rows = spark.createDataFrame([("3", "Nowhere Clinic", "Somewhere", "yes"), ("1", "MOUNT SINAI HOSPITAL", "", "no")], "provider_id string, provider_name string, facility_name string, reviewed string")
    after = {r.provider_id: (r.facility_name, r.match_method, r.reviewed, r.match_score) for r in linkage.manual_import(links, rows).collect()}
    assert after[3][:3] == ("Somewhere", "manual", True) and after[1][:3] == (None, "manual", False) and after[1][3] == 100
    for bad in ([("x", "a", "b", "1")], [("1", "a", "B ", "1"), ("2", "c", "b", "1")]):
        with pytest.raises(ValueError):
            linkage.check_import(spark.createDataFrame(bad, rows.schema))
    assert {r.provider_id: r.match_score for r in linkage.approve(links, 3, "N").collect()}[3] == 100
    assert linkage.review_candidates(providers, names, links).filter("provider_id = 1").first().claimed
    assert linkage.match_summary(links, providers).first().matched == 3
    assert [r.provider_id for r in linkage.review_queue(links, providers, "attention").collect()] == [3, 4]


def test_global_ranks_equal_windows(spark):
    rows = spark.range(500).selectExpr("id AS provider_id", "CAST(pmod(hash(id), 37) AS DOUBLE) AS value_index")
    df = rows.unionByName(spark.createDataFrame([(900, None)], "provider_id long, value_index double"))
    a = {r.provider_id: r for r in ranking.ranked(df).collect()}
    b = {r.provider_id: r for r in ranking.ranked(df.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert all((a[k].value_rank, a[k].value_percentile, a[k].star_rating) == (b[k].value_rank, b[k].value_percentile, b[k].star_rating) for k in b) and len(a) == 501


def test_every_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    plain = lambda v: round(float(v), 7) if isinstance(v, float) or hasattr(v, "as_tuple") else v
    for name, sql in registry.oracle_sql().items():
        df = registry.queries()[name](spark, sf)
        columns = sorted(df.columns)
        got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
        assert sorted(names) == columns and got == want, name


def test_entry_and_plan(spark):
    assert E.entry(spark).count() >= 0
    plan = registry.queries()["A2_provider_metrics"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan
    assert set(E.oracle_sql()) <= set(E.queries())
