"""Stage jobs from files to published snapshots, links of measures, and how often plans scan large tables."""

import re

import pytest
from pyspark.sql import functions as F

from valuemark import session
from valuemark.config import Settings
from valuemark.operators import linkage, ranking
from valuemark.plans import binding, jobs
from valuemark.plans.pipeline import Stages
from valuemark.sources import tables
from valuemark.sources.versions import Conflict, VersionedTable

SF = "/root/testdata/sf0.001"


@pytest.fixture
def files(tmp_path):
    head = "Permanent Facility Id,Facility Name,Hospital County,Hospital Service Area,Zip Code - 3 digits,Type of Admission,APR DRG Code,APR Severity of Illness Code,APR Risk of Mortality,Length of Stay,Patient Disposition,Discharge Year,Operating Certificate Number\n"
    row = "{0},{1},Kings,New York City,112,Elective,{2},1,Minor,{3},Home or Self Care,2022,7\n"
    (tmp_path / "d.csv").write_text(head + "".join(row.format(1, "ALPHA HOSPITAL", 326, k) for k in (1, 2, 3)) + "".join(row.format(2, "BETA MEDICAL CENTER", 324, k) for k in (2, 4, 6)))
    (tmp_path / "p.csv").write_text("hospital_name,license_number\nAlpha Hospital,1\ndescription,code|1,code|1|type,setting,payer_name,standard_charge|negotiated_dollar\nKnee,326,APR-DRG,inpatient,A,30000\n")
    (tmp_path / "c.csv").write_text("PFI,Facility Name,APR DRG Code,APR DRG Description,APR Severity of Illness Code,Discharges,Median Charge,Median Cost,Year\n2,BETA,324,HIP JOINT REPLACEMENT,1,5,50000,20000,2021\n")
    (tmp_path / "m.csv").write_text("Facility ID,Facility Name,Measure ID,Score\n330001,ALPHA HOSPITAL,COMP_HIP_KNEE,2.5\n330002,BETA MEDICAL CENTRE,COMP_HIP_KNEE,3.5\n")
    return tmp_path


def test_all_jobs_in_order(spark, files):
    at = lambda n: str(files / n)
    run = jobs.Run(spark, at("out"), Settings(min_volume=2), {"2022": at("d.csv"), "2023": at("missing.csv")}, "csv", {"Alpha": at("p.csv"), "Bad": at("c.csv")}, at("c.csv"), at("m.csv"))
    report = jobs.run_all(run)
    assert set(report["discharges"]) == {"2023"} and [s["status"].split(":")[0] for s in report["prices"]] == ["ok", "failed"]
    got = {r.provider_id: r for r in run.read("view").collect()}
    assert set(got) == {1, 2} and got[1].cost_basis == "mrf_negotiated" and got[2].cost_basis == "sparcs_charge" and float(got[1].complication_rate) == 2.5
    assert report["publish"] == {"combined": "ok", "by_procedure": "ok"} and spark.read.csv(report["export"], header=True).count() == 2
    # Links that a person has approved stand; a job can be repeated alone.
    run.write("links", linkage.approve(run.read("links"), 2, "Somewhere"))
    jobs.crosswalk(run)
    assert {r.provider_id: r.facility_name for r in run.read("links").collect()}[2] == "Somewhere"


def test_measures_that_cannot_be_linked_are_tolerated(spark, files):
    run = jobs.Run(spark, str(files / "out"), measures=str(files / "m.csv"))
    jobs.schema(run)
    with pytest.warns(UserWarning):
        jobs.ingest_quality(run)
    assert run.read("measures").count() == 2 and run.read("measure_links").count() == 0 and "measure_links" in run.report


def test_measure_links(spark):
    left = spark.createDataFrame([(1, "Mount Sinai Hospital", 5), (2, "MOUNT SINAI HOSPITAL", 9), (3, "Lenoxx Hill Hospital", 1), (4, "Unlike", 1), (5, "", 1)], "provider_id int, provider_name string, volume int")
    right = spark.createDataFrame([("33", "The Mount Sinai Hospital"), ("33", "Mount Sinai Annexe"), ("34", "Lenox Hill Hospital"), ("35", "Lenox Hill Hospital"), ("", "Unlike"), ("36", None)], "ccn string, facility_name string")
    got = {r.provider_id: (r.ccn, r.match_method) for r in linkage.propose_measure_links(left, right, Settings()).collect()}
    assert got == {2: ("33", "exact"), 3: ("34", "fuzzy")}


def test_review_queue_is_written(spark, tmp_path):
    queue = spark.createDataFrame([(2, "b"), (1, "a")], "provider_id int, facility_name string")
    back = spark.read.csv(linkage.write_review_queue(queue, str(tmp_path / "queue")), header=True).collect()
    assert [r.provider_id for r in back] == ["2", "1"]


def test_chosen_view_and_missing_columns(spark):
    both = spark.createDataFrame([(1, 2.0)], "provider_id int, value_index double")
    each = spark.createDataFrame([(1, "hip"), (2, "knee")], "provider_id int, procedure string")
    assert ranking.chosen_view(both, each, None) is both and ranking.chosen_view(both, None, "hip") is both
    assert [r.provider_id for r in ranking.chosen_view(both, each, "knee").collect()] == [2]
    assert both.select(ranking.column_or(both, "stars", 3).alias("s"), ranking.column_or(both, "value_index").alias("v")).first() == (3, 2.0)


def test_no_plan_scans_a_large_table_twice(spark):
    t = Stages(spark, SF)
    for name in ("cells", "attributes", "provider_pricing", "provider_costs", "scores", "view"):
        built = getattr(t, name)
        plan = built._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"lineitem\.parquet", plan)) == 0, name  # read from what was written
    for name in ("discharges", "prices"):
        assert len(re.findall(r"FileScan parquet [^\n]*l_suppkey", getattr(t, name)._jdf.queryExecution().executedPlan().toString())) == 1
    assert t.view.filter(F.col("value_rank") == 1).count() >= 1


def test_lines_are_joined_once_for_all_that_they_give(spark, monkeypatch):
    made = []
    monkeypatch.setattr(binding, "lines", lambda *a, was=binding.lines: made.append(1) or was(*a))
    t = Stages(spark, SF)
    assert t.scores.count() and t.procedure_pricing.count() and t.discharges.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert len(made) == 1
    for df in (t.discharges, t.prices):
        assert "orders.parquet" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.write(spark.range(3)) == 1
    broken = spark.range(9).withColumn("x", F.raise_error(F.lit("gone"))).drop("x").withColumn("id", F.when(F.col("id") > 7, F.raise_error(F.lit("gone")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="gone"):
        t.write(broken)
    assert t.read().count() == 3
    with monkeypatch.context() as m:  # between the data and the pointer
        m.setattr(VersionedTable, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.write(spark.range(5))
    old = t.read()
    assert old.count() == 3 and t.write(old.filter("id > 0")) == 2  # a table may be read in making its successor
    assert (t.read().count(), t.read(1).count(), old.count()) == (2, 3, 3)
    with pytest.raises(Conflict):
        t.commit(t.stage(spark.range(1)), after=1)
    assert t.write(spark.range(7)) == 3 and len(t.clear()) == 4 and t.versions() == [2, 3] and t.read(2).count() == 2 and t.read().count() == 7


def test_partitions_at_hand_are_replaced(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(list(r), "release string, n int")
    t.write(rows(("2022", 1), ("2023", 2), ("a/b=c", 3), (None, 4)), "release")
    t.write(rows(("2023", 5), ("2024", 6)), "release")
    t.write(rows(), "release")
    assert {(r.release, r.n) for r in t.read().collect()} == {("2022", 1), ("2023", 5), ("a/b=c", 3), (None, 4), ("2024", 6)}


def test_a_table_without_its_keys_is_not_published(spark, tmp_path):
    run = jobs.Run(spark, str(tmp_path / "out"))
    good = spark.createDataFrame([("hip", "x", 1, 2.0), ("knee", "x", 1, 3.0)], "procedure string, cost_basis string, providers int, market_median double")
    run.write("procedure_benchmark", good)
    for bad, told in ((good.unionByName(good.limit(1)), "1 that repeat it"), (good.withColumn("procedure", F.lit(None).cast("string")), "2 rows without it")):
        with pytest.raises(ValueError, match=told):
            run.write("procedure_benchmark", bad)
    assert run.read("procedure_benchmark").count() == 2 and run.report["keys"]["procedure_benchmark"]["repeated"] in (0, 1)


def test_broken_releases_and_absent_costs(spark, tmp_path, files):
    spark.createDataFrame([("1", "326", "2022")], "facility_id string, apr_drg_code string, discharge_year string").write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([(str(k), "326", "2022") for k in range(50)], "facility_id string, apr_drg_code string, discharge_year string").coalesce(1).write.parquet(str(tmp_path / "bad"))
    (part,) = (tmp_path / "bad").glob("part-*.parquet")
    data = bytearray(part.read_bytes())
    data[8 : len(data) // 3] = bytes(len(data) // 3 - 8)  # the footer is whole, so the fault shows only while rows are read
    part.write_bytes(bytes(data))
    for crc in (tmp_path / "bad").glob(".*.crc"):
        crc.unlink()
    loaded, failed = tables.load_discharges(spark, {"g": str(tmp_path / "good"), "b": str(tmp_path / "bad")}, [326], "parquet")
    assert [r.release for r in loaded.collect()] == ["g"] and set(failed) == {"b"}
    with pytest.raises(RuntimeError, match="no costs"):
        jobs.ingest_costs(jobs.Run(spark, str(files / "out")))


def test_what_is_written_in_a_scratch_goes_with_it(spark):
    with session.scratch(spark) as folder:
        kept = session.materialize(spark.range(4), "x")
        assert kept._folder.startswith(folder) and kept.count() == 4
        with session.scratch(spark) as inner:
            assert session.materialize(spark.range(1), "y")._folder.startswith(inner) and inner.startswith(folder)
        assert kept.count() == 4
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and not session.fresh_path(spark, "z").startswith(folder)
