"""The stages of a run as jobs over a folder of tables, and the run that calls them in order.

A job reads the tables it needs from the folder and writes its own, so any of them can be repeated alone. Where
one source of several is bad (a release, a price file, the links of measures), the job goes on and reports it.
"""

from __future__ import annotations

import dataclasses
import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.config import Settings
from valuemark.operators import checks, clinical, linkage, outcomes, pricing, ranking, scoring
from valuemark.session import scratch
from valuemark.sources import prices, sinks, tables
from valuemark.sources.versions import VersionedTable

#: What staging tables look like before anything is loaded.
SCHEMAS = {
    "discharges": ", ".join(f"{c} {'int' if c in tables.INTEGERS else 'string'}" for c in tables.DISCHARGE_FIELDS) + ", release string",
    "costs": ", ".join(f"{c} {'int' if c in tables.INTEGERS else 'decimal(14,2)' if c in tables.MONEY else 'string'}" for c in tables.COST_FIELDS),
    "prices": ", ".join(f"{c} {'double' if c in ('gross', 'cash', 'negotiated', 'least', 'most') else 'string'}" for c in prices.PRICE_COLUMNS),
    "measures": "ccn string, facility_name string, city string, state string, zip_code string, county string, measure_id string, measure_name string, score decimal(10,3), denominator decimal(12,1), compared_to_national string, start_date string, end_date string",
    "links": "provider_id int, certificate string, provider_name string, facility_name string, match_method string, match_score decimal(5,2), reviewed boolean, review_source string",
    "measure_links": "provider_id int, ccn string, provider_name string, facility_name string, match_method string, match_score decimal(5,2), reviewed boolean",
}


@dataclasses.dataclass
class Run:
    """Where a run keeps its tables and what it reads."""

    spark: SparkSession
    folder: str
    settings: Settings = dataclasses.field(default_factory=Settings)
    releases: Mapping[str, str] = dataclasses.field(default_factory=dict)
    release_kind: str = "csv"
    price_files: Mapping[str, str] = dataclasses.field(default_factory=dict)
    costs: str | None = None
    measures: str | None = None
    ratings: str | None = None
    reviewed: str | None = None
    report: dict[str, object] = dataclasses.field(default_factory=dict)

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.folder}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def write(self, name: str, df: DataFrame, partition: str | None = None) -> None:
        """A new version of a table, with its keys checked while it is written; a reader, or a write that dies, has the old one.

        Staging tables keep no empty texts, and a partitioned one replaces the partitions at hand only.
        """
        table, keys = self.table(name), checks.KEYS.get(KEYS_OF.get(name, name))
        clean = sinks.without_empty_texts(df, partition) if name in SCHEMAS else df
        if keys is None:
            table.write(clean, partition)
        else:
            before = table.versions()
            marked, seen = checks.watched(clean, list(keys))
            parts = table.stage(marked)
            self.report.setdefault("keys", {})[name] = seen.get
            checks.settled_keys(seen.get, self.spark.read.parquet(*[f"{table.path}/{p['folder']}" for p in parts]), list(keys))
            table.commit(parts, after=before[-1] if before else 0)
        table.clear()


#: Tables whose keys stand under another name.
KEYS_OF = {"market": "market_benchmark", "scores": "score_table", "outcomes": "provider_outcomes"}


def schema(run: Run) -> None:
    """Empty staging tables where there are none."""
    for name, columns in SCHEMAS.items():
        if not run.table(name).exists():
            run.table(name).write(run.spark.createDataFrame([], columns))


def ingest_discharges(run: Run) -> None:
    loaded, failed = tables.load_discharges(run.spark, run.releases, list(run.settings.procedure_codes), run.release_kind)
    run.report["discharges"] = failed
    if loaded is None:
        raise RuntimeError(f"no release could be loaded: {failed}")
    run.write("discharges", loaded, "release")


def ingest_prices(run: Run) -> None:
    lines, status = prices.load_prices(run.spark, dict(run.price_files), run.settings)
    run.report["prices"] = status
    if lines is None:
        warnings.warn("no price file could be read", stacklevel=2)
    else:
        run.write("prices", lines)


def ingest_costs(run: Run) -> None:
    if not run.costs:
        raise RuntimeError("no costs are given")
    run.write("costs", tables.load_costs(tables.read_text_table(run.spark, run.costs)))


def transform(run: Run) -> None:
    s, rows = run.settings, clinical.cohort(run.read("discharges"), run.settings)
    run.write("cells", clinical.cells(rows))
    run.write("attributes", clinical.provider_attributes(rows))
    run.write("benchmarks", clinical.benchmarks(run.read("cells"), s))
    run.write("provider_metrics", clinical.provider_metrics(run.read("cells"), run.read("benchmarks"), s))
    run.write("procedure_metrics", clinical.procedure_metrics(run.read("cells"), run.read("benchmarks"), s))


def _providers(run: Run) -> DataFrame:
    known = run.read("attributes").select("provider_id", "certificate", "provider_name")
    return run.read("provider_metrics").select("provider_id", F.col("patient_volume").alias("volume")).join(known, "provider_id")


def crosswalk(run: Run) -> None:
    """Proposed links, or the decisions of a reviewed file where the run names one."""
    old = run.read("links")
    if run.reviewed:
        run.write("links", linkage.manual_import(old, sinks.read_reviewed(run.spark, run.reviewed)))
    else:
        run.write("links", linkage.protected_merge(old, linkage.propose(_providers(run), run.read("prices"), old, run.settings)))


def ingest_quality(run: Run) -> None:
    """Measures and ratings, then their links to providers; links that fail leave the measures in place."""
    text = lambda path: tables.read_text_table(run.spark, path)
    parts = [load(text(path)) for path, load in ((run.measures, tables.load_measures), (run.ratings, tables.load_overall_rating)) if path]
    if parts:
        run.write("measures", parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))
    try:
        found = linkage.propose_measure_links(_providers(run), run.read("measures"), run.settings)
        run.write("measure_links", linkage.protected_merge(run.read("measure_links"), found))
    except Exception as e:  # tolerated: scores do not need measures
        run.report["measure_links"] = str(e).splitlines()[0]
        warnings.warn(f"measures are not linked: {run.report['measure_links']}", stacklevel=2)


def score(run: Run) -> None:
    s, links = run.settings, run.read("links")
    run.write("provider_pricing", pricing.provider_pricing(run.read("prices"), s))
    run.write("provider_costs", pricing.provider_costs(run.read("costs"), s))
    run.write("market", pricing.market_benchmark(run.read("provider_pricing"), run.read("provider_costs")))
    run.write("procedure_pricing", pricing.procedure_pricing(run.read("prices"), run.read("costs"), links, s))
    run.write("procedure_benchmark", pricing.procedure_benchmark(run.read("procedure_pricing")))
    run.write("scores", scoring.score_table(run.read("provider_metrics"), run.read("attributes"), links.select("provider_id", "facility_name", "match_method", "match_score", "reviewed"), run.read("provider_pricing"), run.read("provider_costs"), run.read("market"), s))
    run.write("procedure_scores", scoring.procedure_scores(run.read("procedure_metrics"), run.read("procedure_pricing"), run.read("procedure_benchmark"), s))
    run.write("outcomes", outcomes.provider_outcomes(run.read("measure_links"), run.read("measures")))
    run.write("view", ranking.consumer_view(run.read("scores"), run.read("outcomes").drop("ccn")))
    run.write("procedure_view", ranking.procedure_view(run.read("procedure_scores")))


def export(run: Run) -> None:
    run.report["export"] = sinks.export_csv(run.read("view"), f"{run.folder}/export")


def publish(run: Run) -> None:
    run.report["publish"] = sinks.publish(run.read("view"), run.read("procedure_view"), f"{run.folder}/published")


JOBS = {
    "schema": schema, "sparcs": ingest_discharges, "mrf": ingest_prices, "cost": ingest_costs, "transform": transform, "crosswalk": crosswalk,
    "quality": ingest_quality, "score": score, "export": export, "publish": publish,
}


def run_all(run: Run) -> dict[str, object]:
    """Every job in order; what could not be read is in the report. Tables between the steps go with the job."""
    for job in JOBS.values():
        with scratch(run.spark):
            job(run)
    return run.report
