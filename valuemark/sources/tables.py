"""Loaders whose source columns drift between releases: candidate names, text in, typed columns out."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from valuemark.functions import scalars as S
from valuemark.operators.outcomes import MEASURES
from valuemark.session import materialize

# Candidate source names of each column, the first with a value wins.
DISCHARGE_FIELDS = {
    "provider_id": ("permanent_facility_id", "facility_id", "permanent_facility_identifier"),
    "certificate": ("operating_certificate_number",),
    "provider_name": ("facility_name", "hospital_name"),
    "county": ("hospital_county", "county"),
    "area": ("hospital_service_area", "health_service_area"),
    "zip3": ("zip_code_3_digits", "zip_code_3_digit", "zip_code"),
    "age_group": ("age_group",),
    "admission": ("type_of_admission",),
    "procedure_code": ("apr_drg_code",),
    "procedure_description": ("apr_drg_description",),
    "severity": ("apr_severity_of_illness_code",),
    "risk": ("apr_risk_of_mortality",),
    "los_raw": ("length_of_stay",),
    "disposition": ("patient_disposition",),
    "year": ("discharge_year",),
}
COST_FIELDS = {
    "provider_id": ("pfi", "permanent_facility_id", "facility_id"),
    "facility_name": ("facility_name", "hospital_name"),
    "procedure_code": ("apr_drg_code",),
    "procedure_description": ("apr_drg_description",),
    "severity": ("apr_severity_of_illness_code",),
    "medical_surgical": ("apr_medical_surgical_code",),
    "discharges": ("discharges",),
    "mean_charge": ("mean_charge",),
    "median_charge": ("median_charge",),
    "mean_cost": ("mean_cost",),
    "median_cost": ("median_cost",),
    "year": ("year", "discharge_year"),
}
INTEGERS = {"provider_id", "procedure_code", "severity", "year", "discharges"}
MONEY = {"mean_charge", "median_charge", "mean_cost", "median_cost"}


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[S.clean_header(c) for c in df.columns])


def reconcile(df: DataFrame, fields: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Target columns from whichever candidates are present; a missing one is null."""

    def column(name: str, candidates: tuple[str, ...]) -> Column:
        there = [S.blank_to_null(F.col(f"`{c}`").cast("string")) for c in candidates if c in df.columns]
        text = F.coalesce(*there) if there else F.lit(None).cast("string")
        return (S.as_int(text) if name in INTEGERS else S.as_number(text).cast("decimal(14,2)") if name in MONEY else text).alias(name)

    return df.select(*[column(n, c) for n, c in fields.items()])


def read_text_table(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """Every column as text; CSV headers are cleaned."""
    if kind == "csv":
        return clean_columns(spark.read.csv(path, header=True, inferSchema=False, multiLine=False, escape='"'))
    if kind == "json":
        return clean_columns(spark.read.option("primitivesAsString", True).json(path))
    return clean_columns(spark.read.parquet(path))


def filter_codes(df: DataFrame, column: str, codes: list[int]) -> DataFrame:
    """Rows with one of the codes: as text if that finds any, else as numbers; none at all is an error."""
    for keep in (F.col(column).cast("string").isin(*[str(c) for c in codes]), S.as_int(F.col(column).cast("string")).isin(*codes)):
        found = df.filter(keep)
        if not found.isEmpty():
            return found
    raise ValueError(f"no row of {column} has one of {sorted(codes)}")


def capped(df: DataFrame, limit: int | None) -> DataFrame:
    """An explicit record limit, with a warning where it cuts."""
    if limit is None:
        return df
    if df.limit(limit + 1).count() > limit:
        warnings.warn(f"the load is cut at {limit} rows", stacklevel=2)
    return df.limit(limit)


def load_releases(spark: SparkSession, releases: Mapping[str, str], read: Callable[[SparkSession, str], DataFrame]) -> tuple[DataFrame | None, dict[str, str]]:
    """Good releases stacked, with their label; failing ones reported.

    Each release is read to its end and written by itself, so one whose files turn out to be broken while they are read
    fails alone.
    """
    parts, failed = [], {}
    for label, path in releases.items():
        try:
            parts.append(materialize(read(spark, path).withColumn("release", F.lit(label)), "release"))
        except Exception as e:  # one release must not stop the others
            failed[label] = str(e).splitlines()[0]
    whole = None
    for p in parts:
        whole = p if whole is None else whole.unionByName(p, allowMissingColumns=True)
    return whole, failed


def load_discharges(spark: SparkSession, releases: Mapping[str, str], codes: list[int], kind: str = "csv", limit: int | None = None) -> tuple[DataFrame | None, dict[str, str]]:
    def read(session: SparkSession, path: str) -> DataFrame:
        return reconcile(capped(filter_codes(read_text_table(session, path, kind), "apr_drg_code", codes), limit), DISCHARGE_FIELDS)

    return load_releases(spark, releases, read)


def load_costs(raw: DataFrame, codes: list[int] | None = None) -> DataFrame:
    """Cost rows of joint replacements: a code filter that can be pushed down, then the description confirms."""
    raw = raw.filter(F.col("apr_drg_code").cast("string").isin(*[str(c) for c in codes])) if codes else raw
    rows = reconcile(raw, COST_FIELDS)
    return rows.filter(F.col("procedure_description").rlike(S.JOINT_DESCRIPTION) & F.col("provider_id").isNotNull())


def load_measures(raw: DataFrame, state: str | None = None, measures: list[str] | None = None) -> DataFrame:
    """Long outcome measures; suppressed cells are null, rows without a CCN go."""
    text = lambda c, n=None: (F.substring(S.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))), 1, n) if n else S.strip(F.coalesce(F.col(c).cast("string"), F.lit("")))) if c in raw.columns else F.lit("")
    number = lambda c: S.sentinel_number(F.col(c).cast("string")) if c in raw.columns else F.lit(None).cast("double")
    rows = raw.select(
        text("facility_id").alias("ccn"), text("facility_name").alias("facility_name"), text("citytown").alias("city"), text("state").alias("state"), text("zip_code").alias("zip_code"), text("countyparish").alias("county"),
        text("measure_id").alias("measure_id"), text("measure_name", 300).alias("measure_name"), number("score").cast("decimal(10,3)").alias("score"), number("denominator").cast("decimal(12,1)").alias("denominator"),
        text("compared_to_national", 120).alias("compared_to_national"), text("start_date", 32).alias("start_date"), text("end_date", 32).alias("end_date"),
    )
    keep = (F.col("ccn") != "") & F.col("measure_id").isin(*(measures or list(MEASURES)))
    return rows.filter(keep & (F.col("state") == state) if state else keep)


def load_overall_rating(raw: DataFrame, state: str | None = None) -> DataFrame:
    """A wide attribute as rows of a measure; ownership stands in compared_to_national."""
    shaped = raw.select(
        *[c for c in ("facility_id", "facility_name", "citytown", "state", "zip_code", "countyparish") if c in raw.columns],
        F.lit("CMS_OVERALL_RATING").alias("measure_id"), F.lit("CMS overall hospital rating (1-5 stars)").alias("measure_name"), F.col("hospital_overall_rating").alias("score"), F.col("hospital_ownership").alias("compared_to_national"),
    )
    return load_measures(shaped, state, ["CMS_OVERALL_RATING"]).filter("score IS NOT NULL")
