"""The engine's stages as functions over the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from valuemark.operators import clinical, outcomes, pricing, ranking, scoring
from valuemark.plans import binding as B
from valuemark.session import materialize

S = B.SETTINGS


#: Written once, since several later stages read them: each is one pass over a large table.
WRITTEN = {"cells", "attributes", "costs", "provider_pricing", "provider_costs", "procedure_pricing", "scores"}
#: Made of several of the tables that lines give: these lines are joined once and written, a few columns wide.
SEVERAL = {"market", "procedure_pricing", "procedure_scores", "scores"}
#: Tables of all procedures, also of those that the cohort leaves out.
BY_PROCEDURE = {"procedure_pricing", "procedure_benchmark", "procedure_scores"}


class Stages:
    """Tables of one data set, built when first asked for.

    Whatever reads a large table and is read again is written, so that no plan scans a large table more than
    once for each stage that needs it. With ``counted``, the procedures that are asked for, the lines written are those that
    count for these: discharges and prices lack the rows that neither the cohort nor a target has, costs the years before the last.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, counted: tuple[int, ...] | None = None):
        self.spark, self.sf_dir, self._held, self._written, self._counted = spark, sf_dir, {}, None, counted

    def shared(self) -> Stages:
        """The same, with lines and suppliers written, unless no more than one of the tables that they give is still to be made."""
        if self._written is None and len({"discharges", "prices", "costs"} - set(self._held)) > 1:
            lines = B.lines(self.spark, self.sf_dir) if self._counted is None else B.counted_lines(self.spark, self.sf_dir, self._counted)
            self._written = materialize(lines, "lines-joined"), materialize(B.suppliers(self.spark, self.sf_dir), "suppliers", short=True)
        return self

    def joined(self) -> B.Joined:
        return self._written or (B.lines(self.spark, self.sf_dir), B.suppliers(self.spark, self.sf_dir))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BUILD:
            raise AttributeError(name)
        if name not in self._held:
            if name in BY_PROCEDURE and self._counted is not None and not {*B.CODES} <= {*self._counted}:
                raise ValueError(f"{name} is of all procedures")
            if name in SEVERAL:
                self.shared()
            built = BUILD[name](self)
            self._held[name] = materialize(built, name) if name in WRITTEN else built
        return self._held[name]


BUILD = {
    "discharges": lambda t: B.discharges(t.spark, t.joined()),
    "prices": lambda t: B.prices(t.spark, t.joined()),
    "costs": lambda t: B.costs(t.spark, t.joined(), t._counted),
    "links": lambda t: B.links(t.spark, t.sf_dir),
    "measures": lambda t: B.measures(t.spark, t.sf_dir),
    "cohort": lambda t: clinical.cohort(t.discharges, S),
    "cells": lambda t: clinical.cells(t.cohort),
    "benchmarks": lambda t: clinical.benchmarks(t.cells, S),
    "provider_metrics": lambda t: clinical.provider_metrics(t.cells, t.benchmarks, S),
    "procedure_metrics": lambda t: clinical.procedure_metrics(t.cells, t.benchmarks, S),
    "attributes": lambda t: clinical.provider_attributes(t.cohort),
    "provider_pricing": lambda t: pricing.provider_pricing(t.prices, S, written=t._written is not None),
    "provider_costs": lambda t: pricing.provider_costs(t.costs, S),
    "market": lambda t: pricing.market_benchmark(t.provider_pricing, t.provider_costs),
    "procedure_pricing": lambda t: pricing.procedure_pricing(t.prices, t.costs, t.links, S),
    "procedure_benchmark": lambda t: pricing.procedure_benchmark(t.procedure_pricing),
    "scores": lambda t: scoring.score_table(t.provider_metrics, t.attributes.drop("_"), t.links.drop("provider_name", "ccn"), t.provider_pricing, t.provider_costs, t.market, S),
    "procedure_scores": lambda t: scoring.procedure_scores(t.procedure_metrics, t.procedure_pricing, t.procedure_benchmark, S),
    "outcomes": lambda t: outcomes.provider_outcomes(t.links, t.measures),
    "view": lambda t: ranking.consumer_view(t.scores),
    "procedure_view": lambda t: ranking.procedure_view(t.procedure_scores),
}
