"""From a snapshot of reports to all its derived tables, and on after a term was linked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark import storage
from tidemark.operators import discover as D
from tidemark.plans import generations as N


def rebuild(spark: SparkSession, reports: DataFrame, min_weight: int = 5, top: int | None = None, root: str | None = None, number: Column | None = None) -> dict[str, DataFrame]:
    """index, totals, nodes, edges, theme_entries, theme_sizes, theme_related, theme_index, from a new generation. The texts are scanned once. number: as in `generations.parsed`."""
    return N.derived(N.first_generation(spark, reports, root or storage.new_folder(spark, "generations"), number), min_weight, top)


def link_and_rebuild(spark: SparkSession, reports: DataFrame, term: str, sectors: list[str] | None = None, min_weight: int = 5, root: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """The hits of a term, the reports with it linked where it was found, and what is derived from them.

    With a root that holds a generation of the reports only those that were changed are parsed again.
    """
    hits = D.discover(reports, term, sectors)
    changed = D.link_term(reports, term)
    if sectors is not None:
        changed = D.link_term(reports.filter(reports.sector.isin(sectors)), term).unionByName(reports.filter(~reports.sector.isin(sectors)).selectExpr("*", "0 as applied"))
    if root and N.latest(spark, root):
        made = N.derived(N.next_generation(spark, root, changed.filter("applied > 0").drop("applied")), min_weight)
    else:
        made = rebuild(spark, changed.drop("applied"), min_weight, root=root)
    return hits, changed, made
