"""Command line: ``python -m tidemark <command> --reports DIR [...]``. Results are shown, or written with --out."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import dims, sinks
from tidemark.operators import audit as A
from tidemark.operators import discover as D
from tidemark.operators import graph as G
from tidemark.operators import index as I
from tidemark.operators import rewrite as W
from tidemark.operators import statements as S
from tidemark.operators import themes as TH
from tidemark.operators import valuation as V
from tidemark.operators.layout import layout
from tidemark.operators.mentions import mentions
from tidemark.sources import batches as B
from tidemark.sources import landing as L
from tidemark.sources.patches import read_patches
from tidemark.sources.reports import last_wins, read_reports
from tidemark.sources.scope import parse_scope, profile_of, profile_sectors


def _show(df: DataFrame) -> None:
    """All rows, a partition on the driver at a time."""
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v) for v in row))


def _snapshot(df: DataFrame, out: str | None) -> None:
    """A new snapshot, or with no folder named (a dry run) how it would go."""
    if "status" in df.columns:
        _show(W.outcomes(df))
    if out:
        df.select("ticker", "company", "sector", "path", "content").write.mode("errorifexists").partitionBy("sector").parquet(out)


def index(spark: SparkSession, a: argparse.Namespace) -> None:
    reports = read_reports(spark, a.reports, "any")
    counts = I.entity_counts(reports)
    totals = {r.category: r.names for r in I.category_totals(counts).collect()}
    page = sinks.index_page(I.entity_index(counts), totals[None], read_reports(spark, a.reports).count())
    if a.out:
        sinks.write_text(page, "page", a.out)
    _show(I.category_totals(counts))


def graph(spark: SparkSession, a: argparse.Namespace) -> None:
    m = mentions(last_wins(read_reports(spark, a.reports, "prefix")), "body")
    f = G.document_frequency(m)
    e = G.edges(m, G.kept_names(f, a.top), a.min_weight)
    n = G.nodes(f, e)
    if a.out:
        text = sinks.graph_json(n, e)
        sinks.write_text(text, "value", f"{a.out}/json")
        # The page holds the whole graph, which thresholds have made small; so it may hold the places too.
        places = {r.id: (r.x, r.y) for r in layout(n, e).collect()}
        page = sinks.graph_page(text.first().value, least=a.min_weight, places=places)
        sinks.write_text(spark.createDataFrame([(page,)], "page string"), "page", f"{a.out}/html")
    _show(G.scales(n, e))


def themes(spark: SparkSession, a: argparse.Namespace) -> None:
    entry, listed = TH.entries(read_reports(spark, a.reports)), dims.themes(spark)
    found = TH.theme_entries(entry, listed, a.theme)
    sizes = TH.theme_sizes(found)
    if a.out:
        sinks.theme_pages(found, TH.related(entry, listed), listed).write.mode("overwrite").partitionBy("tag").parquet(f"{a.out}/pages")
        sinks.write_text(sinks.theme_index_page(TH.theme_index(sizes, dims.theme_groups(spark))), "page", f"{a.out}/index")
    _show(sizes.orderBy("tag"))


def discover(spark: SparkSession, a: argparse.Namespace) -> None:
    reports = read_reports(spark, a.reports)
    sectors = profile_sectors(profile_of(a.term)) if a.smart else a.sectors
    hits = D.discover(reports, a.term, sectors)
    _show(D.discovery_lines(hits).orderBy("role_ord", "ticker").drop("role_ord"))
    _show(D.discovery_totals(hits))
    if a.hits:
        hits.write.mode("errorifexists").parquet(a.hits)
    if a.out:
        _snapshot(D.link_term(reports.join(hits.select("path"), "path", "left_semi"), a.term).unionByName(reports.join(hits.select("path"), "path", "left_anti").withColumn("applied", F.lit(0))), a.out)


def audit(spark: SparkSession, a: argparse.Namespace) -> None:
    checked = A.audit(last_wins(read_reports(spark, a.reports, "prefix")))
    if not a.catalogue:
        _show(checked.select("ticker", "bucket", "issues").orderBy("ticker"))
        return
    batches = B.read_batches(spark, a.catalogue)
    batches = B.completed(batches) if a.batch is None else batches.filter(F.col("batch_no") == a.batch)
    found = A.audit_batches(batches, checked)
    _show(A.batch_scores(found, count_missing=a.batch is not None).orderBy("batch_no"))
    _show(A.batch_lists(found).filter("bucket <> 'CLEAN'").orderBy("batch_no", "bucket"))


def _scoped(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """Reports in scope, and the others."""
    reports = last_wins(read_reports(spark, a.reports, "ticker"))
    inside = parse_scope(a.scope).select(reports, B.read_batches(spark, a.catalogue) if a.catalogue else None)
    return inside, reports.join(inside.select("ticker"), "ticker", "left_anti").withColumn("status", F.lit("out of scope"))


def enrich(spark: SparkSession, a: argparse.Namespace) -> None:
    inside, rest = _scoped(spark, a)
    _snapshot(W.enrich(inside, read_patches(spark, a.patches)).unionByName(rest), a.out)


def _blocks(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    info = spark.read.schema(L.INFO).parquet(a.info)
    return V.blocks(L.first_suffix(info, "currentPrice <> 0"), F.lit(a.day).cast("date") if a.day else F.current_date())


def valuation(spark: SparkSession, a: argparse.Namespace) -> None:
    inside, rest = _scoped(spark, a)
    _snapshot(W.refresh_valuation(inside, _blocks(spark, a)).unionByName(rest), a.out)


def financials(spark: SparkSession, a: argparse.Namespace) -> None:
    inside, rest = _scoped(spark, a)
    landed = L.first_suffix(spark.read.schema(L.STATEMENTS).parquet(a.statements), "statement = 'income'")
    printed = S.rendered(S.latest_periods(S.metrics(S.wide(landed))))
    blocks = _blocks(spark, a)
    _snapshot(W.refresh_finance(inside, S.finance_sections(printed, blocks), blocks).unionByName(rest), a.out)


def main(argv: list[str]) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(run, **options) -> None:
        c = commands.add_parser(run.__name__)
        c.add_argument("--reports", required=True)
        c.add_argument("--out")
        for name, how in options.items():
            c.add_argument(("" if how.pop("plain", False) else "--") + name.replace("_", "-"), **how)
        c.set_defaults(run=run)

    scope = {"scope": {"plain": True, "nargs": argparse.REMAINDER}, "catalogue": {}}
    command(index)
    command(graph, min_weight={"type": int, "default": 5}, top={"type": int})
    command(themes, theme={})
    command(discover, term={"plain": True}, smart={"action": "store_true"}, sectors={"nargs": "*"}, hits={})
    command(audit, catalogue={}, batch={"type": int})
    command(enrich, patches={"required": True}, **{k: dict(v) for k, v in scope.items()})
    command(valuation, info={"required": True}, day={}, **{k: dict(v) for k, v in scope.items()})
    command(financials, info={"required": True}, statements={"required": True}, day={}, **{k: dict(v) for k, v in scope.items()})
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    a.run(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
