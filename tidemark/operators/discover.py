"""Reverse discovery: which reports mention a term, where, and how to link it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T
from tidemark.sources.reports import in_scope


def discover(reports: DataFrame, term: str, sectors: list[str] | None = None, fold_case: bool = False) -> DataFrame:
    """ticker, company, sector, path, linked, bare, role, contexts of the reports that mention the term before their finance header.

    Sectors are pruned first, and match exactly unless fold_case. An empty term is an error: it would match everywhere.
    """
    if not term:
        raise ValueError("the term is empty")
    rows = in_scope(reports, sectors=sectors, fold_case=fold_case).withColumn("body", T.body(F.col("content")))
    text = F.col("body")
    rows = rows.withColumn("linked", T.linked_count(text, term)).withColumn("bare", T.bare_count(text, term))
    rows = rows.filter((F.col("linked") > 0) | (F.col("bare") > 0))
    role = None
    for section, label, _ in dims.DISCOVERY_ROLES:
        if section:
            hit = T.exact_section(text, dims.SECTION_TITLES[section]).contains(term)
            role = F.when(hit, label) if role is None else role.when(hit, label)
    role = role.otherwise(dims.DISCOVERY_ROLES[-1][1])
    return rows.select("ticker", "company", "sector", "path", "linked", "bare", role.alias("role"), T.snippets(text, term).alias("contexts"))


def discovery_lines(hits: DataFrame) -> DataFrame:
    """role_ord, label, ticker, line, context: the printed report."""
    ords = F.create_map(*[F.lit(x) for i, (_, r, _) in enumerate(dims.DISCOVERY_ROLES) for x in (r, i)])
    labels = F.create_map(*[F.lit(x) for _, r, label in dims.DISCOVERY_ROLES for x in (r, label)])
    note = F.when(F.col("bare") > 0, F.format_string(" (+%d 未標記)", "bare")).otherwise("")
    line = F.concat(F.when(F.col("linked") > 0, "✓").otherwise("○"), F.lit(" "), "ticker", F.lit(" "), "company", F.lit(" ("), "sector", F.lit(")"), note)
    return hits.select(ords[F.col("role")].alias("role_ord"), labels[F.col("role")].alias("label"), "ticker", line.alias("line"), F.get("contexts", F.lit(0)).alias("context"))


def discovery_totals(hits: DataFrame) -> DataFrame:
    """documents, linked_documents, unlinked_documents, bare_mentions."""
    return hits.agg(F.count("*").alias("documents"), F.count_if(F.col("linked") > 0).alias("linked_documents"), F.count_if((F.col("bare") > 0) & (F.col("linked") == 0)).alias("unlinked_documents"), F.coalesce(F.sum("bare"), F.lit(0)).alias("bare_mentions"))


def by_role(hits: DataFrame) -> DataFrame:
    return hits.groupBy("role").agg(F.count("*").alias("documents"), F.sum("bare").alias("bare"))


def link_term(reports: DataFrame, term: str) -> DataFrame:
    """All reports with bare mentions linked, and `applied`, how many were.

    Stricter than the count of bare mentions: none that goes on in a letter. Reports without a finance header stay as they are.
    """
    text, guarded = T.body(F.col("content")), F.col("content").contains(dims.FINANCE_HEADER)
    n = F.when(guarded, T.taggable_count(text, term)).otherwise(0)
    new = F.when(n > 0, F.concat(T.tag_mentions(text, term), T.finance(F.col("content")))).otherwise(F.col("content"))
    return reports.withColumn("applied", n).withColumn("content", new)
