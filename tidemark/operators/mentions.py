"""Who mentions whom: the table that index, graph and themes share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T


def scoped_text(reports: DataFrame, scope: str) -> DataFrame:
    """Adds `scoped`: the `file`, its `body` before finance, or its loose `sections`."""
    content = F.col("content")
    if scope == "file":
        return reports.withColumn("scoped", content)
    if scope == "body":
        return reports.withColumn("scoped", T.body(content))
    if scope == "sections":
        return reports.withColumn("scoped", F.concat(*[T.loose_section(content, t) for t in dims.SECTION_TITLES.values()]))
    raise ValueError(f"no scope {scope}")


def mentions(reports: DataFrame, scope: str = "body", distinct: bool = True) -> DataFrame:
    """ticker, sector, name: each linked name of each report, once or as often as it occurs."""
    names = T.mentions(F.col("scoped"))
    return scoped_text(reports, scope).select("ticker", "sector", F.explode(F.array_distinct(names) if distinct else names).alias("name"))
