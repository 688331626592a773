"""The entity index: counts by category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions.entities import category
from tidemark.operators.mentions import mentions


def entity_counts(reports: DataFrame) -> DataFrame:
    """name, count over whole files, repeats included."""
    return mentions(reports, "file", distinct=False).groupBy("name").agg(F.count("*").alias("count"))


def entity_index(counts: DataFrame) -> DataFrame:
    """category, name, count, place, total: companies need two mentions; place is by count, then name; total counts the category.

    Names are numbered within those of one count and beginning, on top of how many stand before these: no task holds a category.
    """
    listed = counts.withColumn("category", category(F.col("name"), "index")).filter(~F.col("category").isin(dims.TAIWAN, dims.INTERNATIONAL) | (F.col("count") >= 2))
    part = ["category", "count", "begins"]
    listed = listed.withColumn("begins", F.left("name", F.lit(3)))
    by = Window.partitionBy("category")
    before = F.coalesce(F.sum("n").over(by.orderBy(F.desc("count"), "begins").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = listed.groupBy(*part).agg(F.count("*").alias("n")).select(*part, before.alias("before"), F.sum("n").over(by).alias("total"))
    at = F.row_number().over(Window.partitionBy(*part).orderBy("name"))
    return listed.withColumn("at", at).join(parts, part).select("category", "name", "count", (F.col("before") + F.col("at")).cast("int").alias("place"), "total")


def shown(index: DataFrame) -> DataFrame:
    """Only what the index page shows: some categories are cut at their top names."""
    limits = F.create_map(*[F.lit(x) for c, _, n in dims.INDEX_SECTIONS if n for x in (c, n)])[F.col("category")]
    return index.filter(limits.isNull() | (F.col("place") <= limits))


def category_totals(counts: DataFrame) -> DataFrame:
    """category, names: listed names of each category and, under null, of all that were counted."""
    listed = entity_index(counts).groupBy("category").agg(F.count("*").alias("names"))
    return listed.unionByName(counts.agg(F.count("*").alias("names")).select(F.lit(None).cast("string").alias("category"), "names"))
