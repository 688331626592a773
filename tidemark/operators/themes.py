"""Thematic screens: an entity's companies by supply-chain role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T
from tidemark.operators.mentions import scoped_text


def entries(reports: DataFrame) -> DataFrame:
    """name, ticker, company, sector, role: each name that a report's sections link to, once."""
    rows = scoped_text(reports, "sections").withColumn("chain", T.loose_section(F.col("content"), dims.SECTION_TITLES["supply_chain"]))
    rows = rows.select("ticker", "company", "sector", "chain", F.explode(F.array_distinct(T.mentions(F.col("scoped")))).alias("name"))
    return rows.select("name", "ticker", "company", "sector", T.role(F.col("chain"), F.col("name")).alias("role"))


def theme_entries(entry: DataFrame, themes: DataFrame, tag: str | None = None) -> DataFrame:
    """tag and the entries of each theme, of one if it is named; an unknown one is an error."""
    if tag is not None:
        if tag not in {t for t, *_ in dims.THEMES}:
            raise ValueError(f"no theme {tag}")
        themes = themes.filter(F.col("tag") == tag)
    return themes.select("tag").join(entry, F.col("tag") == F.col("name")).select("tag", "ticker", "company", "sector", "role")


def theme_sizes(found: DataFrame) -> DataFrame:
    """tag, companies, and how many in each role."""
    roles = [F.count_if(F.col("role") == r).alias(r) for r, _ in dims.ROLE_TITLES]
    return found.groupBy("tag").agg(F.count("*").alias("companies"), *roles)


def related(entry: DataFrame, themes: DataFrame) -> DataFrame:
    """tag, pos, related, companies: a theme's related names that occur, in its order."""
    counts = entry.groupBy(F.col("name").alias("related")).agg(F.count("*").alias("companies"))
    listed = themes.select("tag", F.posexplode("related").alias("pos", "related"))
    return listed.join(counts, "related").select("tag", "pos", "related", "companies")


def theme_index(sizes: DataFrame, groups: DataFrame) -> DataFrame:
    """ord, group, pos, tag, companies of the themes built; a group without any keeps one row of nulls."""
    flat = groups.select("ord", "group", F.posexplode("tags").alias("pos", "tag"))
    built = flat.join(sizes.select("tag", "companies"), "tag").select("ord", "pos", "tag", "companies")
    return groups.select("ord", "group").join(built, "ord", "left")
