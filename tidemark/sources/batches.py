"""The batch catalogue: ``- [x] **Batch N** (Sector): t1, t2``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"^\s*- \[(.)\]\s*\*\*Batch\s+(\d+)\*\*(?:\s*\((.*?)\))?[^:]*:[ \t]*(.*)$"


def parse_batches(lines: DataFrame) -> DataFrame:
    """batch_no, completed, sector, ticker, ord of every listed ticker; lines are read one by one, an empty list has no rows."""
    part = lambda i: F.regexp_extract("value", LINE, i)
    rows = lines.filter(F.col("value").rlike(LINE)).select(part(2).cast("int").alias("batch_no"), (part(1) == "x").alias("completed"), part(3).alias("sector"), F.posexplode(F.regexp_extract_all(part(4), F.lit(r"\d{4}"), F.lit(0))).alias("ord", "ticker"))
    return rows.select("batch_no", "completed", "sector", "ticker", "ord")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return parse_batches(spark.read.text(path))


def batch_tickers(batches: DataFrame, number: int) -> DataFrame:
    return batches.filter(F.col("batch_no") == number).orderBy("ord").select("ticker")


def completed(batches: DataFrame) -> DataFrame:
    return batches.filter("completed")
