"""Markdown reports: one row a file."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import text as T
from tidemark.storage import names_in

#: How strictly a file must be named: any .md, a ticker in front, a ticker and "_", or sector folder, ticker and company.
NAMES = {"any": r"\.md$", "prefix": r"/\d{4}[^/]*\.md$", "ticker": r"/\d{4}_[^/]*\.md$", "report": r"/[^/]+/\d{4}_[^/]+\.md$"}


def _path() -> Column:
    """The file's path, decoded; a plus sign is itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def named(files: DataFrame, names: str = "report") -> DataFrame:
    """ticker, company, sector, path, content of the files (path, content) that are named so. The path is the key's source, not line 1."""
    return files.filter(F.col("path").rlike(NAMES[names])).select(
        F.nullif(F.regexp_extract("path", r"/(\d{4})[^/]*\.md$", 1), F.lit("")).alias("ticker"),
        F.nullif(F.regexp_extract("path", r"/\d{4}_([^/]+)\.md$", 1), F.lit("")).alias("company"),
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("sector"),
        "path",
        "content",
    )


def read_reports(spark: SparkSession, root: str, names: str = "report") -> DataFrame:
    """The reports among the files under the root. Spark lists no empty files, so these are none. What only asks for paths reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(root)
    return named(files.select(_path().alias("path"), F.col("content").cast("string").alias("content")), names)


#: Bytes of texts that a task passes on at once.
_READ = 4 << 20


def found_reports(spark: SparkSession, root: str, names: str = "report") -> DataFrame:
    """As `read_reports`, of files in the folders right under a root that all executors reach: tasks list the folders, one each, and read the files. The driver holds names of folders only."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                files, path = fs.FileSystem.from_uri(root)
                found = files.get_file_info(fs.FileSelector(f"{path}/{folder}"))
                for i in range(0, len(found), 10_000):
                    there = [f.path for f in found[i : i + 10_000] if f.type == fs.FileType.File and f.size and f.base_name.endswith(".md") and f.base_name[0] not in "._"]
                    yield pa.RecordBatch.from_arrays([pa.array(there, pa.string())], names=["path"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = fs.FileSystem.from_uri(root)[0]
        give = lambda paths, texts: pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "content"])
        for batch in batches:
            paths, texts, size = [], [], 0
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(path) as held:
                    raw = held.read()
                paths.append(path)
                texts.append(raw.decode("utf-8", "replace"))
                size += len(raw)
                if size > _READ:
                    yield give(paths, texts)
                    paths, texts, size = [], [], 0
            yield give(paths, texts)

    folders = [(n,) for n in names_in(spark, root)]
    paths = spark.createDataFrame(folders, "folder string").repartition(max(len(folders), 1)).mapInArrow(listed, "path string")
    return named(paths.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(read, "path string, content string"), names)


def last_wins(reports: DataFrame, number: Column | None = None) -> DataFrame:
    """One report a ticker: that of the last path. Only tickers and paths are compared; a report without either is not taken.

    number tells reports of one ticker apart, where several companies may have it.
    """
    rows = reports if number is None else reports.withColumn("_number", number)
    by = ["ticker"] if number is None else ["ticker", "_number"]
    last = rows.groupBy(*by).agg(F.max("path").alias("path"))
    return rows.join(last, [*by, "path"], "left_semi").select(*reports.columns)


def in_scope(reports: DataFrame, tickers: Iterable[str] | None = None, sectors: Iterable[str] | None = None, fold_case: bool = True) -> DataFrame:
    """Only these tickers and sectors; None is all. Sectors match in any case unless told otherwise."""
    if tickers is not None:
        reports = reports.filter(F.col("ticker").isin(list(tickers)))
    if sectors is not None:
        reports = reports.filter(F.lower("sector").isin([s.lower() for s in sectors]) if fold_case else F.col("sector").isin(list(sectors)))
    return reports


def parse_reports(reports: DataFrame) -> DataFrame:
    """Adds body, finance, the three exact sections and the metadata values."""
    content = F.col("content")
    out = reports.withColumn("body", T.body(content)).withColumn("finance", T.finance(content))
    for name, title in dims.SECTION_TITLES.items():
        out = out.withColumn(name, T.exact_section(F.col("body"), title))
    return out.withColumns(
        {
            "meta_sector": T.metadata(content, "板塊"),
            "meta_industry": T.metadata(content, "產業"),
            "market_cap_m": T.amount(T.metadata(content, "市值")),
            "ev_m": T.amount(T.metadata(content, "企業價值")),
        }
    )


def write_snapshot(reports: DataFrame, folder: str) -> None:
    """A new version of all reports as Parquet by sector, so that later scans skip sectors. A hot sector is written by many tasks."""
    reports.repartitionByRange("sector", "ticker").write.mode("errorifexists").partitionBy("sector").parquet(folder)


def write_bucketed(reports: DataFrame, name: str, buckets: int, folder: str | None = None) -> None:
    """A snapshot as a table in buckets by ticker: joins by ticker with it move the other side only."""
    writer = reports.repartition(buckets, "ticker").write.format("parquet").bucketBy(buckets, "ticker").sortBy("ticker").mode("errorifexists")
    (writer.option("path", folder) if folder else writer).saveAsTable(name)


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)
