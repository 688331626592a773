"""Small things that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a word is, in every operator.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space as a class.
SPACE_CLASS = r"[\x20\x09-\x0D]"


#: Bytes of a batch that a Python worker gets at a time.
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python are bounded by bytes: texts can be long, so a number of rows says little of a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, else, in local mode only, a new local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes a small table to the shared folder once, so that what follows neither recomputes it nor depends on an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def held_out(remainder: int) -> Column:
    """True for documents whose crc32 of the id as text leaves this remainder modulo 5. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == remainder


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; with a name missing, it says which ones there are."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no column {missing}; there are {df.columns}")
    return df.select(*names)


#: Rows up to which a table of a few numbers a row goes to every executor.
FEW = 500_000


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """The table marked for a broadcast if it has few rows; else it is joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= FEW else df


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The table with its own columns of these names under others, and which ones to rename back."""
    back = {f"own {c}": c for c in names if c in df.columns}
    return df.withColumnsRenamed({c: held for held, c in back.items()}), back
