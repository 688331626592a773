"""The folder that the driver and all executors share, for tables that are written once and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, in local mode only, a new local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table as written once to the shared folder: what reads it neither makes it again nor holds how it was made."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of files and folders, in order; none if the folder is not there."""
    files, path = _files(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def take_name(spark: SparkSession, made: str, name: str) -> bool:
    """Gives what was made its final name in one step. False, and nothing happens, if another writer has taken it."""
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, name).toUri(), spark._jsc.hadoopConfiguration())
    if _files(spark, name).exists(_path(spark, name)):
        return False
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(_path(spark, made), _path(spark, name), options)
    except Exception as failed:
        if "FileAlreadyExists" in str(failed):
            return False
        raise
    return True


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file with that text, whole or not at all; False if there is one of the name."""
    made = f"{path}.{uuid.uuid4().hex}"
    files = _files(spark, path)
    out = files.create(_path(spark, made), False)
    out.write(bytearray(text.encode()))
    out.close()
    if take_name(spark, made, path):
        return True
    files.delete(_path(spark, made), False)
    return False


def get_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value
