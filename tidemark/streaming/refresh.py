"""Reports that arrive one by one: parse as in a batch run, then merge into the snapshot by ticker; and windows over events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.sources.reports import last_wins

REPORTS = "ticker string, company string, sector string, path string, content string"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of report rows that land as Parquet files."""
    return spark.readStream.schema(REPORTS).parquet(folder)


def upserted(snapshot: DataFrame, fresh: DataFrame) -> DataFrame:
    """The snapshot with the fresh rows in place of those of their tickers; the last path wins among fresh ones."""
    new = last_wins(fresh)
    return snapshot.join(new.select("ticker"), "ticker", "left_anti").unionByName(new)


def follow(stream: DataFrame, versions: str, checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into a new version of the snapshot under ``versions/<batch>``.

    A version depends only on the one before and the batch, so a batch that is run again writes the same rows.
    """

    def merge(fresh: DataFrame, batch: int) -> None:
        spark = fresh.sparkSession
        old = spark.read.schema(REPORTS).parquet(f"{versions}/{batch - 1}") if batch else spark.createDataFrame([], REPORTS)
        upserted(old, fresh).write.mode("overwrite").parquet(f"{versions}/{batch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, width: str = "1 day", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """window start, event_type, n, total of values; a stream drops what is later than the watermark, a batch has no such limit."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", late)
    by = F.window("ts", width, slide) if slide else F.window("ts", width)
    return timed.groupBy(by.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """user_id, start, end, n of each run of a user's events with no gap so long."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """A stream of reports with landed_at without those whose path came before, within the time that late rows are waited for. State holds paths for that time."""
    return stream.withWatermark("landed_at", late).dropDuplicatesWithinWatermark(["path", "ticker"])


_CHANGES = "ticker string, company string, sector string, path string, content string"


def newest(stream: DataFrame, number: Column | None = None) -> DataFrame:
    """Of a stream of reports those that come to count for their ticker: of a greater path than any before. State holds a path a ticker, no text.

    number tells reports of one ticker apart, where several companies may have it.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        best = None
        for frame in frames:
            for row in frame.sort_values("path").tail(1).itertuples(index=False):
                if row.path is not None and (last is None or row.path > last):
                    last, best = row.path, row
        if best is not None:
            state.update((last,))
            yield pd.DataFrame([best[:5]], columns=["ticker", "company", "sector", "path", "content"])

    rows = stream.select("ticker", "company", "sector", "path", "content", *([] if number is None else [number.alias("number")]))
    return rows.groupBy(*([] if number is None else ["number"]), "ticker").applyInPandasWithState(run, _CHANGES, "path string", "append", GroupStateTimeout.NoTimeout)


def follow_changes(stream: DataFrame, folder: str, checkpoint: str, late: str = "1 day", number: Column | None = None) -> StreamingQuery:
    """Writes what comes to count, batch by batch, to ``folder/batch=<n>``. A batch costs what it holds, not what came before; run again, it writes the same."""

    def keep(changes: DataFrame, batch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    rows = deduplicated(stream, late) if "landed_at" in stream.columns else stream
    return newest(rows, number).writeStream.foreachBatch(keep).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def followed(spark: SparkSession, folder: str, number: Column | None = None) -> DataFrame:
    """The snapshot that the changes make: of each ticker (and number) that of the last path."""
    return last_wins(spark.read.schema(REPORTS).parquet(f"{folder}/*"), number)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query dropped because they came after the watermark."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
