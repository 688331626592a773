"""Versions of a snapshot of reports: a manifest each, and data by sector that a version shares with those before it.

A version is a small file that tells which runs' data make up each sector. Writing one writes only the sectors that it touches, then puts the
manifest in place in one step. Readers see a version whole or not at all, and old ones stay readable. A run that is repeated, by a retry
or a second writer, finds its name in a manifest and changes nothing; a run that another overtook starts again from the newer version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage


class Overtaken(RuntimeError):
    """Another run has changed a sector that this one read."""


class Versions:
    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def latest(self) -> int:
        """The newest version; 0 before there is one."""
        found = [int(n.removesuffix(".json")) for n in storage.names_in(self.spark, f"{self.root}/manifests") if n.endswith(".json")]
        return max(found, default=0)

    def manifest(self, version: int) -> dict:
        """runs, all that have led to it, and sectors: for each the data that hold it."""
        return json.loads(storage.get_text(self.spark, f"{self.root}/manifests/{version:09d}.json")) if version else {"runs": [], "sectors": {}}

    def read(self, version: int | None = None, sectors: list[str] | None = None) -> DataFrame:
        """The rows of a version, the newest if none is named; of these sectors only. Sectors that are not asked for are not scanned."""
        held: dict[str, list[str]] = {}
        for sector, data in self.manifest(self.latest() if version is None else version)["sectors"].items():
            if sectors is None or sector in sectors:
                for d in data:
                    held.setdefault(d, []).append(sector)
        out = self.spark.createDataFrame([], self.schema)
        for data, of in sorted(held.items()):
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{data}").filter(F.col("sector").isin(of)))
        return out

    def _write(self, rows: DataFrame, run: str) -> tuple[str, list[str]]:
        """The name of the data, new for every attempt, and their sectors."""
        data = f"{run}-{uuid.uuid4().hex}"
        rows.repartitionByRange("sector", "ticker").write.partitionBy("sector").parquet(f"{self.root}/data/{data}")
        found = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{data}").select("sector").distinct()
        return data, sorted(r.sector for r in found.collect())  # a name for each sector

    def _commit(self, run: str, attempt: Callable[[int, dict], dict[str, list[str]]]) -> int:
        """Tries until the manifest behind the newest one is this run's. attempt gives the data of the sectors that it changes."""
        while True:
            base = self.latest()
            old = self.manifest(base)
            if run in old["runs"]:
                return base
            new = {"runs": [*old["runs"], run], "sectors": {**old["sectors"], **attempt(base, old)}}
            if storage.put_text(self.spark, f"{self.root}/manifests/{base + 1:09d}.json", json.dumps(new, ensure_ascii=False)):
                return base + 1

    def overwrite(self, rows: DataFrame, run: str, sectors: list[str] | None = None, based_on: int | None = None) -> int:
        """A version in which the sectors of the rows (and those named, which may be empty now) hold just these rows.

        With based_on, the version that the rows were made of: it is an error if another run has changed one of the sectors since.
        """
        written: list[tuple[str, list[str]]] = []
        before = None if based_on is None else self.manifest(based_on)["sectors"]

        def attempt(base: int, old: dict) -> dict[str, list[str]]:
            if not written:
                written.append(self._write(rows, run))
            data, there = written[0]
            touched = sorted({*there, *(sectors or [])})
            if before is not None and any(old["sectors"].get(s) != before.get(s) for s in touched):
                raise Overtaken(f"{run}: {touched} are not as in version {based_on}")
            return {s: [data] if s in there else [] for s in touched}

        return self._commit(run, attempt)

    def append_new(self, fresh: DataFrame, run: str) -> int:
        """A version with the rows of tickers that are not there yet, one a ticker and sector. What is there is looked up again in the version that it follows."""

        def attempt(base: int, old: dict) -> dict[str, list[str]]:
            data, there = self._write(fresh.join(self.read(base).select("ticker"), "ticker", "left_anti").dropDuplicates(["ticker", "sector"]).select(*self.read(0).columns), run)
            return {s: [*old["sectors"].get(s, []), data] for s in there}

        return self._commit(run, attempt)
