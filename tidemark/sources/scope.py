"""What a run covers, from command-line words."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark import dims
from tidemark.sources import batches as B
from tidemark.sources.reports import in_scope


@dataclass(frozen=True)
class Scope:
    """A batch, a sector, tickers, or everything."""

    batch: int | None = None
    sector: str | None = None
    tickers: tuple[str, ...] | None = None

    def select(self, reports: DataFrame, batches: DataFrame | None = None) -> DataFrame:
        if self.batch is not None:
            if batches is None:
                raise ValueError("a batch needs the catalogue")
            return reports.join(B.batch_tickers(batches, self.batch), "ticker", "left_semi")
        return in_scope(reports, self.tickers, [self.sector] if self.sector else None)


def parse_scope(words: list[str]) -> Scope:
    """``--batch N``, ``--sector name with blanks``, tickers of four digits (other words are ignored), or nothing for all."""
    if not words:
        return Scope()
    if words[0] == "--batch":
        return Scope(batch=int(words[1]))
    if words[0] == "--sector":
        return Scope(sector=" ".join(words[1:]))
    return Scope(tickers=tuple(w for w in words if re.fullmatch(r"\d{4}", w)))


def profile_of(term: str) -> str:
    """The search profile that a term suggests."""
    return next((p for p, words in dims.PROFILE_WORDS if any(w in term for w in words)), "all")


def profile_sectors(profile: str) -> list[str] | None:
    groups = dims.PROFILES[profile]
    return None if groups is None else sorted({s for g in groups for s in dims.SECTOR_GROUPS[g]})
