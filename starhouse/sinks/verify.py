"""Verification of a write by content: what was written is what is read back.

A frame's fingerprint is its row count with the sum and the exclusive or of its rows' 64-bit hashes, so the order
of rows and files doesn't matter, while a changed, lost or repeated row does. The writer's own is taken by an
Observation while the rows are written, so they aren't computed twice; only the read-back is a pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    total: int
    mixed: int


class ContentMismatch(ValueError):
    """A target doesn't hold what was written to it."""


def _parts(columns: list[str]) -> list:
    h = F.xxhash64(*columns)
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(h).alias("mixed")]


def _of(values: dict) -> Fingerprint:
    return Fingerprint(values["rows"], int(values["total"] or 0), values["mixed"] or 0)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> Fingerprint:
    return _of(df.agg(*_parts(columns or df.columns)).first().asDict())


class Watched:
    """A frame whose fingerprint is known once it has been written."""

    def __init__(self, df: DataFrame):
        self.columns = df.columns
        self._seen = Observation()
        self.df = df.observe(self._seen, *_parts(df.columns))

    @property
    def fingerprint(self) -> Fingerprint:
        return _of(self._seen.get)


def verify(written: Fingerprint, back: DataFrame, columns: list[str], what: str = "target") -> Fingerprint:
    """The read-back's fingerprint over ``columns`` (the written ones, in their order); raises if it differs."""
    found = fingerprint(back.select(*columns))
    if found != written:
        raise ContentMismatch(f"{what}: wrote {written}, read {found}")
    return found
