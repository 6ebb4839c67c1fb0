"""Text standardisation and the row change hash."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardized(cols: Iterable[str]) -> dict[str, Column]:
    """``lower(trim(c))`` for each column; trim removes spaces only."""
    return {c: F.lower(F.trim(F.col(c))) for c in cols}


def change_hash(cols: Iterable[str], null_safe: bool = False) -> Column:
    """SHA-256 hex of the ``|``-joined columns.

    The default skips nulls like ``concat_ws`` (so ``(a,null,b)`` and
    ``(a,b,null)`` collide). ``null_safe=True`` length-prefixes every value
    and marks nulls, making the encoding unambiguous.
    """
    cols = list(cols)
    if not null_safe:
        return F.sha2(F.concat_ws("|", *[F.col(c) for c in cols]), 256)
    parts = []
    for c in cols:
        v = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")))
    return F.sha2(F.concat_ws("|", *parts), 256)
