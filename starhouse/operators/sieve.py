"""A bitmap of a batch's keys, to keep rows that can't match out of a join with a large table.

Each key sets one of ``bits`` bits by its hash. The bitmap is a small table (64 bits a row, one row at most for
each 64 bits), so its size is bounded whatever the batch holds, and it is broadcast. A row whose bit isn't
set has no partner; one whose bit is set may have one (two keys can share a bit), so the join still
decides. A batch with many more keys than bits lets more rows pass, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^24 bits are at most 262,144 rows of 16 bytes.
SIEVE_BITS = 1 << 24
#: The largest bitmap that `bits_for` gives: a million rows of 16 bytes.
MOST_BITS = 1 << 26


def _place(key: str, bits: int) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.shiftright(bit, 6), F.pmod(bit, F.lit(64)).cast("int")


def bitmap(batch: DataFrame, key: str, bits: int = SIEVE_BITS) -> DataFrame:
    """``(_word, _mask)``: the bits that the batch's keys set."""
    word, at = _place(key, bits)
    return batch.where(F.col(key).isNotNull()).select(word.alias("_word"), at.alias("_at")) \
        .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))


def bits_for(keys: int) -> int:
    """Bits of which about an eighth are set by ``keys`` keys, within bounds."""
    return min(MOST_BITS, max(1 << 16, 1 << (8 * keys).bit_length()))


def sifted(table: DataFrame, batch: DataFrame, key: str, bits: int = SIEVE_BITS) -> DataFrame:
    """Rows of ``table`` whose key may be among the batch's keys."""
    return sifted_by(table, bitmap(batch, key, bits), key, bits)


def sifted_by(table: DataFrame, marks: DataFrame, key: str, bits: int) -> DataFrame:
    """Rows of ``table`` whose key may be among those of the bitmap ``marks``."""
    word, at = _place(key, bits)
    marked = table.withColumns({"_w": word, "_at": at}).join(F.broadcast(marks), F.col("_w") == F.col("_word"))
    return marked.where(F.expr("(_mask & shiftleft(1L, _at)) <> 0")).select(*table.columns)
