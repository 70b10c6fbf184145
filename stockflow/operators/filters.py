"""Rows that may have one of many keys, told by a table of bits that every task holds, so that a join with the keys shuffles these rows alone.

A key sets the bit of its hash. Rows whose bit is not set have none of the keys for certain; the others, a few too many, are joined exactly. The table has a bounded
size, however many keys there are: more keys only let more rows through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.lake import materialise

#: Bits of a table at most (64 MB), and for each key as long as that allows; and those of one of Spark's bitmaps.
MOST_BITS, BITS_OF_KEY, BITMAP = 2**29, 32, 2**15


class KeyBits:
    """The bits of a set of keys. ``names`` are its columns; rows are looked up by expressions of the same types in the same order."""

    def __init__(self, keys: DataFrame, names: Sequence[str]):
        self.n_bits = min(MOST_BITS, max(BITMAP, BITS_OF_KEY * keys.count()))
        bit = self.bit([F.col(k) for k in names])
        placed = keys.select(F.bitmap_bucket_number(bit).alias("_bucket"), F.bitmap_bit_position(bit).alias("_at"))
        # Shuffled as numbers: bitmaps of each map task would be far larger.
        bitmaps = placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
        self.bitmaps = materialise(bitmaps, "key-bits")

    def bit(self, key: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(self.n_bits).cast("long"))

    def flag(self, rows: DataFrame, key: Sequence[Column], name: str) -> DataFrame:
        """Add a column that is true where a row may have one of the keys."""
        bit = self.bit(key)
        at = F.bitmap_bit_position(bit)
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        held = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
        met = rows.join(F.broadcast(self.bitmaps), F.bitmap_bucket_number(bit) == F.col("_bucket"), "left")
        return met.select(*rows.columns, held.alias(name))


def split(rows: DataFrame, key: Sequence[Column], keys: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of ``keys``, and those that have none. ``keys`` is read twice and should be stored."""
    flagged = KeyBits(keys, names).flag(rows, key, "_may")
    return flagged.where("_may").drop("_may"), flagged.where("NOT _may").drop("_may")


def without(rows: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Anti join by columns that both sides have in the same types; ``keys`` should be stored.

    Of the rows that pass the bits only the keys are joined with the keys; the few that passed by chance are then looked up in the same way.
    """
    key = [F.col(k) for k in names]
    may, others = split(rows, key, keys, names)
    spared = materialise(may.select(*names).join(keys.select(*names), list(names), "left_anti"), "spared")
    if spared.isEmpty():
        return others
    kept, _ = split(may, key, spared, names)
    same = F.lit(True)
    for k in names:  # a NULL has no match among the keys and is spared
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return others.unionByName(kept.join(spared.select(*[F.col(k).alias(f"_{k}") for k in names]), same, "left_semi").select(*rows.columns))
