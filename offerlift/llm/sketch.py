"""A bounded sketch of a set of keys, to leave out rows before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One bit per slot; as words of 64 bits the sketch has at most 131,072 rows.
SLOTS = 1 << 23


def mark_possible(rows: DataFrame, key: str, members: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean ``name``: false only where ``key`` is no key of ``members``.

    ``members`` has the keys in a column of the same name. They set bits of a
    sketch of fixed size, which is broadcast. With more members than slots more
    rows are marked than need be; no row is lost.
    """

    def slot() -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(SLOTS))

    def bit(of: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (of % 64).cast("int"))

    words = members.select(slot().alias("slot"))
    words = words.groupBy((F.col("slot") / 64).cast("int").alias("__word")).agg(
        F.bit_or(bit(F.col("slot"))).alias("__bits")
    )
    marked = rows.withColumn("__slot", slot())
    marked = marked.join(
        F.broadcast(words), (F.col("__slot") / 64).cast("int") == F.col("__word"), "left"
    )
    hit = F.coalesce(F.col("__bits").bitwiseAND(bit(F.col("__slot"))) != 0, F.lit(False))
    return marked.withColumn(name, hit).drop("__slot", "__word", "__bits")
