"""Top-n, row numbers and running totals over a global order.

A window without PARTITION BY sends every row to one task. Here the rows are
range-partitioned by the order instead, numbered inside their partition, and
shifted by the size of the partitions before. Range bounds come from a sample,
so the placed rows are written to reliable storage before anything depends on
where a row landed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerlift.sources.workspace import materialize

_POSITION = "__position"
_PART = "__part"
# monotonically_increasing_id keeps the partition number above these bits.
_PART_SHIFT = 33


def peek(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def latest_n(
    df: DataFrame, n: int, time_col: str, key: str, day_col: str | None = None
) -> DataFrame:
    """The ``n`` newest rows, ties broken by ``key``.

    The oldest time that can still make the cut is found first, from as little
    data as possible, and then filters the scan: the time column alone is read,
    or, where ``day_col`` names a partition column that rises with it and is null
    only where it is, nothing but the number of rows per day. Either way the
    remaining columns are read for the newest rows only.
    """
    if day_col is None:
        newest = df.select(time_col).orderBy(F.desc_nulls_last(time_col)).limit(n)
        bound, column = newest.agg(F.min(time_col)).first()[0], time_col
    else:
        newer = Window.orderBy(F.desc(day_col)).rowsBetween(Window.unboundedPreceding, -1)
        days = df.where(F.col(day_col).isNotNull()).groupBy(day_col).count()
        days = days.withColumn("newer", F.coalesce(F.sum("count").over(newer), F.lit(0)))
        bound, column = days.where(F.col("newer") < n).agg(F.min(day_col)).first()[0], day_col
    if bound is not None:
        bound = F.lit(bound).cast(df.schema[column].dataType)
        # Rows without a time rank last, so they stay candidates.
        df = df.where((F.col(column) >= bound) | F.col(column).isNull())
    return df.orderBy(F.desc_nulls_last(time_col), key).limit(n)


def _added_up(column: pa.Array, start) -> pa.Array:
    if pa.types.is_decimal(column.type):  # Arrow has no running sum of these
        return pa.array(list(accumulate(column.to_pylist(), initial=start))[1:], column.type)
    return pc.add_checked(pc.cumulative_sum_checked(column), pa.scalar(start, column.type))


def _place(
    df: DataFrame, order: Sequence[Column | str], running: Sequence[str] = ()
) -> DataFrame:
    """Rows in order, with a position; ``running`` columns become sums inside a partition."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = dict.fromkeys(running, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            for name in running:
                at = batch.schema.get_field_index(name)
                column = _added_up(batch.column(at), sums[name])
                batch = batch.set_column(at, batch.schema.field(at), column)
                sums[name] = column[-1].as_py()
            yield batch

    placed = df.orderBy(*order).withColumn(_POSITION, F.monotonically_increasing_id())
    if running:
        placed = placed.mapInArrow(add_up, placed.schema)
    return materialize(placed).withColumn(_PART, F.shiftright(_POSITION, _PART_SHIFT))


def with_row_index(
    df: DataFrame,
    order_by: Sequence[Column | str],
    group_by: Sequence[str] = (),
    name: str = "row_index",
) -> DataFrame:
    """1-based position of each row in the order, or in its group's order.

    A group larger than one partition is spread over several, so a hot group
    costs no more than its share of the rows.
    """
    placed = _place(df, [*group_by, *order_by])
    keys = [_PART, *group_by]
    before = Window.partitionBy(*group_by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        placed.groupBy(*keys)
        .agg(F.count("*").alias("__rows"), F.min(_POSITION).alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .drop("__rows")
        .toDF(*[f"__p_{k}" for k in keys], "__first", "__before")
    )
    if not group_by:
        pieces = F.broadcast(pieces)  # one row per partition of the sort
    on = [F.col(k).eqNullSafe(F.col(f"__p_{k}")) for k in keys]
    numbered = placed.join(pieces, on)
    index = F.col("__before") + F.col(_POSITION) - F.col("__first") + 1
    return numbered.select(*df.columns, index.cast("bigint").alias(name))


def with_running_totals(
    df: DataFrame, order_by: Sequence[Column | str], totals: Mapping[str, str]
) -> DataFrame:
    """Running sums, current row included; ``totals`` maps new name to column.

    Each running sum ``x`` comes with the sum over all rows, ``x_total``. A null
    adds nothing. The tasks that hold the sorted rows sum inside their partition
    before the rows are written, so nothing is shuffled after the sort but one row
    per partition.
    """
    kinds = df.agg(*[F.sum(c).alias(name) for name, c in totals.items()]).schema
    inside = {
        f"__l_{name}": F.coalesce(F.col(c), F.lit(0)).cast(kinds[name].dataType)
        for name, c in totals.items()
    }
    placed = _place(df.withColumns(inside), order_by, list(inside))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    everything = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = placed.groupBy(F.col(_PART).alias("__p")).agg(
        *[F.max_by(f"__l_{name}", _POSITION).alias(f"__s_{name}") for name in totals]
    )
    # One row per partition of the sort, hence the single-task window and the broadcast.
    pieces = pieces.select(
        "__p",
        *[
            F.coalesce(F.sum(f"__s_{name}").over(before), F.lit(0)).alias(f"__b_{name}")
            for name in totals
        ],
        *[F.sum(f"__s_{name}").over(everything).alias(f"{name}_total") for name in totals],
    )
    joined = placed.join(F.broadcast(pieces), F.col(_PART) == F.col("__p"))
    return joined.select(
        *df.columns,
        *[(F.col(f"__b_{name}") + F.col(f"__l_{name}")).alias(name) for name in totals],
        *[f"{name}_total" for name in totals],
    )
