"""Positions in a global or per-group order, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.workspace import Workspace

SLOT_BITS = 33  # monotonically_increasing_id: the partition's number above the row's


def positions(
    ws: Workspace, rows: DataFrame, order: Sequence[str], group: str | None = None
) -> DataFrame:
    """Add ``pos`` (from 0) and ``size``: a row's place by ``order`` and the number of rows,
    among all rows or among those of its ``group`` (a column without nulls).

    Rows are range-partitioned and sorted, so a group of any size spreads over tasks; a row's
    place in its partition plus the counts of the partitions before it is its position.  The
    counts are one row per partition and group in it.
    """
    keys = [group] if group else []
    ranged = rows.repartitionByRange(ws.partitions, *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = ws.materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "ranged").df
    ranged = ranged.withColumn("_part", F.shiftright("_slot", SLOT_BITS))
    counts = ranged.groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first")
    )
    all_of = Window.partitionBy(*(keys or [F.lit(0)]))
    before = all_of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(all_of).alias("size"),
    )
    return (
        ranged.join(offsets, [*keys, "_part"])
        .withColumn("pos", F.col("_slot") + F.col("_shift"))
        .drop("_slot", "_part", "_shift")
    )
