"""Joins that survive a key holding a large share of all rows.

Lookups of a big table in a table with unique keys are left to adaptive execution,
which splits oversized shuffle partitions.  Two cases need more, because there is no
oversized *partition* to see: a join against a pre-distributed (bucketed) table, which
has no shuffle to split, and a self-join, where a modest number of rows under one key
multiplies into a huge number of pairs.  Both use the slices defined here.

Every key above the slice size is in the table of slices, however many there are; it is
joined like any other table, so its size needs no bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iterweave.tuning import DEFAULT

SLICE = "slice"
SLICES = "slices"


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_slice: int = DEFAULT.hot_key_rows
) -> DataFrame:
    """(keys, slices) for every key with more than ``rows_per_slice`` rows."""
    n = F.col("n")
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(n > rows_per_slice)
        .select(*keys, F.ceil(n / F.lit(rows_per_slice)).cast("long").alias(SLICES))
    )


def spread(df: DataFrame, hot: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """Give every row one slice of its key: 0 for ordinary keys."""
    slices = F.coalesce(F.col(SLICES), F.lit(1).cast("long"))
    return (
        df.join(hot, list(keys), "left")
        .withColumn(SLICE, F.pmod(F.xxhash64(*by), slices))
        .drop(SLICES)
    )


def replicate(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every row all slices of its key: one copy for ordinary keys."""
    last = F.coalesce(F.col(SLICES), F.lit(1).cast("long")) - F.lit(1).cast("long")
    return (
        df.join(hot, list(keys), "left")
        .withColumn(SLICE, F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .drop(SLICES)
    )


def pair_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    block_rows: int = DEFAULT.pair_block_rows,
) -> DataFrame:
    """Join two sides that may both hold many rows per key.

    ``right`` is cut into blocks per hot key and ``left`` meets every block, so one
    task forms at most (left rows of the key) x ``block_rows`` pairs.
    """
    hot = hot_keys(right, [key], block_rows)
    return replicate(left, hot, [key]).join(
        spread(right, hot, [key], [F.col(spread_by)]), [key, SLICE]
    ).drop(SLICE)
