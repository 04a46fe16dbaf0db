"""Column expressions shared by the programs.  All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_id_order(one: Column, other: Column) -> Column:
    """Two structs with a field ``id`` as (low, high): the smaller id first."""
    as_is = F.struct(one.alias("low"), other.alias("high"))
    swapped = F.struct(other.alias("low"), one.alias("high"))
    return F.when(one["id"] < other["id"], as_is).otherwise(swapped)


def greater(a: Column, b: Column) -> Column:
    """Larger of two values; an unreachable (NULL) depth makes the result NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def one_hop_further(depth: Column) -> Column:
    """Depth after one more hop; unreachable (NULL) stays unreachable."""
    return depth + F.lit(1).cast("long")


def all_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")
