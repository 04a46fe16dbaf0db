"""What it means for a row to be better than the one known for its key.

An order merges rows of the same key, and says what of a found row improves on the known one.
Both are plain aggregates and joins on the key, so on a table that is distributed on the key
they move nothing but the found rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _known(known: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return known.select(*keys, *[F.col(v).alias(f"known_{v}") for v in values])


@dataclass(frozen=True)
class Least:
    """The least row per key, values compared one after the other (negate to prefer more)."""

    keys: Sequence[str]
    values: Sequence[str]

    def merge(self, rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(*self.keys)
        if len(self.values) == 1:  # one number needs no sort
            return grouped.agg(F.min(self.values[0]).alias(self.values[0]))
        best = grouped.agg(F.min(F.struct(*self.values)).alias("best"))
        return best.select(*self.keys, *[f"best.{v}" for v in self.values])

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        """Found rows (one per key) that are better than the known one of their key."""
        met = found.join(_known(known, self.keys, self.values), list(self.keys), "left")
        before = [F.col(f"known_{v}").alias(v) for v in self.values]
        better = F.struct(*self.values) < F.struct(*before)
        return met.filter(before[0].isNull() | better).select(*self.keys, *self.values)


@dataclass(frozen=True)
class LeastSlots:
    """Element-wise least arrays of ``width`` slots per key; an empty slot is null, which any
    number improves.  A gain holds the slots that got better, and nothing else."""

    keys: Sequence[str]
    slots: str
    width: int

    def merge(self, rows: DataFrame) -> DataFrame:
        least = [F.min(F.get(self.slots, F.lit(i))) for i in range(self.width)]
        return rows.groupBy(*self.keys).agg(F.array(*least).alias(self.slots))

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        met = found.join(_known(known, self.keys, [self.slots]), list(self.keys), "left")
        before = F.col(f"known_{self.slots}")
        kind = found.schema[self.slots].dataType
        none = F.array(*[F.lit(None)] * self.width).cast(T.ArrayType(kind.elementType))
        better = F.zip_with(
            self.slots,
            F.coalesce(before, none),
            lambda new, old: F.when(old.isNull() | (new < old), new),
        )
        got = met.select(*self.keys, better.alias(self.slots))
        return got.filter(F.exists(self.slots, lambda slot: slot.isNotNull()))


@dataclass(frozen=True)
class Bits:
    """Bitmaps per key, arrays of ``width`` longs that are united.  A gain holds the bits that
    were not set before, and nothing else."""

    keys: Sequence[str]
    bits: str
    width: int

    def merge(self, rows: DataFrame) -> DataFrame:
        united = [F.bit_or(F.get(self.bits, F.lit(i))) for i in range(self.width)]
        return rows.groupBy(*self.keys).agg(F.array(*united).alias(self.bits))

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        met = found.join(_known(known, self.keys, [self.bits]), list(self.keys), "left")
        none = F.array(*[F.lit(0).cast("long")] * self.width)
        fresh = F.zip_with(
            self.bits,
            F.coalesce(F.col(f"known_{self.bits}"), none),
            lambda new, old: new.bitwiseAND(F.bitwise_not(old)),
        )
        got = met.select(*self.keys, fresh.alias(self.bits))
        return got.filter(F.exists(self.bits, lambda word: word != 0))


@dataclass(frozen=True)
class Falling:
    """A number per key that only falls, next to what it was before it last fell.  Keys that
    are not known are not gained."""

    keys: Sequence[str]
    value: str
    was: str

    def merge(self, rows: DataFrame) -> DataFrame:
        least = F.min(self.value).alias(self.value)
        return rows.groupBy(*self.keys).agg(least).withColumn(self.was, F.col(self.value))

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        before = F.col(f"known_{self.value}")
        met = found.join(_known(known, self.keys, [self.value]), list(self.keys))
        fallen = met.filter(F.col(self.value) < before)
        return fallen.select(*self.keys, self.value, before.alias(self.was))


@dataclass(frozen=True)
class Remaining:
    """A number per key that is counted down; a key is ``gone`` once it is below ``limit``, and
    is not counted any further.  Candidates hold what to take away, gains the negative of it."""

    keys: Sequence[str]
    value: str
    gone: str
    limit: int

    def merge(self, rows: DataFrame) -> DataFrame:
        left = F.sum(self.value).alias(self.value)
        return rows.groupBy(*self.keys).agg(left, F.bool_or(self.gone).alias(self.gone))

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        met = found.join(_known(known, self.keys, [self.value, self.gone]), list(self.keys))
        left = F.col(f"known_{self.value}") - F.col(self.value)
        return met.filter(~F.col(f"known_{self.gone}")).select(
            *self.keys, (-F.col(self.value)).alias(self.value), (left < self.limit).alias(self.gone)
        )


@dataclass(frozen=True)
class Tally:
    """A number per key that is added to and taken from.  A key that is not known is at 0, and
    what adds up to 0 is no row."""

    keys: Sequence[str]
    value: str

    def merge(self, rows: DataFrame) -> DataFrame:
        added = rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))
        return added.filter(F.col(self.value) != 0)

    def gains(self, found: DataFrame, known: DataFrame) -> DataFrame:
        return found


Order = Least | LeastSlots | Bits | Falling | Remaining | Tally
