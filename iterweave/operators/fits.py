"""Run-time analytics: elapsed times from log lines and scaling fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the line format of a shell timing report, "real <m>m<s>s".
REAL_TIME = r"^real\s+([0-9]+)m([0-9.]+)s"


def timing_lines(lines: DataFrame) -> DataFrame:
    """(run_id, seconds) of the lines that report elapsed time."""
    minutes = F.regexp_extract("line", REAL_TIME, 1).try_cast("double")
    seconds = F.regexp_extract("line", REAL_TIME, 2).try_cast("double")
    total = minutes * F.lit(60.0) + seconds
    return lines.select("run_id", total.alias("seconds")).filter(F.col("seconds").isNotNull())


def seconds_to_minutes(seconds: Column) -> Column:
    return seconds / F.lit(60.0)


def _fit(df: DataFrame, y: Column, basis: Column, by: Sequence[str]) -> DataFrame:
    y, basis = y.cast("double"), basis.cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(y, basis).alias("a"), F.regr_intercept(y, basis).alias("b")
    )


def fit_inverse(df: DataFrame, x: str, y: Column, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares a, b of y = a/x + b; linear in a and b, so one aggregate pass.

    Rows with x = 0 have no place on the curve and are left out."""
    return _fit(df, y, F.try_divide(F.lit(1.0), F.col(x).cast("double")), by)


def fit_quadratic(df: DataFrame, x: str, y: Column, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares a, b of y = a*x^2 + b."""
    return _fit(df, y, F.col(x).cast("double") * F.col(x).cast("double"), by)
