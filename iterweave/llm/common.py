"""What the operators share: word patterns, row keys, input checks, materialised columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Whitespace-separated words, for Java's and RE2's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    Neighbouring projections are merged by the optimizer, which would repeat the
    expression for every use, and for every element when the use is inside a lambda.
    A generator is never merged away.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it, also
    from inside other lambdas.  Unlike ``once`` it adds no operator to the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(data: bytes | None) -> list[bytes]:
    """The whitespace-separated words of UTF-8 text, A-Z lower-cased: bytes methods treat
    exactly the ASCII letters and the six ASCII whitespace characters."""
    return data.lower().split() if data else []


def two_word_shingles(words: list[bytes]) -> set:
    """Distinct pairs of neighbouring words; a single word is its own only shingle."""
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else set(words)


def shingles(words: list[bytes], width: int) -> set:
    """Distinct runs of ``width`` words; fewer words are their own only shingle."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))
