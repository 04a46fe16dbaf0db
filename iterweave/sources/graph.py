"""Turning vertex and edge tables into the graph a program works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_cutoff_subgraph(papers: DataFrame, citations: DataFrame, cutoff: int) -> DataFrame:
    """Citations of the subgraph induced by the papers with an id below ``cutoff``."""
    kept = papers.filter(F.col("id") < cutoff).select("id")
    low = citations.filter((F.col("p1") < cutoff) & (F.col("p2") < cutoff))
    return low.join(kept.toDF("p1"), "p1", "left_semi").join(
        kept.toDF("p2"), "p2", "left_semi"
    ).select("p1", "p2")


def drop_self_edges(edges: DataFrame, source: str = "p1", target: str = "p2") -> DataFrame:
    return edges.filter(F.col(source) != F.col(target))


def with_implicit_vertices(papers: DataFrame, citations: DataFrame) -> DataFrame:
    """Papers plus every citation endpoint that has no paper row, with year 0."""
    ends = citations.select(F.explode(F.array("p1", "p2")).alias("id")).distinct()
    missing = ends.join(papers, "id", "left_anti").withColumn("year", F.lit(0).cast("long"))
    return papers.select("id", "year").unionByName(missing)


def first_n_seeds(papers: DataFrame, n: int) -> DataFrame:
    """The n papers with the smallest ids."""
    return papers.select("id").orderBy("id").limit(n)


def sample_edges(edges: DataFrame, rate: float, seed: int = 2) -> DataFrame:
    """Bernoulli sample without replacement; repeatable for the same file layout."""
    return edges.sample(False, rate, seed)


def sample_edges_by_hash(edges: DataFrame, rate: float) -> DataFrame:
    """A sample that depends only on the edge itself, whatever the file layout."""
    source, target = edges.columns[:2]
    mark = F.substring(F.md5(F.concat_ws(":", source, target)), 1, 4)
    if rate >= 1:
        return edges
    return edges.filter(mark < F.lit(f"{int(rate * 0x10000):04x}"))


def symmetrize(edges: DataFrame) -> DataFrame:
    """Distinct (u, v) with the reverse of every edge added."""
    out = edges.toDF("u", "v")
    return out.unionByName(out.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
