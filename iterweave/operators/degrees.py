"""Vertex degrees and the one-pass filter built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iterweave.operators.skew import SLICE, hot_keys, replicate, spread
from iterweave.tuning import DEFAULT


def vertex_degree(network: DataFrame) -> DataFrame:
    """(u, degree) of a symmetric edge list."""
    return network.groupBy("u").agg(F.count(F.lit(1)).alias("degree"))


def vertex_degree_in_out(follows: DataFrame) -> DataFrame:
    """(u, degree) of a directed multigraph: edges out plus edges in."""
    ends = follows.select(F.explode(F.array("u", "v")).alias("u"))
    return vertex_degree(ends)


def degree_filter(
    network: DataFrame, k: int, hot_key_rows: int = DEFAULT.hot_key_rows
) -> DataFrame:
    """Edges whose source has degree >= k, decided once on the whole list.

    Only the source side is tested, so survivors keep their degree and a second pass
    would change nothing.  This is not the k-core: see ``plans.cores``.
    """
    kept = vertex_degree(network).filter(F.col("degree") >= k).select("u")
    hot = hot_keys(network, ["u"], hot_key_rows)
    sliced = spread(network, hot, ["u"], [F.col("v")])
    return sliced.join(replicate(kept, hot, ["u"]), ["u", SLICE], "left_semi").select("u", "v")


def graph_size(network: DataFrame) -> DataFrame:
    """One row: vertices and undirected edges of a symmetric edge list."""
    return (
        vertex_degree(network)
        .agg(F.count(F.lit(1)).alias("vertices"), F.sum("degree").alias("ends"))
        .select(
            "vertices", F.coalesce(F.expr("ends div 2"), F.lit(0)).cast("long").alias("edges")
        )
    )
