"""Relational steps of the ancestor query, usable on their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from iterweave.functions.expressions import greater, in_id_order
from iterweave.operators.adjacency import Adjacency
from iterweave.operators.skew import pair_join
from iterweave.sources.graph import drop_self_edges
from iterweave.tuning import DEFAULT
from iterweave.workspace import Workspace


def temporal_citations(citations: DataFrame, papers: DataFrame) -> DataFrame:
    """Citations whose two papers are known and whose cited paper is not the newer one."""
    p = papers.select(F.col("id").alias("p1"), F.col("year").alias("y1"))
    q = papers.select(F.col("id").alias("p2"), F.col("year").alias("y2"))
    return (
        citations.join(p, "p1").join(q, "p2").filter(F.col("y1") >= F.col("y2")).select("p1", "p2")
    )


def canonical_citations(citations: DataFrame, papers: DataFrame) -> DataFrame:
    """Distinct temporal citations without self-citations."""
    return temporal_citations(drop_self_edges(citations), papers).distinct()


def rank_papers(papers: DataFrame, year_order: str = "oldest") -> DataFrame:
    """(id, year, rank): ranks increase with (year, id), or with falling year.

    After the range-partitioned sort, row ids grow along the sort order across all
    partitions, so no single task has to number the rows.
    """
    if year_order not in ("oldest", "newest"):
        raise ValueError(f"year_order must be 'oldest' or 'newest', not {year_order!r}")
    year = F.col("year").asc() if year_order == "oldest" else F.col("year").desc()
    return (
        papers.select("id", "year")
        .orderBy(year, "id")
        .withColumn("rank", F.monotonically_increasing_id())
    )


def rank_links(citations: DataFrame, ranked: DataFrame, temporal_filter: bool) -> DataFrame:
    """Distinct links (src, dst) in rank space; both papers must be known."""
    p = ranked.select(F.col("id").alias("p1"), F.col("year").alias("y1"), F.col("rank").alias("src"))
    q = ranked.select(F.col("id").alias("p2"), F.col("year").alias("y2"), F.col("rank").alias("dst"))
    known = drop_self_edges(citations).join(p, "p1").join(q, "p2")
    if temporal_filter:
        known = known.filter(F.col("y1") >= F.col("y2"))
    return known.select("src", "dst").distinct()


def seed_neighbors(citations: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, vertex, d=1): what the seeds cite directly."""
    return citations.join(seeds.toDF("p1"), "p1").select(
        F.col("p1").alias("seed"), F.col("p2").alias("vertex"), F.lit(1).cast("long").alias("d")
    )


def two_hop_distinct(ws: Workspace, citations: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, vertex) pairs two citation hops apart.

    A much cited paper meets its own citations in slices."""
    adjacency = Adjacency.build(ws, citations.toDF("src", "dst"), "src")
    second = adjacency.out_of(seed_neighbors(citations, seeds).select("seed", "vertex"), "vertex")
    return second.select("seed", F.col("dst").alias("vertex")).distinct()


def new_pairs(found: DataFrame, known: DataFrame) -> DataFrame:
    """Set difference: found pairs that are not known yet."""
    return found.select("seed", "vertex").join(known, ["seed", "vertex"], "left_anti").distinct()


def common_ancestors(
    reach: DataFrame,
    papers: DataFrame,
    pairs: DataFrame | None = None,
    block_rows: int = DEFAULT.pair_block_rows,
) -> DataFrame:
    """(p1, p2, ca, year, d1, d2) for every ancestor shared by two seeds, p1 < p2.

    Without ``pairs`` these are all pairs, met at the vertex in blocks; the years join before
    the pairs are formed.  ``pairs`` (p1, p2) asks for some only, and each costs its own
    ancestors, not the square of a vertex's seeds."""
    a = reach.select(F.col("seed").alias("p1"), "vertex", F.col("d").alias("d1"))
    b = reach.select(F.col("seed").alias("p2"), "vertex", F.col("d").alias("d2"))
    year = papers.select(F.col("id").alias("vertex"), "year")
    if pairs is None:
        met = pair_join(a.join(year, "vertex"), b, "vertex", "p2", block_rows)
        met = met.filter(F.col("p1") < F.col("p2"))
    else:
        asked = pairs.select("p1", "p2").filter(F.col("p1") < F.col("p2")).distinct()
        met = asked.join(a, "p1").join(b, ["p2", "vertex"]).join(year, "vertex")
    return met.select("p1", "p2", F.col("vertex").alias("ca"), "year", "d1", "d2")


def pair_depth(common: DataFrame) -> DataFrame:
    """(p1, p2, ca, depth): the larger of an ancestor's two distances."""
    return common.select("p1", "p2", "ca", greater(F.col("d1"), F.col("d2")).alias("depth"))


def meeting(s1: Column, d1: Column, s2: Column, d2: Column) -> list[Column]:
    """(p1, p2, d1, d2): two seeds that met, and their distances, in id order."""
    side = [F.struct(s.alias("id"), d.alias("d")) for s, d in ((s1, d1), (s2, d2))]
    ordered = in_id_order(*side)
    return [
        ordered[end][field].alias(name)
        for field, names in (("id", ("p1", "p2")), ("d", ("d1", "d2")))
        for end, name in zip(("low", "high"), names, strict=True)
    ]


def oriented_meetings(
    delta: DataFrame,
    reach: DataFrame,
    pairs: DataFrame | None = None,
    block_rows: int = DEFAULT.pair_block_rows,
) -> DataFrame:
    """Meetings of newly reached rows with all reached rows of other seeds (with ``pairs``, of
    a stated partner), whichever of the two is new, with the pair put in id order:
    (p1, p2, ca, d1, d2), each once.

    Two rows that are both new and reached would meet twice; they meet from the smaller seed
    only, so the meetings need no comparison among themselves."""
    new, old = F.col("new"), F.col("old")
    held = [
        df.select("vertex", "seed", "d", F.lit(i == 0).alias("new"), F.lit(i == 1).alias("old"))
        for i, df in enumerate((delta, reach))
    ]
    seen = held[0].unionByName(held[1]).groupBy("vertex", "seed", "d")
    seen = seen.agg(F.bool_or(new).alias("new"), F.bool_or(old).alias("old"))
    one = seen.filter(new).select("vertex", F.col("seed").alias("s1"), F.col("d").alias("e1"), old)
    two = seen.filter(old).select("vertex", F.col("seed").alias("s2"), F.col("d").alias("e2"), new)
    s1, s2 = F.col("s1"), F.col("s2")
    if pairs is None:
        met = pair_join(one, two, "vertex", "s2", block_rows).filter(s1 != s2)
    else:
        ends = pairs.select("p1", "p2")
        both = ends.union(ends.select("p2", "p1")).toDF("s1", "s2").filter("s1 <> s2").distinct()
        met = one.join(both, "s1").join(two, ["s2", "vertex"])
    once = met.filter(~(new & old) | (s1 < s2))
    sides = meeting(s1, F.col("e1"), s2, F.col("e2"))
    return once.select(*sides, F.col("vertex").alias("ca"))
