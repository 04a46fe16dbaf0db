"""k-core subgraphs, core numbers and the sizes of all cores.

Networks are symmetric edge lists (u, v): both directions present, no duplicates, no
self-edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from iterweave.operators.adjacency import Adjacency
from iterweave.operators.orders import Falling, Remaining, Tally
from iterweave.plans.relations import Improving
from iterweave.workspace import Workspace


def kcore_vertices(ws: Workspace, network: DataFrame, k: int) -> DataFrame:
    """(v, degree): vertices of the maximal subgraph with all degrees >= k."""
    degrees, adjacency = _peel(ws, _unit_weights(network), k)
    adjacency.discard()
    return _alive(degrees).toDF("v", "degree")


def kcore_edges(ws: Workspace, network: DataFrame, k: int) -> DataFrame:
    """Edges (u, v) of the k-core, in both directions."""
    degrees, adjacency = _peel(ws, _unit_weights(network), k)
    inside = _induced(_alive(degrees), adjacency)
    return inside.select(F.col("src").alias("u"), F.col("dst").alias("v"))


def kcore_in_out(ws: Workspace, follows: DataFrame, k: int) -> DataFrame:
    """Directed edges (u, v) that survive when degrees count edges in plus edges out.

    Parallel edges count separately; they become the weight of one undirected edge for
    the peeling and appear again in the result.
    """
    edges = ws.materialize(follows.filter(F.col("u") != F.col("v")), "follows").df
    degrees, adjacency = _peel(ws, _both_ways(edges), k)
    adjacency.discard()
    kept = _alive(degrees).select("vertex")
    return edges.join(kept.toDF("u"), "u", "left_semi").join(
        kept.toDF("v"), "v", "left_semi"
    ).select("u", "v")


def _both_ways(edges: DataFrame) -> DataFrame:
    """A directed multigraph as weighted undirected edges, in both directions."""
    ends = edges.select(F.col("u").alias("src"), F.col("v").alias("dst"))
    both = ends.unionByName(ends.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def _unit_weights(network: DataFrame) -> DataFrame:
    return network.select(
        F.col("u").alias("src"), F.col("v").alias("dst"), F.lit(1).cast("long").alias("w")
    )


def _peel(ws: Workspace, weighted: DataFrame, k: int) -> tuple[Improving, Adjacency]:
    """Remove vertices below degree k until none is left.

    Degrees are a base table and the losses of each round.  A round sends messages only from
    the vertices it removes, and writes only the losses of vertices that were still there;
    neither the edges nor the degrees move.
    """
    adjacency = Adjacency.build(ws, weighted, "src")
    fell = F.count_if("fell")
    start = adjacency.edges.groupBy(F.col("src").alias("vertex")).agg(F.sum("w").alias("degree"))
    start = start.withColumn("fell", F.col("degree") < k)
    order = Remaining(["vertex"], "degree", "fell", k)
    degrees = Improving(ws, "degrees", start, order, fell=fell)
    while degrees.metrics["fell"]:
        removed = degrees.delta().filter("fell").select("vertex")
        lost = adjacency.out_of(removed, "vertex").select(
            F.col("dst").alias("vertex"), F.col("w").alias("degree"), F.lit(False).alias("fell")
        )
        degrees.improve(lost, fell=fell)
    return degrees, adjacency


def _alive(degrees: Improving) -> DataFrame:
    """(vertex, degree) of what is left."""
    return degrees.read().filter("not fell").select("vertex", "degree")


def _induced(vertices: DataFrame, adjacency: Adjacency) -> DataFrame:
    """Edges with both ends among the vertices."""
    kept = vertices.select("vertex")
    inside = adjacency.out_of(kept, "vertex").join(kept.toDF("dst"), "dst", "left_semi")
    return inside.select("src", "dst", "w")


def core_numbers(ws: Workspace, network: DataFrame) -> DataFrame:
    """(v, core): the largest k whose k-core contains v.

    Peeling k = 1, 2, 3, ... needs a chain of rounds per k.  Instead every vertex starts
    from its degree and repeatedly takes the largest h such that at least h neighbours
    claim h or more; claims only fall and settle on the core numbers, for all k at once.
    """
    claims, adjacency = _core_numbers(ws, _unit_weights(network))
    adjacency.discard()
    return claims.read().select(F.col("vertex").alias("v"), "core")


def _core_numbers(
    ws: Workspace, weighted: DataFrame, kmin: int = 1, kmax: int | None = None
) -> tuple[Improving, Adjacency]:
    """(vertex, core, was): core numbers, up to ``kmax``, of the vertices in the kmin-core.

    Only that range is worked on: what is outside the kmin-core goes before the first claim,
    and no claim starts above kmax, where it would only fall to a number that is not asked
    for.  Claims are a base table and the falls of each round.

    Beside the claims lies, per vertex, how much its neighbours claim: a tally that the falls
    correct.  Neighbours are asked once, in the first round; after that a vertex that fell tells
    its neighbours, and nothing else moves.
    """
    if kmin > 1:  # every vertex with an edge is in the 1-core
        degrees, adjacency = _peel(ws, weighted, kmin)
        start = _alive(degrees)
    else:
        adjacency = Adjacency.build(ws, weighted, "src")
        start = adjacency.edges.groupBy(F.col("src").alias("vertex")).agg(F.sum("w").alias("degree"))
    first = F.col("degree") if kmax is None else F.least("degree", F.lit(kmax).cast("long"))
    start = start.select("vertex", first.alias("core"), first.alias("was"))
    claims = Improving(ws, "claims", start, Falling(["vertex"], "core", "was"))
    if kmin > 1:
        degrees.discard()
    told = _told(ws, claims.read().select("vertex", "core"), adjacency)
    near = told.join(_own(claims), "vertex")
    near = near.select("vertex", F.least("core", "own").alias("value"), F.col("w").alias("n"))
    support = Improving(ws, "support", near, Tally(["vertex", "value"], "n"), by=["vertex"])
    checked = support.read()  # no claim has been checked yet
    while claims.improve(_supported_claim(checked, _own(claims)).withColumn("was", F.col("core"))):
        if not support.improve(_corrections(_told(ws, claims.delta(), adjacency), _own(claims))):
            break
        hurt = support.delta().select("vertex").distinct()
        checked = support.read().join(hurt, "vertex", "left_semi")
    support.discard()
    return claims, adjacency


def _own(claims: Improving) -> DataFrame:
    return claims.read().select("vertex", F.col("core").alias("own"))


def _told(ws: Workspace, claims: DataFrame, adjacency: Adjacency) -> DataFrame:
    """The columns of ``claims`` with the weight ``w`` of the edge, at the neighbours of their
    vertices, distributed as the claims are.  What a vertex with very many edges is told is
    added up before it gets there."""
    told = adjacency.out_of(claims, "vertex").withColumnRenamed("dst", "vertex").drop("src")
    if adjacency.hot.rows:
        hot = adjacency.hot.df.select(F.col("src").alias("vertex"))
        same = [c for c in told.columns if c != "w"]
        added = told.join(hot, "vertex", "left_semi").groupBy(*same).agg(F.sum("w").alias("w"))
        told = told.join(hot, "vertex", "left_anti").unionByName(added)
    return told.repartition(ws.partitions, "vertex")


def _corrections(told: DataFrame, own: DataFrame) -> DataFrame:
    """(vertex, value, n): what falls from ``was`` to ``core`` change in the tally of a vertex.

    A fall that ends at the vertex's own claim or above changes nothing, and whatever is above
    counts as equal to it: claims only fall, so it is never asked for more."""
    met = told.join(own, "vertex").filter("core < own")
    new = F.struct(F.col("core").alias("value"), F.col("w").alias("n"))
    old = F.struct(F.least("was", "own").alias("value"), (-F.col("w")).alias("n"))
    return met.select("vertex", F.inline(F.array(new, old)))


def _supported_claim(tally: DataFrame, own: DataFrame) -> DataFrame:
    """(vertex, core): the largest h, up to its own claim, that edges to neighbours claiming h
    or more weigh.

    A hub has any number of neighbours, but one row per claimed value, and E edges allow at
    most sqrt(2E) different degrees.
    """
    strongest_first = (
        W.partitionBy("vertex")
        .orderBy(F.desc("core"))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        tally.join(own, "vertex")
        .groupBy("vertex", F.least("value", "own").alias("core"))
        .agg(F.sum("n").alias("n"))
        .withColumn("support", F.sum("n").over(strongest_first))
        .groupBy("vertex")
        .agg(F.max(F.least("core", "support")).alias("core"))
    )


def core_sizes(
    ws: Workspace, network: DataFrame, kmin: int = 1, kmax: int | None = None
) -> DataFrame:
    """(k, vertices, edges) of every non-empty core with kmin <= k <= kmax.

    Cores are nested, so an edge is in all cores up to the smaller core number of its
    ends: two counts per core number, summed from the deepest core outwards.
    """
    claims, adjacency = _core_numbers(ws, _unit_weights(network), kmin, kmax)
    core = claims.read().select("vertex", "core")
    return _nested_sizes(core, _edge_cores(core, adjacency).filter("src < dst"), kmin, kmax)


def core_sizes_in_out(
    ws: Workspace, follows: DataFrame, kmin: int = 1, kmax: int | None = None
) -> DataFrame:
    """(k, vertices, edges) as ``core_sizes``, for directed edges and in + out degrees;
    parallel edges count separately."""
    core, edges = _directed_cores(ws, follows, kmin, kmax)
    return _nested_sizes(core, edges, kmin, kmax)


def core_edges_by_k_in_out(
    ws: Workspace,
    follows: DataFrame,
    kmin: int = 1,
    kmax: int | None = None,
    *,
    runs: bool = False,
) -> DataFrame:
    """(k, u, v): the edges of every in + out core, in their own direction; or, as ``runs``,
    (low, high, u, v): every edge once, with the first and last k of its cores."""
    _, edges = _directed_cores(ws, follows, kmin, kmax)
    return _per_k(edges.toDF("u", "v", "core"), kmin, kmax, runs)


def _directed_cores(
    ws: Workspace, follows: DataFrame, kmin: int, kmax: int | None
) -> tuple[DataFrame, DataFrame]:
    """(vertex, core) and (u, v, core) of a directed multigraph, without self-edges."""
    edges = ws.materialize(follows.filter(F.col("u") != F.col("v")), "follows").df
    claims, adjacency = _core_numbers(ws, _both_ways(edges), kmin, kmax)
    adjacency.discard()
    core = claims.read().select("vertex", "core")
    near, far = core.toDF("u", "near"), core.toDF("v", "far")
    inside = edges.join(near, "u").join(far, "v")
    return core, inside.select("u", "v", F.least("near", "far").alias("core"))


def _nested_sizes(core: DataFrame, edges: DataFrame, kmin: int, kmax: int | None) -> DataFrame:
    vertices = core.groupBy("core").agg(F.count(F.lit(1)).alias("v"))
    edges = edges.groupBy("core").agg(F.count(F.lit(1)).alias("e"))
    per_core = vertices.join(edges, "core", "left").withColumn("e", F.coalesce("e", F.lit(0)))
    # One row per core number from here on.
    outwards = W.orderBy(F.desc("core")).rowsBetween(W.unboundedPreceding, W.currentRow)
    inwards = W.orderBy("core")
    nested = per_core.select(
        "core",
        F.coalesce(F.lag("core").over(inwards) + 1, F.lit(0)).alias("from"),
        F.sum("v").over(outwards).alias("vertices"),
        F.sum("e").over(outwards).alias("edges"),
    )
    low = F.greatest(F.col("from"), F.lit(kmin))
    high = F.col("core") if kmax is None else F.least(F.col("core"), F.lit(kmax))
    return (
        nested.filter(low <= high)
        .select(F.explode(F.sequence(low, high)).alias("k"), "vertices", "edges")
        .select(F.col("k").cast("long").alias("k"), "vertices", "edges")
    )


def core_edges_by_k(
    ws: Workspace,
    network: DataFrame,
    kmin: int = 1,
    kmax: int | None = None,
    *,
    runs: bool = False,
) -> DataFrame:
    """(k, u, v), u < v: the edges of every core with kmin <= k <= kmax; or, as ``runs``,
    (low, high, u, v): every edge once, with the first and last k of its cores."""
    claims, adjacency = _core_numbers(ws, _unit_weights(network), kmin, kmax)
    edges = _edge_cores(claims.read().select("vertex", "core"), adjacency).filter("src < dst")
    return _per_k(edges.toDF("u", "v", "core"), kmin, kmax, runs)


def _per_k(edges: DataFrame, kmin: int, kmax: int | None, runs: bool) -> DataFrame:
    high = F.col("core") if kmax is None else F.least(F.col("core"), F.lit(kmax))
    inside = edges.filter(high >= kmin).select(
        F.lit(kmin).cast("long").alias("low"), high.cast("long").alias("high"), "u", "v"
    )
    return inside if runs else inside.select(F.explode(F.sequence("low", "high")).alias("k"), "u", "v")


def _edge_cores(core: DataFrame, adjacency: Adjacency) -> DataFrame:
    """(src, dst, core): the deepest core that contains each edge."""
    far = core.select(F.col("vertex").alias("dst"), F.col("core").alias("far"))
    return (
        adjacency.out_of(core, "vertex")
        .join(far, "dst")
        .select("src", "dst", F.least("core", "far").alias("core"))
    )
