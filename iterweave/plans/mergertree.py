"""Merger tree of particle groups over integer time steps.

poi(nowGroup, iOrder, timestep, grp): which group a particle is in at a step.
halos(nowGroup, grpID, timeStep, totalParticles): the groups, unique per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.workspace import Workspace

# The columns of the relation of edges.
EDGE = ["nowGroup", "currentTime", "currentGroup", "nextGroup", "sharedParticleCount"]


def significant_halos(halos: DataFrame, min_particles: int = 256) -> DataFrame:
    return halos.filter(F.col("totalParticles") > min_particles)


def max_timestep(halos: DataFrame) -> DataFrame:
    return halos.agg(F.max("timeStep").alias("maxT"))


def halos_with_max_time(halos: DataFrame) -> DataFrame:
    """Every halo with the last time step next to it (a scalar, so no join)."""
    return halos.withColumn("maxT", max_timestep(halos).scalar())


def significant_particles(poi: DataFrame, halos: DataFrame) -> DataFrame:
    """Particles of interest that sit in one of the given halos."""
    keys = halos.select(
        "nowGroup", F.col("grpID").alias("grp"), F.col("timeStep").alias("timestep")
    )
    return poi.join(keys, ["nowGroup", "grp", "timestep"]).select(poi.columns)


def snapshot_transitions(particles: DataFrame) -> DataFrame:
    """Shared-particle counts between groups at t and t+1.

    Particles are dealt out once, by particle; counting their rows per step and group, and
    meeting a step with the next one, both happen within a particle, where they lie.  The next
    step is a window over step numbers, and holds at most the groups of one step; a row stands
    for its repetitions, so counts are multiplied instead of forming all pairs of rows.
    """
    seen = (
        particles.repartition("nowGroup", "iOrder")
        .groupBy("nowGroup", "iOrder", "timestep", "grp")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    steps = Window.partitionBy("nowGroup", "iOrder").orderBy(F.col("timestep").cast("long"))
    follows = F.collect_list(F.struct("grp", "n")).over(steps.rangeBetween(1, 1))
    met = seen.withColumn("follows", follows).withColumn("next", F.explode("follows"))
    return (
        met.groupBy(
            "nowGroup",
            F.col("timestep").alias("currentTime"),
            F.col("grp").alias("currentGroup"),
            F.col("next.grp").alias("nextGroup"),
        )
        .agg(F.sum(F.col("n") * F.col("next.n")).alias("sharedParticleCount"))
        .select(EDGE)
    )


def weighted_edges(transitions: DataFrame, min_shared: int = 256) -> DataFrame:
    return transitions.filter(F.col("sharedParticleCount") > min_shared)


def tree_root_edges(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("currentTime") == 1)


def merger_tree(
    ws: Workspace,
    poi: DataFrame,
    halos: DataFrame,
    *,
    min_particles: int = 256,
    min_shared: int = 256,
    recurse_on: str = "filtered",
) -> DataFrame:
    """Edges reachable from the root step by following nextGroup into the next step.

    ``recurse_on="all"`` starts from the heavy root edges but follows light edges too.

    The edges are written once, one directory per time step; level t reads only its own
    directory and keeps the edges that start in a group the previous level ended in.
    """
    big = significant_halos(halos, min_particles)
    transitions = snapshot_transitions(significant_particles(poi, big))
    return tree_of(ws, transitions, min_shared, recurse_on=recurse_on)


def tree_of(
    ws: Workspace, transitions: DataFrame, min_shared: int, *, recurse_on: str = "filtered"
) -> DataFrame:
    """``merger_tree`` over transitions that are known already."""
    if recurse_on not in ("filtered", "all"):
        raise ValueError(f"recurse_on must be 'filtered' or 'all', not {recurse_on!r}")
    heavy = weighted_edges(transitions, min_shared)
    followed = heavy if recurse_on == "filtered" else transitions
    edges = ws.materialize(
        followed, "transitions", partition_by=["currentTime"], last=F.max("currentTime")
    )
    last = edges.metrics["last"] or 0
    tree = ws.rounds("tree", edges.df.schema)
    rows = tree.append(weighted_edges(tree_root_edges(edges.df), min_shared), 1)["rows"]
    level = 1
    while rows and level < last:
        level += 1
        reached = (
            tree.read(level - 1)
            .select("nowGroup", F.col("nextGroup").alias("currentGroup"))
            .distinct()
        )
        step = edges.df.filter(F.col("currentTime") == level)
        rows = tree.append(step.join(reached, ["nowGroup", "currentGroup"], "left_semi"), level)[
            "rows"
        ]
    return tree.read(1, level).select(EDGE)
