"""The static side of a graph loop: edges keyed by their source vertex.

A loop joins this table with a new frontier every round.  Edges are distributed on the
join key once, at build time, so that a round shuffles only the frontier; hot sources are
cut into slices first, so that the bucket holding a hub is no larger than the others.
Without hot sources there is no slice: a constant one would be optimised out of the join's
keys, and the edges, no longer distributed on them, would move every round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iterweave.operators.skew import SLICE, hot_keys, replicate, spread
from iterweave.workspace import Stored, Workspace


@dataclass(frozen=True)
class Adjacency:
    edges: DataFrame
    source: str
    rows: int
    hot: Stored
    ws: Workspace
    tables: tuple[Stored, ...]

    @staticmethod
    def build(ws: Workspace, edges: DataFrame, source: str) -> Adjacency:
        limits = ws.tuning
        staged = ws.materialize(edges, "edges")
        hot = ws.materialize(hot_keys(staged.df, [source], limits.hot_key_rows), "hot")
        table, keys = staged.df, [source]
        if hot.rows:
            others = [F.col(c) for c in edges.columns if c != source]
            table, keys = spread(table, hot.df, keys, others), [source, SLICE]
        buckets = max(ws.partitions, -(-staged.rows // limits.bucket_rows))
        final = ws.materialize_bucketed(table, "adjacency", buckets, keys)
        ws.discard(staged)
        return Adjacency(final.df, source, staged.rows, hot, ws, (final, hot))

    def out_of(self, frontier: DataFrame, vertex: str) -> DataFrame:
        """Every edge leaving a frontier vertex, with the frontier's other columns."""
        keyed = frontier.withColumnRenamed(vertex, self.source)
        if not self.hot.rows:
            return keyed.join(self.edges, self.source)
        sliced = replicate(keyed, self.hot.df, [self.source])
        return sliced.join(self.edges, [self.source, SLICE]).drop(SLICE)

    def discard(self) -> None:
        """Free the edges once no pending plan reads them."""
        self.ws.discard(*self.tables)
