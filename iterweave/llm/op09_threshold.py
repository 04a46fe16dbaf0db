"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are integers here: floor(1024 * x) by component.  Per block of candidates, each
dimension has a list of the block's vectors sorted by that component.  For a query the
lists are read from the end that favours it (highest components first where the query's
component is positive, lowest first where it is negative, not at all where it is zero).
Every vector met is scored in full.  After each step the values at the depth reached bound
the score of every vector not yet met; the search stops when that bound is *below* the
k-th score found (on equality an unmet vector could still win the tie by its smaller id).

Candidates are cut into blocks of bounded size by hash.  Where a block is searched, its rows
come first in their partition and the queries stream past: a block is sorted once for a whole
group of queries, and a task holds one block and one batch.  It is the queries, few beside the
candidates, that are copied to the blocks.  How many partitions the searches are dealt to
follows the cluster, not the product of both sides.

Every query searches one block first.  Its k-th score there is a floor: searches of the
other blocks stop once their bound is below it, and return what reaches it.  The findings are
merged by a window that is limited before the shuffle.

Defined results: vectors that are null, or hold null or non-finite components, take no
part; shorter vectors count as padded with zeros; repeated rows (same id and vector) count
once; rows with the query's id are its own and no candidates; a query without candidates
has no rows; rows without an id take no part; empty tables give an empty result; other
columns are ignored.  Floors outside the range of a long saturate, as do scores.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.workspace import Workspace

K = 10
SCALE = 1024
EVERY = 100  # queries are the ids divisible by this
CANDIDATES = 8192  # per block, on average
QUERIES = 65_536  # that stream past a block in one go, on average
FIRST_DEPTH = 16
TASKS_A_PARTITION = 4  # tasks for each of the cluster's shuffle partitions, at most


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector): floor(1024 * x), distinct."""
    unusable = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return (
        table.filter("vec_id is not null and embedding is not null")
        .filter(~unusable)
        .select(F.col("vec_id").cast("long"), scaled.alias("vector"))
        .distinct()
    )


def _width(column: pa.Array) -> int:
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list<long> array, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = column.flatten().to_numpy()
    return out


class Block:
    """Candidates with their lists: ``order[:, d]`` sorts them by component d."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.largest = int(np.abs(vectors).max(initial=0))
        self.floats = vectors.astype(np.float64)

    @staticmethod
    def of(parts: list[pa.RecordBatch]) -> Block:
        width = max(_width(p.column("vector")) for p in parts)
        ids = [p.column("vec_id").to_numpy() for p in parts]
        return Block(np.concatenate(ids), np.vstack([_matrix(p.column("vector"), width) for p in parts]))

    def top(
        self, query_id: int, query: np.ndarray, k: int, floor: int | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """The best ids and scores, and how many vectors were scored; with a ``floor`` only
        those that reach it."""
        vectors = self.vectors
        bound_of_sum = self.largest * int(np.abs(query).max(initial=0)) * max(len(query), 1)
        if bound_of_sum < 2**53:  # exact in floating point, which is faster
            vectors, query = self.floats, query.astype(np.float64)
        elif bound_of_sum >= 2**63:
            vectors, query = vectors.astype(object), query.astype(object)
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, query.dtype)
        depth, step, scored = 0, FIRST_DEPTH, 0
        while depth < n:
            until = min(n, depth + step)
            if len(up) or len(down):
                reached = np.concatenate(
                    [self.order[n - until : n - depth, up].ravel(), self.order[depth:until, down].ravel()]
                )
            else:
                reached, until = np.arange(n), n  # every score is zero
            fresh = np.zeros(n, bool)
            fresh[reached] = True
            new = np.flatnonzero(fresh & ~met)
            met |= fresh
            new = new[self.ids[new] != query_id]
            scored += len(new)
            if len(new):
                ids = np.concatenate([ids, self.ids[new]])
                scores = np.concatenate([scores, vectors[new] @ query])
                if len(ids) > k:  # drop what is below the k-th score before sorting
                    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                    ids, scores = ids[scores >= kth], scores[scores >= kth]
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            depth, step = until, step * 2
            if depth >= n or met.all():
                break
            if len(ids) == k or floor is not None:
                high = vectors[self.order[n - depth, up], up] @ query[up] if len(up) else 0
                low = vectors[self.order[depth - 1, down], down] @ query[down] if len(down) else 0
                if len(ids) == k and high + low < scores[-1]:
                    break
                if floor is not None and high + low < floor:
                    break
        if floor is not None:
            ids, scores = ids[scores >= floor], scores[scores >= floor]
        if scores.dtype == object:
            scores = np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in scores], np.int64)
        return ids, scores.astype(np.int64), scored


LEAST = -(2**63)  # a score that saturated is no floor
FOUND = "query_id long, query_key binary, ids array<long>, scores array<long>"


def _answers(block: Block, asked: pa.RecordBatch, k: int, first: bool) -> pa.RecordBatch:
    """One row per query with what the block has for it; on its first search, also what the
    further ones need."""
    ids, column = asked.column("vec_id").to_numpy(), asked.column("vector")
    width = block.vectors.shape[1]
    whole = _matrix(column, max(width, _width(column)))  # no candidate here is longer than width
    floors = asked.column("floor").to_pylist()
    found = [
        block.top(i, row[:width], k, floor)[:2] for i, row, floor in zip(ids, whole, floors, strict=True)
    ]
    # Tells apart different queries with the same id.
    keys = pa.array([np.trim_zeros(row, "b").tobytes() for row in whole], pa.binary())
    lists = [pa.array([x[side] for x in found], pa.list_(pa.int64())) for side in (0, 1)]
    if first:
        reached = [int(s[-1]) if len(s) == k and s[-1] > LEAST else None for _, s in found]
        more = {"vector": column, "block": asked.column("block"), "floor": pa.array(reached, pa.int64())}
    else:
        more = {}
    columns = {"query_id": pa.array(ids), "query_key": keys, "ids": lists[0], "scores": lists[1], **more}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _search(
    candidates: DataFrame, asked: DataFrame, groups: int, units: int, k: int, first: bool
) -> DataFrame:
    """The answers of ``asked`` (vec_id, vector, block, floor) in their blocks of candidates
    (vec_id, vector, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, block = None, [], None
        for batch in batches:
            units = batch.column("unit").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(units) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for at, end in itertools.pairwise([0, *turns.tolist(), len(units)]):
                if end == at:
                    continue
                part = batch.slice(at, end - at)
                if units[at] != unit:
                    unit, held, block = units[at], [], None
                if not asks[at]:
                    held.append(part)
                    continue
                if block is None:
                    block = Block.of(held) if held else Block(np.empty(0, np.int64), np.empty((0, 0), np.int64))
                    held = []
                yield _answers(block, part, k, first)

    group = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(groups).cast("long"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    there = candidates.withColumn("group", copies).withColumn("floor", F.lit(None).cast("long"))
    both = there.withColumn("asks", F.lit(False)).unionByName(
        asked.withColumn("group", group).withColumn("asks", F.lit(True))
    )
    both = both.withColumn("unit", F.col("block") * groups + F.col("group")).drop("group")
    partitions = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = min(units, TASKS_A_PARTITION * partitions)
    schema = f"{FOUND}, vector array<long>, block long, floor long" if first else FOUND
    return (
        both.repartitionById(dealt, F.pmod("unit", F.lit(dealt)).cast("int"))
        .sortWithinPartitions("unit", "asks")
        .mapInArrow(run, schema)
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    candidates_per_block: int = CANDIDATES,
    queries_per_block: int = QUERIES,
    ws: Workspace | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries and candidates (vec_id, vector)."""
    ws = ws or Workspace(vectors.sparkSession)
    blocks = max(1, -(-vectors.count() // candidates_per_block))
    groups = max(1, -(-queries.count() // queries_per_block))
    of = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks).cast("long"))
    candidates = vectors.select("vec_id", "vector", of.alias("block"))
    no_floor = F.lit(None).cast("long").alias("floor")
    home = queries.select("vec_id", "vector", of.alias("block"), no_floor)
    near = ws.materialize(_search(candidates, home, groups, blocks * groups, k, True), "near").df
    everywhere = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    others = near.select(
        F.col("query_id").alias("vec_id"),
        "vector",
        F.explode(F.array_remove(everywhere, F.col("block"))).alias("block"),
        "floor",
    )
    far = _search(candidates, others, groups, blocks * groups, k, False)
    found = near.select("query_id", "query_key", "ids", "scores").unionByName(far)
    best = found.select("query_id", "query_key", F.inline(F.arrays_zip("ids", "scores")))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("scores"), "ids")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("ids").alias("vec_id"), F.col("scores").alias("score"))
    )


def op9_exact_top_k(spark: SparkSession, table: DataFrame) -> DataFrame:
    vectors = Workspace(spark).materialize(integer_vectors(table), "vectors").df
    return top_k(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


SQL = f"""
with vectors as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(x::double * {SCALE})) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on q.vec_id % {EVERY} = 0 and c.vec_id <> q.vec_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= {K}
"""
