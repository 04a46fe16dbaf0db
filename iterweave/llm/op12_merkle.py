"""Merkle manifest of a dataset: a root over per-source trees, and a proof for every row.

Rows of a source are its leaves, in the order of their ids; every ``FAN`` consecutive nodes
become one, until one is left; the sources' roots are the leaves of the last tree.

Both sweeps are time-forward processing.  Nodes are labelled (level, index), children before
parents; a node's digest is a message that waits in a priority queue under its parent's label,
and a node is made when its label comes up, of the messages that wait for it.  The queue is
external: a tree is cut into subtrees of ``FAN ** DEPTH`` leaves, whose messages wait in a task's
heap, and what a subtree sends to the rest of the tree waits in a table that the next round's
shuffle sorts by label.  The second sweep takes the labels in reverse: every node sends its
children the *suffix* of their proofs (siblings from that node's level to the root).  Rounds
grow with the logarithm of the largest source to that base; a task holds one subtree at a
time.

Defined results: any null is ``-``; rows without source are a source of their own, the first
one; rows without doc_id come first; rows with the same id are ordered by their leaf, and
repeated rows are leaves of their own; rows without id are never tampered with; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iterweave.operators.ordering import positions
from iterweave.workspace import Workspace

FAN = 3
DEPTH = 8  # levels of a subtree
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

TOP = "_all"


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, or else its length in bytes, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    written = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(w, F.lit("-")) for w in written]).cast("binary"), 256)


class Subtree:
    """The nodes above consecutive leaves: up to one node, or ``depth`` levels high if the
    leaves are only a part of their level."""

    def __init__(self, leaves: list[str], depth: int | None):
        self.nodes = {(0, i): leaf for i, leaf in enumerate(leaves)}
        self.width = [len(leaves)]
        queue = [(1, i // FAN, i, leaf) for i, leaf in enumerate(leaves)]
        heapq.heapify(queue)
        self.depth = depth if depth is not None else _height(len(leaves))
        while queue[0][0] <= self.depth:
            level, index = queue[0][:2]
            waiting = []
            while queue and queue[0][:2] == (level, index):
                waiting.append(heapq.heappop(queue)[3])
            made = digest(waiting)
            self.nodes[level, index] = made
            if level == len(self.width):
                self.width.append(0)
            self.width[level] += 1
            heapq.heappush(queue, (level + 1, index // FAN, index, made))
        self.top = queue[0][3]

    def suffixes(self, above: str) -> list[str]:
        """The proof of every leaf, given that of the top: per level the own place in the run
        and the run's other digests, ended by ``;``."""
        queue = [(-self.depth, 0, above)]
        found = [""] * self.width[0]
        while queue:
            level, index, suffix = heapq.heappop(queue)
            if not level:
                found[index] = suffix
                continue
            below = -level - 1
            run = range(index * FAN, min((index + 1) * FAN, self.width[below]))
            digests = [self.nodes[below, i] for i in run]
            for place, i in enumerate(run):
                own = str(place) + "".join(digests[:place] + digests[place + 1 :])
                heapq.heappush(queue, (-below, i, f"{own};{suffix}"))
        return found


def _height(leaves: int) -> int:
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof give."""
    for level in proof.split(";")[:-1]:
        place, others = int(level[0]), level[1:]
        parts = [others[i : i + 64] for i in range(0, len(others), 64)]
        leaf = digest([*parts[:place], leaf, *parts[place:]])
    return leaf


def siblings_of(proof: str) -> str:
    """All sibling digests of a proof, one after the other."""
    return "".join(level[1:] for level in proof.split(";"))


def _subtrees(frames: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Rows of a sorted stream, a subtree at a time, across batches."""
    held: list[tuple] = []
    for frame in frames:
        for row in frame.itertuples(index=False):
            if held and (row.tree, row.chunk) != (held[0].tree, held[0].chunk):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _subtree(rows: list[tuple], depth: int) -> Subtree:
    part = rows[0].size > FAN**depth
    return Subtree([r.digest for r in rows], depth if part else None)


def _streams(rows: DataFrame, depth: int, buckets: int, *then: str) -> DataFrame:
    rows = rows.withColumn("chunk", F.expr(f"pos div {FAN**depth}"))
    return rows.repartition(buckets, "tree", "chunk").sortWithinPartitions("tree", "chunk", *then)


def _raise(ws: Workspace, nodes: DataFrame, depth: int) -> DataFrame:
    """The tops of the subtrees over ``nodes`` (tree, pos, size, digest), in the same form."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = []
        for held in _subtrees(frames):
            first, top = held[0], _subtree(held, depth).top
            made.append((first.tree, first.chunk, -(-first.size // FAN**depth), top))
            if len(made) == 1000:
                yield pd.DataFrame(made, columns=["tree", "pos", "size", "digest"])
                made = []
        if made:
            yield pd.DataFrame(made, columns=["tree", "pos", "size", "digest"])

    rows = _streams(nodes.select("tree", "pos", "size", "digest"), depth, ws.partitions, "pos")
    return rows.mapInPandas(run, "tree string, pos long, size long, digest string")


def _deliver(ws: Workspace, nodes: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """Add ``proof`` to ``nodes``: ``above`` (tree, pos, proof) holds that of each subtree's top,
    which reaches the task ahead of the subtree's nodes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _subtrees(frames):
            top, rows = held[0], held[1:]
            proofs = _subtree(rows, depth).suffixes(top.proof)
            for at in range(0, len(rows), 2000):
                out = pd.DataFrame(rows[at : at + 2000]).assign(proof=proofs[at : at + 2000])
                yield out[["tree", "pos", "size", "digest", "proof"]]

    tops = above.select(
        "tree",
        (F.col("pos") * FAN**depth).alias("pos"),
        F.lit(0).cast("long").alias("size"),
        F.lit("").alias("digest"),
        "proof",
        F.lit(0).alias("kind"),
    )
    own = nodes.select("tree", "pos", "size", "digest", F.lit("").alias("proof"), F.lit(1).alias("kind"))
    rows = _streams(tops.unionByName(own), depth, ws.partitions, "kind", "pos")
    return rows.mapInPandas(run, "tree string, pos long, size long, digest string, proof string")


class Forest:
    """Trees over ``leaves`` (tree, pos, size, digest): ``roots`` (tree, digest) after the
    first sweep, and every leaf's proof by the second."""

    def __init__(self, ws: Workspace, leaves: DataFrame, depth: int = DEPTH):
        self.ws, self.depth = ws, depth
        nodes = ws.materialize(leaves, "nodes", largest=F.max("size"))
        self.levels = [nodes]
        largest = nodes.metrics["largest"] or 0
        while True:  # a tree of one node is its own subtree, and stays as it is
            self.levels.append(ws.materialize(_raise(ws, self.levels[-1].df, depth), "nodes"))
            if largest <= FAN**depth:
                break
            largest = -(-largest // FAN**depth)
        self.roots = self.levels[-1].df.select("tree", "digest")

    def proofs(self, above: DataFrame | None = None) -> DataFrame:
        """(tree, pos, size, digest, proof) per leaf; ``above`` (tree, proof) continues the
        proofs beyond the trees' roots."""
        tops = self.levels[-1].df.select("tree", "pos")
        if above is None:
            proofs = tops.withColumn("proof", F.lit(""))
        else:
            proofs = tops.join(above, "tree")
        for nodes in reversed(self.levels[:-1]):
            proofs = self.ws.materialize(_deliver(self.ws, nodes.df, proofs, self.depth), "proofs").df
        return proofs


def source_key(source: Column) -> Column:
    """Orders as the sources do: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def manifest(
    docs: DataFrame, ws: Workspace | None = None, depth: int = DEPTH, **also: Column
) -> DataFrame:
    """(tree, doc_id, leaf, subroot, root, proof) per row of ``docs``, and the columns
    ``also``, computed of its row."""
    ws = ws or Workspace(docs.sparkSession)
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    rows = docs.select(
        source_key(F.col("source")).alias("tree"),
        "doc_id",
        leaf.alias("digest"),
        *[c.alias(n) for n, c in also.items()],
    )
    rows = ws.materialize(positions(ws, rows, ["doc_id", "digest"], "tree"), "leaves").df
    forest = Forest(ws, rows.select("tree", "pos", "size", "digest"), depth)
    sources = positions(ws, forest.roots, ["tree"]).withColumnRenamed("tree", "of")
    sources = ws.materialize(sources, "sources").df
    last = Forest(ws, sources.select(F.lit(TOP).alias("tree"), "pos", "size", "digest"), depth)
    above = last.proofs().select("pos", "proof").join(sources, "pos")
    proofs = forest.proofs(above.select(F.col("of").alias("tree"), "proof"))
    subroots = forest.roots.withColumnRenamed("digest", "subroot")
    return (
        rows.drop("size", "digest")
        .join(proofs.select("tree", "pos", F.col("digest").alias("leaf"), "proof"), ["tree", "pos"])
        .join(subroots, "tree")
        .withColumn("root", last.roots.select("digest").scalar())
        .drop("pos")
    )


def op12_merkle_manifest(spark: SparkSession, docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    shorn = leaf_digest([doc_id, source, lang, n_chars, F.replace(text, F.lit("\n"), F.lit(""))])
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    rows = manifest(docs, depth=depth, tampered=F.when(even, shorn))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            proofs, leaves = frame.pop("proof"), frame.pop("tampered")
            leaves = leaves.where(leaves.notna(), frame["leaf"])
            frame["proof_sha256"] = [digest([siblings_of(p)]) for p in proofs]
            frame["folded_root"] = [fold(d, p) for d, p in zip(leaves, proofs, strict=True)]
            yield frame.assign(verified=frame["folded_root"] == frame["root"])

    given = F.col("doc_id").cast("string")  # as text: pandas has no whole numbers with nulls
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = ", ".join([*[f"{c} string" for c in columns], "verified boolean"])
    kept = rows.select(given.alias("doc_id"), "leaf", "subroot", "root", "tampered", "proof")
    back = F.col("doc_id").cast(docs.schema["doc_id"].dataType)
    return kept.mapInPandas(run, schema).withColumn("doc_id", back)


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({f})::varchar || ':' || {f}, '-')" for f in fields
    ) + ")"


_CRC = """list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
  lambda crc, byte: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, byte)),
  4294967295)"""

def _step_sql(walk: str, nodes: str) -> str:
    """One level up: the run's digests with the own one in place, and the others to the proof."""
    return f"""
  select w.row, any_value(w.tree), any_value(w.lvl) + 1, any_value(w.pos) // {FAN}, (any_value(w.n) + {FAN - 1}) // {FAN},
    sha256(string_agg(case when k.pos = w.pos then w.own else k.digest end, '' order by k.pos)),
    any_value(w.proof) || coalesce(string_agg(k.digest, '' order by k.pos) filter (k.pos <> w.pos), '')
  from {walk} w join {nodes} k on k.tree = w.tree and k.lvl = w.lvl and k.pos // {FAN} = w.pos // {FAN}
  where w.n > 1 group by w.row"""


SQL = f"""
with recursive leaves as (
  select row_number() over () as row, doc_id, coalesce('=' || source, '') as tree, {_leaf_sql("text")} as leaf,
    case when xor({_CRC}, 4294967295) % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")} end as changed
  from documents),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by tree) as n from leaves),
nodes(tree, lvl, pos, digest, n) as (
  select tree, 0, pos, leaf, n from placed
  union all
  select tree, lvl + 1, pos // {FAN}, sha256(string_agg(digest, '' order by pos)), (any_value(n) + {FAN - 1}) // {FAN}
  from nodes where n > 1 group by tree, lvl, pos // {FAN}),
subroots as (
  select tree, digest, row_number() over (order by tree) - 1 as pos, count(*) over () as n from nodes where n = 1),
tops(tree, lvl, pos, digest, n) as (
  select '{TOP}', 0, pos, digest, n from subroots
  union all
  select tree, lvl + 1, pos // {FAN}, sha256(string_agg(digest, '' order by pos)), (any_value(n) + {FAN - 1}) // {FAN}
  from tops where n > 1 group by tree, lvl, pos // {FAN}),
walk(row, tree, lvl, pos, n, own, proof) as (
  select row, tree, 0, pos, n, coalesce(changed, leaf), '' from placed
  union all
{_step_sql("walk", "nodes")}),
climb(row, tree, lvl, pos, n, own, proof) as (
  select w.row, '{TOP}', 0, s.pos, s.n, w.own, w.proof from walk w join subroots s using (tree) where w.n = 1
  union all
{_step_sql("climb", "tops")}),
ends as (select row, own as folded_root, sha256(proof) as proof_sha256 from climb where n = 1)
select doc_id, leaf, s.digest as subroot, t.digest as root, proof_sha256, folded_root, folded_root = t.digest as verified
from placed p join subroots s on s.tree = p.tree join ends e on e.row = p.row join tops t on t.n = 1
"""
