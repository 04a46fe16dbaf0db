"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct shingles of ``width`` words (two, if not said); its sketch is the k smallest hashes
of the set (the whole set, if smaller).  Steps:

1. Documents with the same sequence of words (SHA-256) form a class; one stands for all.
2. Inverted lists: every retained value lists the classes that hold it.  Two sets with a
   similarity of 0.8 share about 0.8 k retained values, and fewer than ``OVERLAP`` with a
   probability of about 1.2e-6 (binomial; the only way to lose a link).  Sets that share
   ``o`` of their ``m`` values share one among the m - o + 1 rarest of either, so only those
   are listed: values that many documents hold are listed only where a document has hardly
   any other.
3. First pass: each list compares its members with its centres, the few that share most
   of their values with others (in a group of edited copies, the least edited).  Candidates
   must have compatible set sizes, pass the union-sketch estimate, and are measured on full
   sets.  Components of the links are formed.
4. Second pass: pairs of a list that are in different components.  For members that were
   measured against the list's first centre all is known by their *edits*, the shingles in
   which they differ from it: two sets differ where exactly one of them has an edit.  Edits
   of most members are the centre's own, so the sets are taken relative to the centre without
   them.  Sets with few edits are similar for sure, and one link to the least edited settles
   each; any other similar pair shares a known number of edits, so it shares one among the
   rarest of either (a prefix filter), by which the remaining pairs are found.  Members that
   were not measured against any first centre that the other was measured against, in whichever
   list, meet directly, each pair in the list of its smallest common value.  No link between
   components is lost, and a group's pairs are never all formed.

Verification joins the pairs with the texts; a pair of rows is compared in Python.

Defined results: null or wordless text has an empty set and no links; a document without
an id has no links and component null, and is kept; ids are taken as unique (with repeated
ids, each row is linked by its own text); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.llm.common import shingles, words_of
from iterweave.llm.components import connected_components
from iterweave.workspace import Workspace

SIMILARITY = (80, 100)  # link when 100 * intersection >= 80 * union
WIDTH = 2  # words of a shingle
SKETCH = 32  # retained values: k
OVERLAP = 14  # of k; P(fewer shared | similarity 0.8) is 1.2e-6
AROUND = 4  # of k: members of a list that share so many with its first centre are measured
CENTRES = 3  # members of a list that all others are compared with in the first pass

_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 63-bit hash per pair of word hashes."""
    with np.errstate(over="ignore"):
        x = first * _MIX1 + (second ^ (second >> np.uint64(31))) * _MIX2
        x = (x ^ (x >> np.uint64(29))) * _MIX1
        x = (x ^ (x >> np.uint64(32))) * _MIX2
    return (x ^ (x >> np.uint64(30))) >> np.uint64(1)


def sketch(words: list[bytes], k: int = SKETCH, width: int = WIDTH) -> tuple[int, np.ndarray]:
    """Size of the shingle set, and its k smallest hashes, ascending."""
    if not words:
        return 0, np.empty(0, np.int64)
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers], np.uint64)
    if len(words) < width:
        at, length = np.zeros(1, np.int64), len(words)
    else:
        runs, length = codes[: len(words) - width + 1], width
        for i in range(1, width):
            if i > 1:
                runs = np.unique(runs, return_inverse=True)[1]  # small numbers again
            runs = runs * len(numbers) + codes[i : i + len(runs)]
        at = np.unique(runs, return_index=True)[1]
    values = hashes[codes[at]]
    for i in range(1, length):
        values = _mixed(values, hashes[codes[at + i]])
    if length < width or width == 1:
        values = _mixed(values, np.zeros(1, np.uint64))
    size = len(values)
    if size > k:
        values = np.partition(values, k)[:k]
    return size, np.unique(values).astype(np.int64)


def sketches(docs: DataFrame, k: int = SKETCH, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, key, sketch) per row; the key is the SHA-256 of the words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, data in zip(frame["doc_id"], frame["data"], strict=True):
                words = words_of(data)
                size, values = sketch(words, k, width)
                out.append((doc_id, size, hashlib.sha256(b" ".join(words)).digest(), values))
            made = pd.DataFrame(out, columns=["doc_id", "n_shingles", "key", "sketch"])
            yield made.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
    return rows.mapInPandas(run, "doc_id long, n_shingles long, key binary, sketch array<long>")


def inverted_lists(classes: DataFrame, k: int = SKETCH, overlap: int = OVERLAP) -> DataFrame:
    """(value, node, size, shared): the rarest values of every sketch, if more than one
    class holds them; ``shared`` counts the sketch's values that others hold."""
    entries = classes.select("node", "size", F.explode("sketch").alias("value"))
    holders = entries.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    shared = entries.join(holders, "value")
    rarest = F.sort_array(F.collect_list(F.struct("holders", "value")))
    # Values with one holder are the rarest; they take their part of the length unseen.
    retained = F.least("size", F.lit(k).cast("long"))
    needed = F.least(F.lit(overlap).cast("long"), F.ceil(F.col("size") * SIMILARITY[0] / SIMILARITY[1]))
    length = retained - needed + 1 - (retained - F.size("rarest"))
    return (
        shared.groupBy("node", "size")  # at most k rows each
        .agg(rarest.alias("rarest"))
        .withColumn("length", length.cast("int"))
        .filter("length > 0")
        .withColumn("shared", F.size("rarest"))
        .select(
            "node", "size", "shared", F.explode(F.slice("rarest", F.lit(1), F.col("length"))).alias("r")
        )
        .select("r.value", "node", "size", "shared")
    )


def _similar_size(a: str, b: str) -> str:
    part, whole = SIMILARITY
    return f"{whole} * least({a}, {b}) >= {part} * greatest({a}, {b})"


def _likely(pairs: DataFrame, classes: DataFrame, k: int, overlap: Column) -> DataFrame:
    """Pairs whose union sketch (the k smallest of both) has enough values of both: that
    many of k, or of a smaller union, which is whole, the same share."""
    of = classes.select("node", "sketch")
    met = pairs.join(of.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a").join(
        of.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b"
    )
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return met.filter(common * k >= overlap * F.size(union)).select("a", "b")


def _codes(found: set) -> list[int]:
    return [xxhash.xxh3_64_intdigest(b" ".join(x)) >> 1 for x in found]


def measure(pairs: DataFrame, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b, common, whole, a_only, b_only): sizes of intersection and union of the pairs'
    full sets, and hashes of what either has alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            last, left = None, set()
            found = []
            for one, other in zip(frame["x"], frame["y"], strict=True):
                if one is not last:
                    last, left = one, shingles(words_of(one), width)
                right = shingles(words_of(other), width)
                common = len(left & right)
                whole = len(left) + len(right) - common
                found.append((common, whole, _codes(left - right), _codes(right - left)))
            made = pd.DataFrame(found, columns=["common", "whole", "a_only", "b_only"])
            yield pd.concat([frame[["a", "b"]].reset_index(drop=True), made], axis=1)

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("data"))
    first, second = texts.alias("first"), texts.alias("second")
    met = (
        pairs.join(first, F.col("a") == F.col("first.id"))
        .join(second, F.col("b") == F.col("second.id"))
        .select("a", "b", F.col("first.data").alias("x"), F.col("second.data").alias("y"))
    )
    return met.mapInPandas(
        run, "a long, b long, common long, whole long, a_only array<long>, b_only array<long>"
    )


def linked(measured: DataFrame) -> DataFrame:
    part, whole = SIMILARITY
    return measured.filter(f"whole > 0 and {whole} * common >= {part} * whole").select("a", "b")


def centres(lists: DataFrame, count: int = CENTRES) -> DataFrame:
    """(value, centre, centre_size, rank): the members of a list that share most values."""
    order = Window.partitionBy("value").orderBy(F.desc("shared"), "node")
    return (
        lists.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= count)  # limited per task before the shuffle
        .select("value", F.col("node").alias("centre"), F.col("size").alias("centre_size"), "rank")
    )


def first_pass(lists: DataFrame, middle: DataFrame) -> DataFrame:
    """Members of each list with its centres (a < b, similar sizes), and the best rank."""
    return (
        lists.join(middle, "value")
        .filter(f"centre <> node and {_similar_size('size', 'centre_size')}")
        .groupBy(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b"))
        .agg(F.min("rank").alias("rank"))
    )


def edited_groups(measured: DataFrame, middle: DataFrame, labels: DataFrame) -> DataFrame:
    """(centre, node, size, component, edits): what was measured against first centres, and
    those themselves.  Repeated ids have several sets; they are left out, as not measured."""
    first = middle.filter("rank = 1").select("centre", F.col("centre_size")).distinct()
    sides = [("a", "b", "b_only"), ("b", "a", "a_only")]
    both = reduce(
        DataFrame.union,
        [
            measured.select(
                F.col(c).alias("centre"),
                F.col(x).alias("node"),
                (F.col("common") + F.size(own)).alias("size"),
                F.concat("a_only", "b_only").alias("edits"),
            )
            for c, x, own in sides
        ],
    ).join(first.select("centre").distinct(), "centre", "left_semi")
    itself = first.select(
        "centre", F.col("centre").alias("node"), F.col("centre_size").alias("size"), F.array().cast("array<bigint>").alias("edits")
    )
    rows = both.union(itself).join(labels, "node", "left")
    single = rows.groupBy("centre", "node").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("size").alias("size"),
        F.first(F.coalesce("component", "node")).alias("component"),
        F.first("edits").alias("edits"),
    )
    return single.filter("n = 1").drop("n")


def with_open_pairs(groups: DataFrame) -> DataFrame:
    """The groups with members of several components that were not compared, and their size."""
    parts = groups.groupBy("centre").agg(
        F.count(F.lit(1)).alias("members"),
        (F.min("component") < F.max("component")).alias("several"),
    )
    return groups.join(parts.filter("several and members > 2").drop("several"), "centre")


def counted_edits(groups: DataFrame) -> DataFrame:
    """(centre, code, holders, members): how many members of a group have an edit."""
    codes = groups.select("centre", "members", F.explode("edits").alias("code"))
    return codes.groupBy("centre", "code").agg(
        F.count(F.lit(1)).alias("holders"), F.first("members").alias("members")
    )


def recentred(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``groups`` with their edits relative to what most members have, rarest first."""
    codes = groups.select("centre", "node", F.explode("edits").alias("code"))
    usual = counts.filter("2 * holders > members")  # at most twice the mean number of edits
    own = codes.join(counts.filter("2 * holders <= members"), ["centre", "code"])
    lacking = (
        groups.select("centre", "node")
        .join(usual, "centre")
        .withColumn("holders", F.col("members") - F.col("holders"))
        .join(codes, ["centre", "node", "code"], "left_anti")
    )
    columns = ["centre", "node", "holders", "code"]
    edits = (
        own.select(columns)
        .union(lacking.select(columns))
        .groupBy("centre", "node")  # at most the shingles of two documents
        .agg(F.sort_array(F.collect_list(F.struct("holders", "code"))).alias("rarest"))
        .select("centre", "node", F.col("rarest.code").alias("edits"))
    )
    none = F.array().cast("array<bigint>")
    return (
        groups.drop("edits", "members")
        .join(edits, ["centre", "node"], "left")
        .withColumn("edits", F.coalesce("edits", none))
    )


# Sets x and y that differ in D shingles are similar if BOTH * D <= APART * (|x| + |y|).
APART, BOTH = SIMILARITY[1] - SIMILARITY[0], SIMILARITY[1] + SIMILARITY[0]


def scored(groups: DataFrame) -> DataFrame:
    """Add ``score``, the least one of the group and its node: two sets are similar for sure
    if their scores' sum is not above 0, and otherwise only if they share at least that sum
    / (2 * BOTH) of their edits."""
    score = (BOTH * F.size("edits") - APART * F.col("size")).alias("score")
    groups = groups.select("*", score)
    best = groups.groupBy("centre").agg(F.min(F.struct("score", "node", "component")).alias("best"))
    return groups.join(best, "centre").select(
        *groups.columns,
        F.col("best.score").alias("least"),
        F.col("best.node").alias("nearest"),
        ((F.col("score") + F.col("best.score") <= 0) | (F.col("component") == F.col("best.component"))).alias("settled"),
    )


def sure_links(groups: DataFrame) -> DataFrame:
    """(a, b): the least edited set of a group with all that are similar to it for sure."""
    near = groups.filter("node <> nearest and score + least <= 0")
    return near.select(
        F.least("node", "nearest").alias("a"), F.greatest("node", "nearest").alias("b")
    ).distinct()


def pairs_by_edits(groups: DataFrame) -> DataFrame:
    """(a, b) of different components that may share enough edits: a set that is not settled
    with any other.  They share one among the first edits of either."""

    def listed(rows: DataFrame, lowest: str, end: str) -> DataFrame:
        needed = f"greatest(1, cast(ceil(({lowest}) / {2.0 * BOTH}) as int))"
        kept = F.slice("edits", F.lit(1), F.expr(f"greatest(0, size(edits) - {needed} + 1)"))
        names = ("node", "size", "component", "score", "settled")
        return rows.withColumn("n_edits", F.size("edits")).select(
            "centre",
            *[F.col(c).alias(f"{c}_{end}") for c in (*names, "n_edits")],
            F.posexplode(kept).alias(f"at_{end}", "code"),
        )

    # The partner of a settled set is not settled: its score is above -least.
    open_ = listed(groups.filter("not settled"), "score + least", "x")
    every = listed(groups, "if(settled, score - least, score + least)", "y")
    need = f"greatest(1, cast(ceil((score_x + score_y) / {2.0 * BOTH}) as int))"
    return (
        open_.join(every, ["centre", "code"])
        .filter(f"at_x <= n_edits_x - {need} and at_y <= n_edits_y - {need}")
        .filter(f"component_x <> component_y and {_similar_size('size_x', 'size_y')}")
        .filter("settled_y or node_x < node_y")
        .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
        .distinct()
    )


def open_lists(
    lists: DataFrame, labels: DataFrame, middle: DataFrame, groups: DataFrame
) -> DataFrame:
    """The entries of lists that hold several components, with the list's largest one, all
    values of the entry's node, and those first centres of its lists it was measured against."""
    labelled = lists.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    counts = labelled.groupBy("value", "component").agg(F.count(F.lit(1)).alias("n"))
    main = (
        counts.groupBy("value")
        .agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("value", F.col("most.component").alias("main"))
    )
    first = middle.filter("rank = 1").select("value", "centre").distinct()
    values = lists.groupBy("node", "size").agg(F.collect_set("value").alias("values"))  # up to k
    near = lists.select("value", "node").join(first, "value").join(groups.select("centre", "node"), ["centre", "node"])
    near = near.groupBy("node").agg(F.collect_set("centre").alias("near"))  # up to k as well
    none = F.array().cast("array<bigint>")
    return (
        labelled.join(main, "value")
        .join(values, ["node", "size"])
        .join(near, "node", "left")
        .select("value", "node", "size", "component", "main", F.coalesce("near", none).alias("near"), "values")
    )


def pairs_by_lists(entries: DataFrame) -> DataFrame:
    """(a, b) of different components that share a list, but no first centre that both were
    measured against, in whose group they meet by their edits; and but for those within the
    list's main component, which are connected already."""
    minor = entries.filter("component <> main").select(
        "value", *[F.col(c).alias(f"{c}_a") for c in ("node", "size", "component", "near", "values")]
    )
    return (
        entries.join(minor, "value")
        .filter(f"component <> component_a and {_similar_size('size', 'size_a')}")
        .filter("component = main or node_a < node")
        .filter("not arrays_overlap(near, near_a)")
        .filter("value = array_min(array_intersect(values, values_a))")
        .select(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    k: int = SKETCH,
    overlap: int = OVERLAP,
    centre_count: int = CENTRES,
    ws: Workspace | None = None,
    width: int = WIDTH,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    ws = ws or Workspace(docs.sparkSession)
    made = ws.materialize(sketches(docs, k, width), "sketches").df
    named = made.filter("n_shingles > 0 and doc_id is not null")
    smallest = named.groupBy("key").agg(F.min("doc_id").alias("node"))
    joined = named.join(smallest, "key")
    members = joined.select("doc_id", "n_shingles", "node")
    classes = (
        joined.filter("doc_id = node")
        .select("node", F.col("n_shingles").alias("size"), "sketch")
        .dropDuplicates(["node", "size"])
    )
    classes = ws.materialize(classes, "classes").df
    lists = ws.materialize(inverted_lists(classes, k, overlap), "lists").df

    middle = ws.materialize(centres(lists, centre_count), "centres").df
    ranked = first_pass(lists, middle)
    wanted = F.when(F.col("rank") == 1, min(AROUND, overlap)).otherwise(overlap)
    tried = ws.materialize(_likely(ranked, classes, k, wanted), "tried").df
    measured = ws.materialize(measure(tried, docs, width), "measured")
    links = ws.materialize(linked(measured.df), "linked").df
    labels = connected_components(ws, links)
    groups = ws.materialize(edited_groups(measured.df, middle, labels), "groups")
    ws.discard(measured)  # edits are long: each table of them goes once the next is written
    entries = ws.materialize(open_lists(lists, labels, middle, groups.df), "entries").df
    opened = ws.materialize(with_open_pairs(groups.df), "open")
    ws.discard(groups)
    counts = ws.materialize(counted_edits(opened.df), "counts")
    edits = ws.materialize(scored(recentred(opened.df, counts.df)), "edits")
    ws.discard(opened, counts)
    rest = pairs_by_edits(edits.df).union(pairs_by_lists(entries)).distinct()
    rest = rest.join(tried, ["a", "b"], "left_anti")
    rest = ws.materialize(_likely(rest, classes, k, F.lit(overlap)), "rest").df
    more = linked(measure(rest, docs, width)).union(sure_links(edits.df))
    more = ws.materialize(more, "linked")
    ws.discard(edits)
    if more.rows:
        labels = connected_components(ws, links.union(more.df))
    named = members.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    alone = made.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return named.unionByName(alone).withColumn("kept", kept)


def op6_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
