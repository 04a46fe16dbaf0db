"""Conversation repair, the Merkle manifest and fingerprints against brute force."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from iterweave.llm import op11_repair, op12_merkle, op13_imatch
from tests.llm.helpers import docs, words

SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string, pos int, conv string, fault int"
COUNTED = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((kind != 0) + (kind == 3)):
            yield conv, turn, role, text


def cheapest(rows):
    """(cost, edits, repaired) of (role, text, fault) rows, by trying all edits."""
    ahead, named = (2, 2, 3, 2), {2: "user", 3: "assistant"}

    @functools.cache
    def best(i, state, inserted):
        found = []

        def add(cost, edit, row, rest):
            if rest:
                found.append((cost + rest[0], edit + rest[1], row + rest[2]))

        if i == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        then = ahead[state]
        if inserted < 4:
            add(2, "I", ((named[then], ""),), best(i, then, inserted + 1))
        if i < len(rows):
            role, text, fault = rows[i]
            add(3, "D", (), best(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                kept = {"s": 1, "u": 2, "a": 3}.get(role[:1])
                if kept == then or (kept == 1 and state == 0):
                    add(more, "K", ((role, text),), best(i + 1, kept, 0))
                add(2 + more, "R", ((named[then], text),), best(i + 1, then, 0))
        return min(found, key=lambda f: f[:2]) if found else None

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def repaired(rows):
    convs = {conv: [] for conv, *_ in rows}
    for row in damaged(rows):
        convs[row[0]].append(row)
    found = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, marked = set(), []
        for _, _, role, text in held:
            end = text.strip(SPACE)[-1:]
            fault = "" if end in (".", "!", "?") else "truncated"
            if (role, text) in seen:
                fault = "duplicate"
            marked.append((role, text, fault if end else "blank"))
            seen.add((role, text))
        turns = {r[1] for r in held} - {None}
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:], strict=False)]
        kinds = [f for _, _, f in marked]
        cost, audit, out = cheapest(tuple(marked))
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )
    return found


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], TURNS)


@pytest.mark.parametrize("block", [3, op11_repair.BLOCK])
def test_repair_of_hostile_conversations(spark, block):
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    texts = ["a.", "b!", "c?\n", "d", " ", "", None, "e. f", "é.", "x" * 200_000]
    rows = [
        (conv, rng.choice([None, t, t, t, t // 2, t + 3]), rng.choice(roles), rng.choice(texts))
        for conv in [None, *range(150)]
        for t in range(rng.randrange(8))
    ]
    rows += [(-5, t // 3, rng.choice(roles[:5]), f"{rng.choice('abc')}{t % 40}.") for t in range(200)]
    got = op11_repair.op11_repair_conversations(spark, conversations(spark, rows), block)
    assert {r.conv_id: tuple(r[c] for c in COUNTED) for r in got.collect()} == repaired(rows)


def test_repair_of_the_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = op11_repair.op11_repair_conversations(spark, table).collect()
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r[c] for c in COUNTED) for r in got} == repaired(rows)


def test_edits_give_the_repaired_rows(spark, ws):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b"), (1, 2, "user", ""), (2, 0, "system", "s.")]
    marked = ws.materialize(op11_repair.faults(conversations(spark, rows)), "marked").df
    found = op11_repair.repair(marked, ws).collect()
    edits = sorted((r.conv, r.step, r.edit, r.role, r.text) for r in found if r.step)
    assert edits == [
        ("=1", 1, "I", "user", ""),
        ("=1", 2, "K", "assistant", "a."),
        ("=1", 3, "D", "user", None),
        ("=1", 4, "D", "user", None),
        ("=2", 1, "D", "system", None),
    ]
    assert {(r.conv, r.edit, r.cost) for r in found if not r.step} == {("=1", "IKDD", 8), ("=2", "D", 3)}


def test_no_conversations(spark):
    empty = conversations(spark, [(1, 1, "user", "x")]).limit(0)
    assert op11_repair.op11_repair_conversations(spark, empty).count() == 0


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields)


def tree(leaves):
    """(root, siblings per leaf with their places) by recursion over levels."""
    if len(leaves) < 2:
        return leaves[0], [[] for _ in leaves]
    runs = [leaves[i : i + 3] for i in range(0, len(leaves), 3)]
    root, above = tree([h(run) for run in runs])
    paths = [
        [(j, run[:j] + run[j + 1 :])] + above[i] for i, run in enumerate(runs) for j in range(len(run))
    ]
    return root, paths


def manifest_of(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(sources, key=lambda s: b"" if s is None else b"=" + s.encode())
    trees = []
    for name in names:
        held = sorted(sources[name], key=lambda x: x[:3])
        trees.append((held, *tree([x[2] for x in held])))
    root, tops = tree([subroot for _, subroot, _ in trees])
    found = []
    for (held, subroot, paths), top in zip(trees, tops, strict=True):
        for (known, doc_id, digest, row), path in zip(held, paths, strict=True):
            folded = digest
            if known and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                folded = leaf(row, None if row.text is None else row.text.replace("\n", ""))
            for place, others in path + top:
                folded = h([*others[:place], folded, *others[place:]])
            proof = h(x for _, others in path + top for x in others)
            found.append((row.doc_id, digest, subroot, root, proof, folded, folded == root))
    return sorted(found, key=str)


MANIFEST = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


@pytest.mark.parametrize("depth", [1, 2, op12_merkle.DEPTH])
def test_manifest(spark, depth):
    rng = random.Random(depth)
    names = [None, "", "é", "z"] + [f"s{i}" for i in range(30)] + ["hot"] * 12
    rows = [(rng.choice([None, i, i, i, 7]), rng.choice([None, "", f"a\n{i}", "b", "line\n" * 40_000]), rng.choice([None, "en"]), rng.choice(names)) for i in range(170)]
    rows += [(9, "same\n", "en", "hot")] * 8 + [(2**60 + i, "x\ny", "en", "hot") for i in range(4)]
    table = docs(spark, rows).withColumn("pos", F.lit(1)).withColumn("leaf", F.lit("clash"))
    got = op12_merkle.op12_merkle_manifest(spark, table, depth).select(*MANIFEST).collect()
    assert sorted((tuple(r) for r in got), key=str) == manifest_of(table.collect())


def test_manifest_of_one_row_and_of_none(spark):
    one = docs(spark, [(5, "a\nb")])
    (got,) = op12_merkle.op12_merkle_manifest(spark, one).collect()
    assert got.leaf == got.subroot == got.root == leaf(one.first(), "a\nb")
    assert got.proof_sha256 == h([]) and got.verified == (got.folded_root == got.root)
    assert op12_merkle.op12_merkle_manifest(spark, one.limit(0)).count() == 0


PRINTS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def test_fingerprints_of_hostile_documents(spark):
    rng = random.Random(3)
    texts = [" ".join(words(n, n, 300)) for n in (3, 20, 60, 60, 400, 30_000)]
    rows = [(i, rng.choice(texts) + f" own{i}") for i in range(25)]
    rows += [(None, None), (None, None), (None, "é ü"), (4, texts[1]), (4, ""), (4, ""), (90, "..."), (91, ". ."), (92, "x")]
    rows += [(40, texts[2])] * 5
    table = docs(spark, rows).withColumn("row", F.lit(1)).withColumn("cells", F.lit("clash"))
    got = op13_imatch.op13_fingerprints(spark, table).select(*PRINTS).toPandas()
    con = duckdb.connect()
    con.register("documents", table.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(op13_imatch.SQL).fetch_df()[PRINTS]
    both = [f.sort_values(PRINTS).reset_index(drop=True).convert_dtypes() for f in (got, want)]
    pd.testing.assert_frame_equal(*both, rtol=0, atol=0)
    same = got.groupby("edited_sha256")["edited_fingerprint"].nunique()
    assert (same == 1).all() and got["near_edited"].between(0, 1).all()


def test_fingerprints_tell_edits_from_strangers(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op13_imatch.op13_fingerprints(spark, table).filter("n_chars >= 40").toPandas()
    assert (got["near_edited"] > got["near_next"]).mean() > 0.95
    assert got["near_next"].mean() < 0.01


def test_a_level_looks_at_what_the_level_above_kept():
    """So a fingerprint filters a term about twice a seed, not once a subset."""
    assert len(op13_imatch.MASKS) == 1 + op13_imatch.SEEDS * op13_imatch.LEVELS
    masks = iter(op13_imatch.MASKS[1:])
    for bits in op13_imatch.HALVINGS:
        above = 0
        for bit in bits:
            assert bit.bit_count() == 1 and not bit & above
            above |= bit
            assert above == next(masks)


def test_cells_are_hashes_of_the_terms_of_each_subset(spark):
    texts = [" ".join(words(40, i)) for i in range(5)] + [""]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    terms = table.select(F.explode(op13_imatch.terms_of(F.col("text"))).alias("term")).distinct()
    known = {r.term for r in terms.collect() if r.term % 3}
    rows = spark.createDataFrame([(t,) for t in known], "term long")
    lexicon = op13_imatch.as_value(rows, 16).scalar()
    found = op13_imatch.with_cells(table, "text", lexicon, "cells")
    for r in found.select("cells", op13_imatch.terms_of(F.col("text")).alias("terms")).collect():
        kept = sorted(known.intersection(r.terms))
        subsets = [[t for t in kept if not t & mask] for mask in op13_imatch.MASKS]
        want = [hashlib.md5(",".join(map(str, s)).encode()).hexdigest()[:8] if s else "" for s in subsets]
        assert r.cells[:-1] == want and bool(r.cells[-1]) == (not kept)


def test_fingerprints_of_one_row_and_of_none(spark):
    one = docs(spark, [(5, "some words here")])
    (got,) = op13_imatch.op13_fingerprints(spark, one).collect()
    assert got.near_next == 1.0 and got.n_chars == 15
    assert op13_imatch.op13_fingerprints(spark, one.limit(0)).count() == 0


def test_the_lexicon_holds_the_band_only(spark):
    table = spark.createDataFrame([(f"all own{i} " + "some" * (i < 3),) for i in range(30)], "text string")
    found = {r.term for r in op13_imatch.lexicon(table, rarest=15, commonest=10).collect()}
    some = spark.createDataFrame([("some",)], "text string")
    assert found == set(some.select(op13_imatch.terms_of(F.col("text")).alias("t")).first().t)
