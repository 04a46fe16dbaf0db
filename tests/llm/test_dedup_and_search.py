"""Near duplicates, decontamination, exact search: against brute force on small tables."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from iterweave.llm import op06_bottomk, op07_decontamination, op09_threshold
from iterweave.llm.common import shingles, two_word_shingles, words_of
from iterweave.llm.components import connected_components
from tests.llm.helpers import components, docs, words

# --- near duplicates ---------------------------------------------------------


def _brute(rows):
    sets = {i: two_word_shingles(words_of((t or "").encode())) for i, t in rows}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, components(links, sets)


def _changed(text, share, rng):
    out = list(text)
    for i in rng.sample(range(len(out)), max(1, int(share * len(out)))):
        out[i] = f"x{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def near_rows():
    rng, rows = random.Random(5), []
    for group in range(12):
        text = words(rng.choice([3, 6, 9, 20, 60, 200]), group)
        for share in (0, 0.02, 0.05, 0.08, 0.1, 0.11, 0.12, 0.15, 0.3):
            rows.append(" ".join(_changed(text, share, rng) if share else text))
    chain = words(120, 77)  # every step is similar, the ends are not
    for _ in range(8):
        rows.append(" ".join(chain))
        chain = chain[8:] + words(8, rng.randrange(10**6))
    common = words(30, 78)  # unrelated texts around one passage
    rows += [" ".join(words(15, 900 + i) + common + words(15, 950 + i)) for i in range(40)]
    rows += ["one", "One", "two", "", " \n", "a b", "A\tB", "a b a b a", rows[0].upper()]
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("centre_count", [1, 3])
def test_components_match_brute_force(spark, near_rows, centre_count):
    sizes, want = _brute(near_rows)
    got = op06_bottomk.near_duplicates(docs(spark, near_rows), centre_count=centre_count).collect()
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_groups_without_all_pairs(spark, near_rows):
    rng, text = random.Random(6), words(100, 1)
    rows = [(i, " ".join(_changed(text, 0.03, rng))) for i in range(300)]
    made = op06_bottomk.sketches(docs(spark, rows))
    classes = made.selectExpr("doc_id as node", "n_shingles as size", "sketch")
    lists = op06_bottomk.inverted_lists(classes)
    pairs = op06_bottomk.first_pass(lists, op06_bottomk.centres(lists)).count()
    assert pairs < 300 * 20  # of 44,850
    got = op06_bottomk.near_duplicates(docs(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


@pytest.mark.parametrize("measured, formed", [([1, 2], set()), ([1], {(1, 2)})])
def test_pairs_measured_against_one_centre_are_not_formed(spark, measured, formed):
    """Also where the list of their smallest value has another centre, which knows neither."""
    entries = [(value, node, 50, 2) for value, centre in ((1, 9), (2, 3)) for node in (1, 2, centre)]
    lists = spark.createDataFrame(entries, "value long, node long, size long, shared int")
    middle = "value long, centre long, centre_size long, rank int"
    middle = spark.createDataFrame([(1, 9, 50, 1), (2, 3, 50, 1)], middle)
    groups = [(9, 9), (3, 3), *((3, node) for node in measured)]
    groups = spark.createDataFrame(groups, "centre long, node long")
    labels = spark.createDataFrame([], "node long, component long")
    open_ = op06_bottomk.open_lists(lists, labels, middle, groups)
    pairs = {(r.a, r.b) for r in op06_bottomk.pairs_by_lists(open_).collect()}
    assert {p for p in pairs if p == (1, 2)} == formed


def test_near_duplicate_edge_cases(spark):
    rows = [(3, None), (4, ""), (None, "a b c"), (5, "a b c"), (5, "a b c"), (6, "a  b\nC"), (None, None)]
    got = [tuple(r) for r in op06_bottomk.near_duplicates(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(
        [(3, 0, 3, True), (4, 0, 4, True), (None, 2, None, True), (None, 0, None, True),
         (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False)], key=str)
    assert op06_bottomk.near_duplicates(docs(spark, [])).count() == 0


def test_sketch_holds_the_smallest_hashes():
    text = [w.encode() for w in words(500, 3)]
    size, short = op06_bottomk.sketch(text, 32)
    whole_size, whole = op06_bottomk.sketch(text, 10**6)
    assert size == whole_size == len(whole) == len(two_word_shingles(text))
    assert list(short) == sorted(whole)[:32] and op06_bottomk.sketch([], 8)[0] == 0


def test_long_chains_of_links(spark, ws):
    links = [(i, i + 1) for i in range(200)] + [(900, 901), (901, 900), (950, 950)]
    got = connected_components(ws, spark.createDataFrame(links, "a long, b long")).collect()
    want = components(links, {x for link in links for x in link})
    assert {r.node: r.component for r in got} == want


# --- decontamination ---------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _normal(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _hits(text, items, window=13):
    found, hit, names = _normal(text), set(), set()
    for name, item in items:
        w = _normal(item)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            part = w[a : a + window]
            for at in range(len(found) - len(part) + 1):
                if found[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    if name is not None:
                        names.add(str(name))
    return len(found), sorted(hit), sorted(names)


@pytest.fixture(scope="module")
def contaminated_tables(spark):
    rng = random.Random(8)
    # A small vocabulary makes items, and short items inside items, overlap a lot.
    items = [(i, " ".join(words(rng.choice([1, 2, 3, 5, 12, 13, 14, 20, 40]), i, 6))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "..."), (33, items[0][1]), (33, items[1][1]), (None, "W1, w2 W3")]
    rows = [(i, " ".join(words(rng.choice([0, 1, 5, 30, 200]), 500 + i, 7))) for i in range(60)]
    rows += [(70 + i, f"Été, {t.upper()}; z\x00é" if t else None) for i, (_, t) in enumerate(items)]
    return items, rows


@pytest.mark.parametrize("block_words", [10**6, 25])
def test_hits_match_brute_force(spark, contaminated_tables, block_words):
    items, rows = contaminated_tables
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = op07_decontamination.contamination(docs(spark, rows), benchmark, block_words=block_words)
    assert "size" in found.columns
    for r in found.select("doc_id", "_n_words", "_spans", "_items").collect():
        hit = [w for s in r._spans for w in range(s.first, s.end)]
        assert (r._n_words, hit, r._items) == _hits(dict(rows)[r.doc_id], items), r.doc_id


def test_spans_go_and_contaminated_documents_go(spark):
    item = " ".join(words(20, 1))
    clean = " ".join(words(800, 2))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, clean), (2, f"{clean}. {item.upper()}! {clean}"), (3, f"so: {item}"), (4, None), (5, clean)]
    got = {r.doc_id: r for r in op07_decontamination.decontaminate(docs(spark, rows), benchmark).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[1].text == clean and got[4].text is None
    assert got[2].text == f"{clean}. ! {clean}" and got[2].n_chars == len(got[2].text)
    none = op07_decontamination.decontaminate(docs(spark, rows), benchmark.limit(0))
    assert none.count() == 5
    assert op07_decontamination.decontaminate(docs(spark, []), benchmark).count() == 0


# --- exact search ------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, score int"


def _brute_top(rows, k=10):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    ints = {(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v, *_ in rows if i is not None and usable(v)}
    out = set()
    for q, a in ints:
        if q % 100 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), c) for c, b in ints if c != q]
            out |= {(q, n, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k], 1)}
    return out


def _top(spark, rows):
    made = op09_threshold.integer_vectors(spark.createDataFrame(rows, VECTORS))
    found = op09_threshold.top_k(made, made.filter("vec_id % 100 = 0"), candidates_per_block=30, queries_per_block=2)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_top_k_matches_brute_force(spark):
    rng = random.Random(2)
    # Coarse components make many ties.
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(6)], 0, 1) for i in range(501)]
    assert _top(spark, rows) == _brute_top(rows)


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0, 0), (0, [1.0, 2.0], 0, 0), (1, None, 0, 0), (2, [None, 1.0], 0, 0), (3, [nan], 0, 0),
        (4, [inf, 0.0], 0, 0), (5, [], 0, 0), (6, [1.0], 0, 0), (7, [0.0, -1.0, 5.0], 0, 0), (None, [1.0], 0, 0),
        (100, [0.0, 0.0], 0, 0), (-200, [1e6, -1e6], 0, 0),
    ]
    assert _top(spark, rows) == _brute_top(rows)
    assert _top(spark, rows[:1]) == set()
    assert op09_threshold.op9_exact_top_k(spark, spark.createDataFrame([], VECTORS)).count() == 0


def test_a_floor_ends_the_search():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-5, 5, (5000, 4))
    query = np.array([3, -2, 1, 4])
    block = op09_threshold.Block(np.arange(5000), vectors)
    ids, scores, _ = block.top(-1, query, 10)
    for floor in (int(scores[4]), int(scores[0]) + 1):
        fewer, reached, scored = block.top(-1, query, 10, floor)
        assert list(fewer) == [i for i, s in zip(ids, scores, strict=True) if s >= floor]
        assert all(reached >= floor) and scored <= 5000
    assert block.top(-1, query, 10, 10**6)[2] < 500


def test_search_stops_early():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-5, 5, (5000, 4))
    vectors[:20] += 200
    block = op09_threshold.Block(np.arange(5000), vectors)
    ids, scores, scored = block.top(-1, np.array([3, 2, 1, 4]), 10)
    assert scored < 500
    best = np.lexsort((np.arange(5000), -(vectors @ [3, 2, 1, 4])))[:10]
    assert list(ids) == list(best) and list(scores) == list((vectors @ [3, 2, 1, 4])[best])


def test_five_word_shingles_keep_what_two_words_link(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    sets = {r.doc_id: shingles(words_of((r.text or "").encode()), 5) for r in table.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = op06_bottomk.near_duplicates(table, width=5).collect()
    assert links and {r.doc_id: r.component_id for r in got} == components(links, sets)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert sum(r.kept for r in got) > sum(r.kept for r in op06_bottomk.near_duplicates(table).collect())
    few = [b"a", b"b", b"a"]
    assert op06_bottomk.sketch(few, width=5)[0] == len(shingles(few, 5)) == 1
