from __future__ import annotations

import random
from collections import Counter

import pytest

from iterweave.operators.degrees import (
    degree_filter,
    graph_size,
    vertex_degree,
    vertex_degree_in_out,
)
from iterweave.plans import cores
from iterweave.sources.graph import symmetrize
from tests.conftest import rows

EDGE = "u long, v long"
TRIANGLE_WITH_TAIL = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6)]
CLIQUE = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def both(edges):
    return sorted({e for a, b in edges for e in ((a, b), (b, a))})


def peel(edges, k):
    """Directed multigraph edges left when degree counts both directions."""
    left = list(edges)
    while True:
        degree = Counter(v for e in left for v in e)
        kept = [e for e in left if degree[e[0]] >= k and degree[e[1]] >= k]
        if len(kept) == len(left):
            return sorted(kept)
        left = kept


def hub_graph(seed=3):
    """A random graph with one vertex on a third of all edges."""
    rng = random.Random(seed)
    edges = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(70)}
    edges |= {(0, i) for i in range(1, 36)}
    return sorted(edges)


def test_cascade_reaches_the_true_core(ws, table):
    network = table(both(TRIANGLE_WITH_TAIL), EDGE)
    assert rows(cores.kcore_edges(ws, network, 2)) == both([(1, 2), (2, 3), (3, 1)])
    assert rows(cores.kcore_vertices(ws, network, 2)) == [(1, 2), (2, 2), (3, 2)]
    one_pass = rows(degree_filter(network, 2))
    assert (5, 6) in one_pass and (6, 5) not in one_pass


def test_degree_exactly_k(ws, table):
    network = table(both(CLIQUE), EDGE)
    assert rows(cores.kcore_edges(ws, network, 3)) == both(CLIQUE)
    assert rows(cores.kcore_edges(ws, network, 4)) == []


@pytest.mark.parametrize("k", [2, 4])
def test_random_graph_with_a_hub(large_ws, table, k):
    edges = hub_graph()
    got = rows(cores.kcore_edges(large_ws, table(both(edges), EDGE), k))
    assert got == both(peel(edges, k))


def test_core_numbers_and_sizes(large_ws, table):
    edges = hub_graph(8)
    network = table(both(edges), EDGE)
    numbers = dict(rows(cores.core_numbers(large_ws, network)))
    sizes, by_k, k = [], [], 1
    while left := peel(edges, k):
        vertices = {v for e in left for v in e}
        assert {v for v, c in numbers.items() if c >= k} == vertices
        sizes.append((k, len(vertices), len(left)))
        by_k += [(k, a, b) for a, b in left]
        k += 1
    assert max(numbers.values()) == k - 1
    assert rows(cores.core_sizes(large_ws, network)) == sizes
    assert rows(cores.core_sizes(large_ws, network, 2, 3)) == [s for s in sizes if s[0] in (2, 3)]
    assert rows(cores.core_edges_by_k(large_ws, network)) == sorted(by_k)
    assert rows(cores.core_edges_by_k(large_ws, network, 2, 2)) == sorted(e for e in by_k if e[0] == 2)


def test_large_and_small_plans_agree(ws, table):
    edges = hub_graph(8)
    got = dict(rows(cores.core_numbers(ws, table(both(edges), EDGE))))
    top = max(got.values())
    assert {v for v, c in got.items() if c == top} == {v for e in peel(edges, top) for v in e}
    assert rows(cores.kcore_edges(ws, table(both(edges), EDGE), top)) == both(peel(edges, top))


def test_core_sizes_with_a_gap(ws, table):
    """Core numbers 1 and 3 only: the 2-core exists and equals the 3-core."""
    network = table(both(CLIQUE + [(10, 11)]), EDGE)
    assert rows(cores.core_sizes(ws, network)) == [(1, 6, 7), (2, 4, 6), (3, 4, 6)]


@pytest.mark.parametrize("k", [3])
def test_in_out_counts_parallel_edges(large_ws, table, k):
    rng = random.Random(9)
    follows = [(rng.randrange(15), rng.randrange(15)) for _ in range(40)]
    follows += [(1, 2)] * 4 + [(2, 1)] * 2 + [(0, 0)] * 3
    expected = peel([e for e in follows if e[0] != e[1]], k)
    assert rows(cores.kcore_in_out(large_ws, table(follows, EDGE), k)) == expected


def test_empty_network(large_ws, table):
    network = table([], EDGE)
    assert rows(cores.kcore_edges(large_ws, network, 2)) == []
    assert rows(cores.core_sizes(large_ws, network)) == []
    assert rows(graph_size(network)) == [(0, 0)]


def test_degrees(table):
    follows = [(1, 2), (1, 2), (2, 3), (3, 1)]
    assert rows(vertex_degree_in_out(table(follows, EDGE))) == [(1, 3), (2, 3), (3, 2)]
    network = symmetrize(table(follows, EDGE))
    assert rows(vertex_degree(network)) == [(1, 2), (2, 2), (3, 2)]
    assert rows(graph_size(network)) == [(3, 3)]


@pytest.mark.parametrize("hot", [2, 1000])
def test_degree_filter_with_hot_sources(table, hot):
    network = both(hub_graph())
    degree = Counter(u for u, _ in network)
    expected = [e for e in network if degree[e[0]] >= 4]
    assert rows(degree_filter(table(network, EDGE), 4, hot_key_rows=hot)) == expected


def test_neighbours_are_asked_once(spark, ws, table, monkeypatch):
    """After the first round only vertices that fell send anything along their edges."""
    from iterweave.operators.adjacency import Adjacency

    sent, out_of = [], Adjacency.out_of

    def counted(self, frontier, vertex):
        sent.append(frontier.count())
        return out_of(self, frontier, vertex)

    path = [(i, i + 1) for i in range(12)] + [(12 + a, 12 + b) for a, b in CLIQUE]
    monkeypatch.setattr(Adjacency, "out_of", counted)
    numbers = dict(rows(cores.core_numbers(ws, table(both(path), EDGE))))
    assert numbers == {v: 3 if v >= 12 else 1 for v in range(16)}
    # All 16 claim; then 12 falls to 3, and the path falls from its free end to the clique.
    assert sent[0] == 16 and sum(sent[1:]) == 12


def test_core_files_from_runs(ws, table, tmp_path):
    """Every edge moves once per few ks; a small core still makes one file."""
    from iterweave import sinks

    runs = [(1, 1 + i % 7, i, i + 1) for i in range(210)]
    path = tmp_path / "cores"
    sinks.write_core_edges(table(runs, "low long, high long, u long, v long"), str(path), 70)
    read = ws.spark.read.schema("u long, v long, k long").option("sep", "\t").csv(str(path))
    assert rows(read, "k", "u", "v") == sorted((k, u, v) for a, b, u, v in runs for k in range(a, b + 1))
    for k in range(1, 8):
        held = sum(b >= k for _, b, _, _ in runs)
        assert 1 <= len(list(path.glob(f"k={k}/*.csv"))) <= -(-held // 70)


def test_edges_stay_in_place(ws, table):
    """A round moves its frontier, never the edges it is joined with."""
    from iterweave.operators.adjacency import Adjacency

    edges = table([(a, a + 1, 1) for a in range(20)], "src long, dst long, w long")
    adjacency = Adjacency.build(ws, edges, "src")
    out = adjacency.out_of(table([(3,), (4,)], "vertex long").hint("merge"), "vertex")
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(src" in line]
    assert "SortMergeJoin" in plan and len(moved) == 1
    assert rows(out) == [(3, 4, 1), (4, 5, 1)]
