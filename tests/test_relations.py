"""Improving relations, programs over several relations, and what their rounds write."""

from __future__ import annotations

import heapq
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from iterweave.operators.ordering import positions
from iterweave.operators.orders import Least
from iterweave.plans import cores, lca, reach
from iterweave.plans.fixpoint import NotConverged, subtract_known
from iterweave.plans.relations import Best, Growing, Improving, do_while, holds_rows, improve_until_fixed
from iterweave.tuning import Tuning
from iterweave.workspace import Workspace
from tests.conftest import rows
from tests.test_cores import EDGE, both, hub_graph, peel
from tests.test_lca import LINK, PAPER, SEED, brute, hops

PAIR = "seed long, vertex long"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_round_moves_what_it_found_and_nothing_that_is_known(ws, table, no_broadcasts):
    found = table([(1, 2), (1, 2), (7, 8)], PAIR)
    log = ws.keyed_rounds("reach", found.schema, ["seed", "vertex"])
    for number in range(4):
        assert log.append(table([(i, number) for i in range(5)], PAIR), number)["rows"] == 5
    new = subtract_known(found, log.read(0, 3), log.keys)
    assert rows(new) == [(7, 8)]
    plan = plan_of(subtract_known(found, log.read(0, 3), log.keys))
    above_scan = plan[: plan.index("FileScan")].splitlines()
    assert plan.count("Exchange") == 1 and "Exchange" not in above_scan[-1]
    assert sum("Bucketed: true" in line for line in plan.splitlines()) == 1
    assert rows(log.read(2), "seed", "vertex") == [(i, 2) for i in range(5)]
    assert rows(log.read(1, 0)) == []


def test_merging_an_improving_relation_moves_nothing(ws, table, no_broadcasts):
    best = Improving(ws, "best", table([(1, 9), (2, 9)], "k long, v long"), Least(["k"], ["v"]))
    assert best.improve(table([(1, 7), (1, 8), (2, 10), (3, 1)], "k long, v long")) == 2
    assert "Exchange" not in plan_of(best.read())
    assert rows(best.read()) == [(1, 7), (2, 9), (3, 1)]
    assert rows(best.delta()) == [(1, 7), (3, 1)]


def test_improvements_are_folded_when_they_outgrow_the_relation(ws, table):
    start = table([(k, 100) for k in range(4)], "k long, v long")
    best = Improving(ws, "best", start, Least(["k"], ["v"]))
    for value in range(99, 80, -1):
        assert best.improve(table([(k, value) for k in range(3)], "k long, v long")) == 3
        assert rows(best.delta()) == [(k, value) for k in range(3)]
        assert rows(best.read()) == [(0, value), (1, value), (2, value), (3, 100)]
        held = best.log.read(0, best.round).count()
        assert held <= 3 * 4 + 3


def dijkstra(links, seed):
    done, queue = {}, [(w, 1, b) for a, b, w in links if a == seed]
    heapq.heapify(queue)
    while queue:
        cost, n, v = heapq.heappop(queue)
        if v not in done:
            done[v] = cost, n
            for a, b, w in links:
                if a == v and b not in done:
                    heapq.heappush(queue, (cost + w, n + 1, b))
    return {(seed, v, *best) for v, best in done.items()}


WEIGHTED = "src long, dst long, weight long"


def test_costs_fall_again_in_later_rounds(any_ws, table):
    # The direct link is found first and is the dearest; each round finds a cheaper way.
    links = [(0, 9, 100)] + [(i, i + 1, 1) for i in range(8)] + [(i, 9, 50 - i) for i in range(1, 9)]
    got = rows(reach.cheapest_paths(any_ws, table(links, WEIGHTED), table([(0,)], SEED)))
    assert set(got) == dijkstra(links, 0)
    assert [(s, v, c) for s, v, c, _ in got if v == 9] == [(0, 9, 50)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cheapest_paths_of_random_networks(large_ws, table, seed):
    rng = random.Random(seed)
    links = {(rng.randrange(20), rng.randrange(20)): rng.randrange(1, 9) for _ in range(70)}
    links = [(a, b, w) for (a, b), w in links.items()]
    seeds = [0, 3, 3, 5, 99]
    got = rows(reach.cheapest_paths(large_ws, table(links, WEIGHTED), table([(s,) for s in seeds], SEED)))
    assert set(got) == {row for s in seeds for row in dijkstra(links, s)}
    assert len(got) == len(set(got))


def test_a_loop_that_never_settles_is_an_error(ws, table):
    start, order = table([(1, 0)], "k long, v long"), Least(["k"], ["v"])
    with pytest.raises(NotConverged):
        improve_until_fixed(ws, start, lambda d: d.withColumn("v", F.col("v") - 1), order, max_rounds=2)
    with pytest.raises(NotConverged):
        do_while(ws, {"a": start}, [("a", lambda p, _: p["a"])], lambda p: holds_rows(p["a"]), max_rounds=2)


@pytest.mark.parametrize("block", [1, 4, 32])
def test_distance_vectors_in_blocks(any_ws, table, block):
    rng = random.Random(block)
    links = [(rng.randrange(25), rng.randrange(25)) for _ in range(60)]
    seeds = rng.sample(range(30), 11)
    vectors, numbered = reach.distance_vectors(any_ws, table(links, LINK), table([(s,) for s in seeds], SEED), block)
    order = {seed: i for i, seed in enumerate(sorted(seeds))}
    assert {(r.seed, r.block * block + r.slot) for r in numbered.collect()} == set(order.items())
    found = hops(links, seeds, include_self=True)
    want = {(v, order[s] // block, order[s] % block, d) for s in seeds for v, d in found[s].items()}
    held = vectors.collect()
    assert all(len(r.depths) == block for r in held)
    got = {(r.vertex, r.block, i, d) for r in held for i, d in enumerate(r.depths) if d is not None}
    assert got == want and len(held) == len({(v, b) for v, b, _, _ in want})
    text = {(r.vertex, r.block): (r.seeds, r.depths) for r in reach.vector_text(vectors).collect()}
    for r in held:
        entries = [f"{i}:{d}" for i, d in enumerate(r.depths) if d is not None]
        assert text[r.vertex, r.block] == (len(entries), ",".join(entries))


@pytest.mark.parametrize("seed_block", [1, 4, 512])
def test_a_search_writes_a_row_per_vertex_and_block_of_seeds(spark, table, seed_block):
    links = [(s, 100) for s in range(12)] + [(100, 101), (101, 3)]
    with Workspace(spark, tuning=Tuning(seed_block=seed_block, hot_key_rows=3)) as ws:
        search = reach._search(ws, table(links, LINK), table([(s,) for s in range(12)], SEED), 1, None)
        assert search.found == {1: 12, 2: 12, 3: 12}
        blocks = -(-12 // seed_block)
        assert search.log.read(1).count() == search.log.read(2).count() == blocks
        found = hops(links, range(12), include_self=False)
        want = sorted((s, v, d) for s in found for v, d in found[s].items())
        assert rows(search.pairs(), "seed", "vertex", "d") == want


def random_papers(seed):
    rng = random.Random(seed)
    papers = [(i, rng.choice([1990, 1991, 1992, 1993])) for i in range(24)]
    links = [(rng.randrange(26), rng.randrange(26)) for _ in range(80)]
    return papers, links, rng.sample(range(24), 7)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_program_of_relations_gives_the_least_common_ancestors(any_ws, table, seed):
    papers, links, seeds = random_papers(seed)
    found = lca.lca_program(any_ws, table(papers, PAPER), table(links, LINK), table([(s,) for s in seeds], SEED))
    assert rows(found) == sorted(brute(papers, links, seeds))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_nearest_ancestor_by_the_sum_of_hops(any_ws, table, seed):
    papers, links, seeds = random_papers(seed)
    # A late meeting in the middle beats an early one that is far from one seed.
    papers += [(100 + i, 1990) for i in range(10)]
    links += [(100, 101), (101, 102), (102, 109), (103, 109), (100, 104), (104, 105), (105, 106), (103, 107), (107, 106)]
    seeds += [100, 103]
    found = lca.nearest_common_ancestors(
        any_ws, table(papers, PAPER), table(links, LINK), table([(s,) for s in seeds], SEED)
    )
    year, seeds = dict(papers), sorted(seeds)
    kept = {(a, b) for a, b in links if a != b and a in year and b in year and year[a] >= year[b]}
    near, want = hops(kept, seeds, include_self=False), []
    for i, a in enumerate(seeds):
        for b in seeds[i + 1 :]:
            shared = [(near[a][v] + near[b][v], year[v], v) for v in set(near[a]) & set(near[b])]
            if shared:
                total, y, v = min(shared)
                want.append((a, b, v, total, y, near[a][v], near[b][v]))
    assert rows(found) == sorted(want)


def test_statements_see_the_ones_before_them(ws, table):
    one = "x long"
    program = do_while(
        ws,
        {
            "last": table([(1,)], one),
            "all": Growing(table([(0,)], one), ["x"]),
            "top": Best(table([(0, 0)], "k long, v long"), Least(["k"], ["v"])),
        },
        [
            ("all", lambda p, _: p["last"]),
            ("last", lambda p, n: p["last"].select((F.col("x") * 2).alias("x")).filter(f"{n} < 4")),
            ("top", lambda p, _: p["all"].agg((-F.max("x")).alias("v")).withColumn("k", F.lit(0).cast("long"))),
        ],
        lambda p: holds_rows(p["last"]),
    )
    assert rows(program["all"]) == [(0,), (1,), (2,), (4,), (8,)]
    assert rows(program["last"]) == [] and rows(program["top"]) == [(0, -8)]
    assert program.rows == {"last": 0, "all": 1, "top": 1}


def network(table, rounds=8):
    edges = hub_graph(rounds)
    return edges, table(both(edges), EDGE)


@pytest.mark.parametrize("k", [2, 3, 4])
def test_peeling_writes_what_it_takes_away(large_ws, table, k):
    edges, df = network(table)
    degrees, adjacency = cores._peel(large_ws, cores._unit_weights(df), k)
    alive, left = {v for e in edges for v in e}, set(edges)
    want = [len(alive)]
    while True:
        degree = Counter(v for e in left for v in e)
        gone = {v for v in alive if degree[v] < k}
        if not gone:
            break
        hit = {v for e in left if set(e) & gone for v in e} - gone
        alive, left = alive - gone, {e for e in left if not set(e) & gone}
        want.append(len(hit))
    # Losses of vertices that are still there; a last round may touch none.
    assert degrees.written == want
    assert rows(cores._alive(degrees)) == sorted(Counter(v for e in peel(edges, k) for v in e).items())


def test_claims_write_their_falls_only(large_ws, table):
    edges, df = network(table)
    claims, _ = cores._core_numbers(large_ws, cores._unit_weights(df))
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    core, want = {v: len(n) for v, n in near.items()}, [len(near)]
    while True:
        lower = {}
        for v, n in near.items():
            theirs = sorted((core[x] for x in n), reverse=True)
            lower[v] = max(min(c, i) for i, c in enumerate(theirs, 1))
        want.append(sum(lower[v] < core[v] for v in core))
        core = {v: min(core[v], c) for v, c in lower.items()}
        if not want[-1]:
            break
    assert claims.written == want
    assert rows(claims.read(), "vertex", "core") == sorted(core.items())


def test_a_range_of_cores_is_less_work(large_ws, table):
    edges, df = network(table)
    whole, _ = cores._core_numbers(large_ws, cores._unit_weights(df))
    top = max(c for _, c in rows(whole.read(), "vertex", "core"))
    part, _ = cores._core_numbers(large_ws, cores._unit_weights(df), kmin=2, kmax=top - 1)
    assert sum(part.written) < sum(whole.written) and len(part.written) <= len(whole.written)
    deep = [(v, min(c, top - 1)) for v, c in rows(whole.read(), "vertex", "core") if c >= 2]
    assert rows(part.read(), "vertex", "core") == deep
    sizes = rows(cores.core_sizes(large_ws, df))
    for kmin, kmax in [(1, 1), (2, top - 1), (top, None), (top + 1, None)]:
        want = [s for s in sizes if kmin <= s[0] <= (kmax or top)]
        assert rows(cores.core_sizes(large_ws, df, kmin, kmax)) == want


def test_positions(ws, table):
    rng = random.Random(2)
    data = [(g, rng.randrange(30), rng.random()) for g in ("a", "b", "b") for _ in range(60)]
    df = table(data, "g string, x int, y double").repartition(5)
    whole = positions(ws, df, ["x", "g", "y"]).collect()
    ordered = sorted((r.pos, r.x, r.g, r.y) for r in whole)
    assert [r[0] for r in ordered] == list(range(len(data)))
    assert [r[1:] for r in ordered] == sorted((x, g, y) for g, x, y in data)
    grouped = positions(ws, df, ["x", "y"], "g").collect()
    assert sorted((r.g, r.pos, r.size) for r in grouped) == [
        (g, i, n) for g, n in (("a", 60), ("b", 120)) for i in range(n)
    ]
