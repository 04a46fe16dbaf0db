from __future__ import annotations

import random
from collections import Counter

import pytest

from iterweave.plans import mergertree as m
from tests.conftest import rows

POI = "nowGroup string, iOrder long, timestep long, grp long"
HALO = "nowGroup string, grpID long, timeStep long, totalParticles long"


def world(paths, universe="a"):
    """poi rows and halo sizes from {(group per step, ...): number of particles}."""
    poi, sizes, particle = [], {}, 0
    for path, count in paths.items():
        for _ in range(count):
            particle += 1
            for step, grp in enumerate(path, start=1):
                if grp is not None:
                    poi.append((universe, particle, step, grp))
                    sizes[universe, grp, step] = sizes.get((universe, grp, step), 0) + 1
    return poi, [(u, g, t, n) for (u, g, t), n in sizes.items()]


def tree(ws, table, poi, halos, particles=0, shared=0, **options):
    edges = m.merger_tree(
        ws,
        table(poi, POI),
        table(halos, HALO),
        min_particles=particles,
        min_shared=shared,
        **options,
    )
    return rows(edges)


def test_thresholds_are_strict(table):
    halos = table([("a", 1, 1, 256), ("a", 2, 1, 257)], HALO)
    assert rows(m.significant_halos(halos), "grpID") == [(2,)]
    transitions = table([("a", 1, 1, 1, 256), ("a", 1, 1, 2, 257)], ", ".join(
        f"{c} {'string' if c == 'nowGroup' else 'long'}" for c in m.EDGE
    ))
    assert rows(m.weighted_edges(transitions), "nextGroup") == [(2,)]


def test_diamond_keeps_each_edge_once(ws, table):
    poi, halos = world({(1, 2, 4, 5): 2, (1, 3, 4, 5): 3})
    assert tree(ws, table, poi, halos) == [
        ("a", 1, 1, 2, 2),
        ("a", 1, 1, 3, 3),
        ("a", 2, 2, 4, 2),
        ("a", 2, 3, 4, 3),
        ("a", 3, 4, 5, 5),
    ]


def test_broken_chain_is_left_out(ws, table):
    poi, halos = world({(1, 1, 1, 1): 5, (None, None, 7, 8): 5})
    assert [e for e in tree(ws, table, poi, halos) if e[2] == 7] == []


def test_universes_do_not_mix(ws, table):
    poi_a, halos_a = world({(1, 2, 3): 2}, "a")
    poi_b, halos_b = world({(9, 8, None): 2, (None, 2, 4): 2}, "b")
    poi_b = [(u, p + 100, t, g) for u, p, t, g in poi_b]
    got = tree(ws, table, poi_a + poi_b, halos_a + halos_b)
    assert ("b", 2, 2, 4, 2) not in got
    assert ("a", 2, 2, 3, 2) in got


def test_light_edges_are_followed_only_on_request(ws, table):
    poi, halos = world({(1, 2, 3): 1, (1, 2, 4): 3, (5, 6, 7): 1})
    filtered = tree(ws, table, poi, halos, shared=2)
    assert filtered == [("a", 1, 1, 2, 4), ("a", 2, 2, 4, 3)]
    followed = tree(ws, table, poi, halos, shared=2, recurse_on="all")
    assert followed == [("a", 1, 1, 2, 4), ("a", 2, 2, 3, 1), ("a", 2, 2, 4, 3)]
    with pytest.raises(ValueError, match="recurse_on"):
        tree(ws, table, poi, halos, recurse_on="some")


def test_repeated_particle_rows_multiply_like_a_join(table):
    particles = table(
        [("a", 1, 1, 1)] * 3 + [("a", 1, 2, 2)] * 2 + [("a", 1, 2, 3)], POI
    )
    assert rows(m.snapshot_transitions(particles)) == [("a", 1, 1, 2, 6), ("a", 1, 1, 3, 3)]


def test_no_particles(ws, table):
    assert tree(ws, table, [], []) == []


def test_max_time_next_to_every_halo(table):
    halos = table([("a", 1, 1, 5), ("a", 1, 4, 5)], HALO)
    assert rows(m.max_timestep(halos)) == [(4,)]
    assert rows(m.halos_with_max_time(halos), "timeStep", "maxT") == [(1, 4), (4, 4)]


def test_steps_meet_where_their_particle_is(spark, table):
    rng = random.Random(4)
    data = [("a", rng.randrange(6), rng.choice([1, 2, 3, 5]), rng.randrange(3)) for _ in range(80)]
    particles = table(data, "nowGroup string, iOrder long, timestep long, grp long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = m.snapshot_transitions(particles)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = rows(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange deals out the particles, the other the counts.
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    want = Counter((g, t, a, b) for g, i, t, a in data for h, j, u, b in data if (h, j, u) == (g, i, t + 1))
    assert got == sorted((*k, n) for k, n in want.items())
