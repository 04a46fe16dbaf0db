"""The same queries as SQL, written against the relational definition of each operator.

Loops are recursive queries keyed on what they discover, and core numbers come from the
neighbour-claim fixpoint, so no oracle mirrors the rounds of the Spark program it checks.
"""

from __future__ import annotations

import re

from iterweave.plans.reach import VECTOR_BLOCK
from iterweave.registry import FIRST_SEEDS, SAMPLE_RATE

# Thresholds that follow the data, as in the registry.
K = "(select ceil(count(*) / (2.0 * count(distinct u))) from network)"
K_IN_OUT = "(select ceil(count(*) / (2.0 * count(distinct u))) from ends)"
MIN_PARTICLES = "(select sum(totalParticles) // count(*) from halos)"
MIN_SHARED = "(select sum(sharedParticleCount) // count(*) from transitions)"


def _reach(name: str, links: str, start: str) -> str:
    return f"""{name}(seed, vertex, d) using key (seed, vertex) as (
  {start}
  union
  select distinct r.seed, c.p2, r.d + 1
  from {name} r join {links} c on c.p1 = r.vertex
  where not exists (select 1 from recurring.{name} k
                    where k.seed = r.seed and k.vertex = c.p2))"""


def _hops(links: str) -> str:
    return f"""select s.id, c.p2, cast(1 as bigint)
  from seeds s join {links} c on c.p1 = s.id group by all"""


def _claims(name: str, edges: str) -> str:
    """Core numbers: a vertex claims the largest h with h neighbour claims of h or more."""
    return f"""{name}(v, c) using key (v) as (
  select u, cast(count(*) as bigint) from {edges} group by u
  union
  select n.v, n.c
  from (select u as v, cast(coalesce(max(least(rk, c)), 0) as bigint) as c
        from (select e.u, k.c,
                     row_number() over (partition by e.u order by k.c desc) as rk
              from {edges} e join recurring.{name} k on k.v = e.v)
        group by u) n
  join recurring.{name} o on o.v = n.v
  where n.c < o.c)"""


def _tree(name: str, followed: str) -> str:
    return f"""{name} as (
  select nowGroup, currentTime, currentGroup, nextGroup, sharedParticleCount
  from weighted where currentTime = 1
  union
  select e.nowGroup, e.currentTime, e.currentGroup, e.nextGroup, e.sharedParticleCount
  from {name} t join {followed} e
    on e.nowGroup = t.nowGroup and e.currentGroup = t.nextGroup
   and e.currentTime = t.currentTime + 1)"""


def _common(reach: str, papers: str = "papers") -> str:
    return f"""select a.seed as p1, b.seed as p2, a.vertex as ca, p.year, a.d as d1, b.d as d2
  from {reach} a join {reach} b on a.vertex = b.vertex and a.seed < b.seed
  join {papers} p on p.id = a.vertex"""


def _lca(reach: str, year: str = "year", papers: str = "papers") -> str:
    return f"""select p1, p2, ca, greatest(d1, d2) as depth, year, d1, d2
from (select *, row_number() over (partition by p1, p2
                                   order by greatest(d1, d2), {year}, ca) as pick
      from ({_common(reach, papers)}))
where pick = 1"""


# Named relations; a query gets the ones it mentions, and the ones those mention.
VIEWS = {
    "papers": """papers as (
  select p_partkey as id, cast(1950 + p_size as bigint) as year from part)""",
    "seeds": """seeds as (
  select id from papers where year = (select max(year) from papers))""",
    "citations_raw": """citations_raw as materialized (
  select l.l_partkey as p1, x.p2
  from lineitem l
  join (select l_orderkey as o, l_linenumber as n, l_partkey as p2 from lineitem) x
    on x.o = l.l_orderkey and x.n = l.l_linenumber + 1)""",
    # Orders are cited too, and have no paper rows.
    "citations_orders": """citations_orders as materialized (
  select p1, p2 from citations_raw
  union
  select l_partkey, l_orderkey + (select max(p_partkey) from part) from lineitem)""",
    "papers_implicit": """papers_implicit as materialized (
  select id, year from papers
  union all
  select distinct id, cast(0 as bigint) from (select p1 as id from citations_orders
                                              union select p2 from citations_orders)
  where id not in (select id from papers))""",
    "citations_implicit": """citations_implicit as materialized (
  select distinct c.p1, c.p2
  from citations_orders c join papers_implicit p on p.id = c.p1 join papers_implicit q on q.id = c.p2
  where p.year >= q.year and c.p1 <> c.p2)""",
    "citations_any": """citations_any as materialized (
  select distinct c.p1, c.p2
  from citations_raw c join papers p on p.id = c.p1 join papers q on q.id = c.p2
  where c.p1 <> c.p2)""",
    "citations": """citations as materialized (
  select distinct c.p1, c.p2
  from citations_raw c join papers p on p.id = c.p1 join papers q on q.id = c.p2
  where p.year >= q.year and c.p1 <> c.p2)""",
    "follows": """follows as materialized (
  select p1 as u, p2 as v from citations_raw where p1 <> p2)""",
    "network": """network as materialized (
  select u, v from follows union select v, u from follows)""",
    "ends": """ends as materialized (
  select u, v from follows union all select v, u from follows)""",
    "poi": """poi as materialized (
  select c_mktsegment as nowGroup, iOrder, timestep, grp
  from (select o_custkey as iOrder, cast(year(o_orderdate) - 1994 as bigint) as timestep,
               cast(substr(o_orderpriority, 1, 1) as bigint) as grp,
               row_number() over (partition by o_custkey, year(o_orderdate)
                                  order by o_orderdate desc, o_orderkey desc) as rn
        from orders) join customer on c_custkey = iOrder
  where rn = 1)""",
    "halos": """halos as (
  select nowGroup, grp as grpID, timestep as timeStep, count(*) as totalParticles
  from poi group by nowGroup, grp, timestep)""",
    "big_halos": f"""big_halos as (
  select * from halos where totalParticles > {MIN_PARTICLES})""",
    "particles": """particles as (
  select p.nowGroup, p.iOrder, p.timestep, p.grp
  from poi p join big_halos h
    on h.nowGroup = p.nowGroup and h.grpID = p.grp and h.timeStep = p.timestep)""",
    "transitions": """transitions as materialized (
  select a.nowGroup, a.timestep as currentTime, a.grp as currentGroup, b.grp as nextGroup,
         count(*) as sharedParticleCount
  from particles a join particles b
    on b.nowGroup = a.nowGroup and b.iOrder = a.iOrder and b.timestep = a.timestep + 1
  group by all)""",
    "weighted": f"""weighted as (
  select * from transitions where sharedParticleCount > {MIN_SHARED})""",
    "raw_lines": """raw_lines as (
  select case p_size
           when 1 then 'x' || cast(p_partkey as varchar) || ',1999'
           when 2 then cast(p_partkey as varchar) || ',1999,extra'
           when 3 then cast(p_partkey as varchar)
           else cast(p_partkey as varchar) || ',' || cast(1950 + p_size as varchar)
         end as line
  from part)""",
    "fields": """fields as (
  select string_split(line, ',') as f, regexp_full_match(f[1], '[0-9]+')
         and coalesce(regexp_full_match(f[2], '[0-9]+'), false) as numbers
  from raw_lines)""",
    "log_lines": """log_lines as (
  select l_orderkey as run_id,
         case when l_returnflag = 'R' then 'user' else 'real' end || chr(9)
         || cast(l_linenumber as varchar) || 'm'
         || cast(cast(l_quantity as integer) as varchar) || 's' as line
  from lineitem)""",
    "weighted_links": """weighted_links as materialized (
  select c.p1, c.p2, w.weight
  from citations c join (
    select l.l_partkey as p1, x.l_partkey as p2, cast(min(l.l_quantity) as bigint) as weight
    from lineitem l join lineitem x
      on x.l_orderkey = l.l_orderkey and x.l_linenumber = l.l_linenumber + 1
    group by all) w using (p1, p2))""",
    # Cost and hops in one number: the least of it has the least cost, then the fewest hops.
    "costs": """costs(seed, vertex, price) using key (seed, vertex) as (
  select s.id, c.p2, cast(min(c.weight * 1000000 + 1) as bigint)
  from seeds s join weighted_links c on c.p1 = s.id group by all
  union
  select n.seed, n.vertex, n.price
  from (select r.seed, c.p2 as vertex, cast(min(r.price + c.weight * 1000000 + 1) as bigint) as price
        from costs r join weighted_links c on c.p1 = r.vertex group by all) n
  left join recurring.costs o on o.seed = n.seed and o.vertex = n.vertex
  where o.price is null or n.price < o.price)""",
    "reach": _reach("reach", "citations", _hops("citations")),
    "reach_any": _reach("reach_any", "citations_any", _hops("citations_any")),
    "reach_self": _reach(
        "reach_self", "citations", "select id, id, cast(0 as bigint) from seeds"
    ),
    "reach_implicit": _reach("reach_implicit", "citations_implicit", _hops("citations_implicit")),
    "core": _claims("core", "network"),
    "core_in_out": _claims("core_in_out", "ends"),
    "tree": _tree("tree", "weighted"),
    "tree_all": _tree("tree_all", "transitions"),
}

CORE_EDGES = f"""select n.u, n.v from network n
join core a on a.v = n.u and a.c >= {K} join core b on b.v = n.v and b.c >= {K}"""
EDGE_CORES = """select n.u, n.v, least(a.c, b.c) as c from network n
join core a on a.v = n.u join core b on b.v = n.v where n.u < n.v"""
FOLLOW_CORES = """select f.u, f.v, least(a.c, b.c) as c from follows f
join core_in_out a on a.v = f.u join core_in_out b on b.v = f.v"""
CORE_SIZES = f"""select k, vertices, coalesce(edges, 0) as edges
from (select k, count(*) as vertices
      from (select unnest(range(1, c + 1)) as k from core) group by k)
left join (select k, count(*) as edges
           from (select unnest(range(1, c + 1)) as k from ({EDGE_CORES})) group by k) using (k)"""
TWO_HOPS = """select distinct s.id as seed, b.p2 as vertex
from seeds s join citations a on a.p1 = s.id join citations b on b.p1 = a.p2"""
NEIGHBORS = """select s.id as seed, c.p2 as vertex, cast(1 as bigint) as d
from seeds s join citations c on c.p1 = s.id"""
TREE_COLUMNS = "nowGroup, currentTime, currentGroup, nextGroup, sharedParticleCount"


def _fit(basis: str, rows: str = "lineitem") -> str:
    return f"""select l_returnflag,
  printf('%.6e', regr_slope(l_extendedprice / 60, {basis})) as a,
  printf('%.6e', regr_intercept(l_extendedprice / 60, {basis})) as b
from {rows} group by l_returnflag"""


BODIES = {
    "scan_papers": "select id, year from papers",
    "csv_typed_ingest": """select p_partkey as id, cast(p_size as bigint) as size,
  p_retailprice as price, p_brand as brand from part""",
    "manifest_ingest": """select c_custkey as custkey, c_acctbal as balance,
  cast(c_nationkey as double) as nation, c_mktsegment as segment from customer""",
    "reject_non_numeric": """select cast(f[1] as bigint) as p1, cast(f[2] as bigint) as p2
from fields where numbers""",
    "lenient_parse": """select cast(f[1] as bigint) as p1, cast(f[2] as bigint) as p2
from fields where numbers and len(f) = 2""",
    "reject_counts": """select case when len(f) <> 2 then 'field count'
  when not numbers then 'not a number' else 'accepted' end as outcome, count(*) as lines
from fields group by 1""",
    "id_cutoff_subgraph": """select p1, p2 from citations_raw
where p1 < (select max(id) // 2 from papers) and p2 < (select max(id) // 2 from papers)
  and p1 in (select id from papers) and p2 in (select id from papers)""",
    "drop_self_edges": "select p1, p2 from citations_raw where p1 <> p2",
    "implicit_vertices": """select id, coalesce(year, 0) as year
from (select id from papers union select l_partkey from lineitem
      union select l_orderkey from lineitem)
left join papers using (id)""",
    "first_n_seeds": f"select id from papers order by id limit {FIRST_SEEDS}",
    "quarantined_lines": """select cast(p_size as bigint) as size,
  case when len(f) <> 2 then 'field count' else 'not a number' end as outcome, line
from (select p_size, line, string_split(line, ',') as f
      from part join raw_lines on line in (
        'x' || cast(p_partkey as varchar) || ',1999', cast(p_partkey as varchar) || ',1999,extra',
        cast(p_partkey as varchar)))
where p_size in (1, 2, 3)""",
    "edge_sample_hash": f"""select p1, p2 from citations_raw
where substr(md5(p1 || ':' || p2), 1, 4) < '{int(SAMPLE_RATE * 0x10000):04x}'""",
    "symmetrize": "select u, v from network",
    "store_roundtrip": "select id, year from papers",
    "store_over_itself": "select id, year + 1 as year from papers where year > 1975",
    "csv_rejects": """select case when len(f) <> 2 then 'field count'
  when not numbers then 'not a number' else 'accepted' end as outcome, count(*) as lines
from fields group by 1""",
    "lines_from_files": """select cast(f[1] as bigint) as p1, cast(f[2] as bigint) as p2
from fields where numbers and len(f) = 2""",
    "edge_sample_bernoulli": """select cast(0 as bigint) as outside, cast(0 as bigint) as repeated,
  true as near_rate""",
    "lca_report": f"select p1, p2, ca as a, depth, year from ({_lca('reach')})",
    "core_edges_by_k": f"""select k, u, v
from (select u, v, unnest(range(1, c + 1)) as k from ({EDGE_CORES}))""",
    "graph_size": """select count(distinct u) as vertices,
  cast(count(*) // 2 as bigint) as edges from network""",
    "temporal_citations": """select c.p1, c.p2
from citations_raw c join papers p on p.id = c.p1 join papers q on q.id = c.p2
where p.year >= q.year""",
    "seed_neighbors": NEIGHBORS,
    "two_hop_distinct": TWO_HOPS,
    "new_pairs_diff": f"{TWO_HOPS} except select seed, vertex from ({NEIGHBORS})",
    "relax_one_hop": f"""select seed, vertex, min(d) as d
from ({NEIGHBORS} union all
      select n.seed, c.p2, n.d + 1 from ({NEIGHBORS}) n join citations c on c.p1 = n.vertex)
group by seed, vertex""",
    "common_ancestors": _common("reach"),
    "pair_depth": f"select p1, p2, ca, greatest(d1, d2) as depth from ({_common('reach')})",
    "pick_min_max": f"select p1, p2, ca, d1, d2 from ({_common('reach')})",
    "reachable_pairs": "select seed, vertex from reach",
    "min_hops": "select seed, vertex, d from reach",
    "reachable_by_depth": "select d, count(*) as pairs from reach group by d",
    "distance_vectors": f"""select vertex, block, count(*) as seeds,
  string_agg(slot || ':' || d, ',' order by slot) as depths
from (select r.vertex, r.d, n.number // {VECTOR_BLOCK} as block, n.number % {VECTOR_BLOCK} as slot
      from reach_self r
      join (select id, row_number() over (order by id) - 1 as number from seeds) n on n.id = r.seed)
group by vertex, block""",
    "cheapest_paths": """select seed, vertex, price // 1000000 as cost, price % 1000000 as hops
from costs""",
    "lca": _lca("reach"),
    "lca_newest_year": _lca("reach", "year desc"),
    "lca_include_self": _lca("reach_self"),
    "lca_no_temporal_filter": _lca("reach_any"),
    "lca_program": _lca("reach"),
    "lca_least_sum": f"""select p1, p2, ca, d1 + d2 as total, year, d1, d2
from (select *, row_number() over (partition by p1, p2 order by d1 + d2, year, ca) as pick
      from ({_common('reach')}))
where pick = 1""",
    "lca_implicit_vertices": _lca("reach_implicit", "year", "papers_implicit"),
    "cocitation_lca": """select p1, p2, ca, year
from (select a.p1, b.p1 as p2, a.p2 as ca, p.year,
             row_number() over (partition by a.p1, b.p1 order by p.year, a.p2) as pick
      from citations a join citations b on a.p2 = b.p2 and a.p1 < b.p1
      join papers p on p.id = a.p2)
where pick = 1""",
    "vertex_degree": "select u, count(*) as degree from network group by u",
    "vertex_degree_in_out": "select u, count(*) as degree from ends group by u",
    "degree_filter": f"""select u, v from network
where u in (select u from network group by u having count(*) >= {K})""",
    "kcore_edges": CORE_EDGES,
    "kcore_vertices": f"select u as v, count(*) as degree from ({CORE_EDGES}) group by u",
    "kcore_in_out": f"""select f.u, f.v from follows f
join core_in_out a on a.v = f.u and a.c >= {K_IN_OUT}
join core_in_out b on b.v = f.v and b.c >= {K_IN_OUT}""",
    "core_numbers": "select v, c as core from core",
    "core_sizes_in_out": f"""select k, vertices, coalesce(edges, 0) as edges
from (select k, count(*) as vertices
      from (select unnest(range(1, c + 1)) as k from core_in_out) group by k)
left join (select k, count(*) as edges
           from (select unnest(range(1, c + 1)) as k from ({FOLLOW_CORES})) group by k) using (k)""",
    "core_edges_by_k_in_out": f"""select k, u, v
from (select u, v, unnest(range(1, c + 1)) as k from ({FOLLOW_CORES}))""",
    "core_sizes": CORE_SIZES,
    "core_sizes_range": f"""select * from ({CORE_SIZES}) where k between {K} and {K} + 3""",
    "significant_halos": "select nowGroup, grpID, timeStep, totalParticles from big_halos",
    "max_timestep": "select max(timeStep) as maxT from big_halos",
    "cross_singleton": """select h.*, m.maxT
from big_halos h cross join (select max(timeStep) as maxT from big_halos) m""",
    "significant_particles": "select nowGroup, iOrder, timestep, grp from particles",
    "snapshot_transitions": f"select {TREE_COLUMNS} from transitions",
    "weighted_edges": f"select {TREE_COLUMNS} from weighted",
    "tree_root_edges": f"select {TREE_COLUMNS} from weighted where currentTime = 1",
    "merger_tree": f"select {TREE_COLUMNS} from tree",
    "merger_tree_unfiltered": f"select {TREE_COLUMNS} from tree_all",
    "timing_lines": """select run_id,
  cast(split_part(spent, 'm', 1) as double) * 60
  + cast(replace(split_part(spent, 'm', 2), 's', '') as double) as seconds
from (select run_id, split_part(line, chr(9), 1) as clock, split_part(line, chr(9), 2) as spent
      from log_lines) where clock = 'real'""",
    "fit_inverse": _fit("1 / l_quantity"),
    "fit_quadratic": _fit("l_quantity * l_quantity"),
    "fit_quadratic_small_slope": _fit("(1000 * l_quantity) * (1000 * l_quantity)"),
    "fit_result_csv": _fit("1 / l_quantity"),
}


def with_views(body: str) -> str:
    needed: set[str] = set()

    def need(sql: str, owner: str | None = None) -> None:
        for name, view in VIEWS.items():
            if name != owner and name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                need(view, name)

    need(body)
    if not needed:
        return body
    views = ",\n".join(view for name, view in VIEWS.items() if name in needed)
    return f"with recursive {views}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in BODIES.items()}
