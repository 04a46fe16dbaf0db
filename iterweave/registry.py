"""Every operator and program as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from iterweave import sinks
from iterweave.fixtures import Inputs
from iterweave.operators import citations as cite
from iterweave.operators import degrees, fits
from iterweave.plans import cores, lca, mergertree, reach
from iterweave.sources import graph, manifest, text
from iterweave.workspace import Workspace

# Parameters of the registered queries; thresholds follow the data.
FIRST_SEEDS = 20
SAMPLE_RATE = 0.25

Query = Callable[[Inputs, Workspace], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    # The workspace stays open: the caller reads the result after we return.
    return lambda spark, sf_dir: fn(Inputs(spark, sf_dir), Workspace(spark))


# --- sources -----------------------------------------------------------------


@query
def scan_papers(t, ws):
    return t.papers()


@query
def csv_typed_ingest(t, ws):
    path = ws.path("part_csv")
    part = t.table("part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    sinks.write_delimited(part, path, header=True)
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("brand", T.StringType()),
        ]
    )
    return text.read_delimited(ws.spark, f"{path}/part-*", schema, header=True)


@query
def manifest_ingest(t, ws):
    path = ws.path("customer_csv")
    customer = t.table("customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    sinks.write_delimited(customer, path, delimiter="|")
    # The field names are fixed by the manifest format.
    document = {
        "relationKey": {
            "userName": "shop",
            "programName": "nightly",
            "relationName": "customer",
        },
        "schema": {
            "columnTypes": ["LONG_TYPE", "DOUBLE_TYPE", "FLOAT_TYPE", "STRING_TYPE"],
            "columnNames": ["custkey", "balance", "nation", "segment"],
        },
        "source": {"dataType": "URI", "uri": path},
        "delimiter": "|",
    }
    manifest.ingest(ws.spark, document)
    read = sinks.scan(ws.spark, manifest.Manifest.parse(document).relation)
    return read.withColumn("nation", F.col("nation").cast("double"))


@query
def reject_non_numeric(t, ws):
    return text.reject_non_numeric(t.raw_lines())


@query
def lenient_parse(t, ws):
    return text.lenient_parse(t.raw_lines())


@query
def reject_counts(t, ws):
    return text.reject_counts(t.raw_lines())


@query
def id_cutoff_subgraph(t, ws):
    papers = t.papers()
    cutoff = papers.agg(F.expr("max(id) div 2")).first()[0]
    return graph.id_cutoff_subgraph(papers, t.citations_raw(), cutoff)


@query
def drop_self_edges(t, ws):
    return graph.drop_self_edges(t.citations_raw())


@query
def implicit_vertices(t, ws):
    return graph.with_implicit_vertices(t.papers(), t.part_orders())


@query
def first_n_seeds(t, ws):
    return graph.first_n_seeds(t.papers(), FIRST_SEEDS)


@query
def edge_sample_bernoulli(t, ws):
    """What must hold of the sample, which itself depends on the file layout."""
    edges = ws.materialize(t.citations_raw().distinct(), "edges")
    drawn = ws.materialize(graph.sample_edges(edges.df, SAMPLE_RATE), "drawn")
    outside = drawn.df.join(edges.df, ["p1", "p2"], "left_anti").agg(
        F.count(F.lit(1)).alias("outside")
    )
    spread = 6 * (edges.rows * SAMPLE_RATE * (1 - SAMPLE_RATE)) ** 0.5
    distinct = drawn.df.distinct().count()
    return outside.select(
        "outside",
        F.lit(drawn.rows - distinct).cast("long").alias("repeated"),
        F.lit(abs(drawn.rows - edges.rows * SAMPLE_RATE) <= spread).alias("near_rate"),
    )


@query
def lines_from_files(t, ws):
    path = ws.path("lines")
    t.raw_lines().write.text(path)
    return text.lenient_parse(text.read_lines(ws.spark, path))


@query
def csv_rejects(t, ws):
    path = ws.path("lines")
    t.raw_lines().write.text(path)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("p1", "p2")])
    return text.count_rejects(ws.spark, path, schema)


@query
def quarantined_lines(t, ws):
    """The rejected lines of a folder of files, with the folder that a line's file is in."""
    path = ws.path("lines")
    t.sized_lines().write.partitionBy("size").text(path)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("p1", "p2")])
    _, rejected = text.quarantine(ws, path, schema)
    kept = sinks.store(rejected, ws.name("rejects"))
    size = F.regexp_extract("file", "size=([0-9]+)", 1).cast("long").alias("size")
    return kept.select(size, "outcome", "line")


@query
def edge_sample_hash(t, ws):
    return graph.sample_edges_by_hash(t.citations_raw(), SAMPLE_RATE)


@query
def symmetrize(t, ws):
    return graph.symmetrize(t.follows())


# --- sinks -------------------------------------------------------------------


@query
def store_roundtrip(t, ws):
    name = ws.name("papers")
    stored = sinks.store(t.papers(), name)
    path = ws.path("papers_csv")
    sinks.write_delimited(stored, path)
    return text.read_delimited(ws.spark, path, stored.schema)


@query
def store_over_itself(t, ws):
    name = ws.name("papers")
    sinks.store(t.papers(), name)
    year = F.col("year")
    newer = sinks.scan(ws.spark, name).filter(year > 1975).withColumn("year", year + 1)
    return sinks.store(newer, name)


@query
def lca_report(t, ws):
    path = ws.path("report")
    sinks.write_lca_report(lca_oldest(t, ws), path)
    names = ("p1", "p2", "a", "depth", "year")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return text.read_delimited(ws.spark, path, schema, header=True)


def _core_files(t, ws, edges):
    """Written and read back; the k of a file is the name of its folder."""
    path = ws.path("cores")
    sinks.write_core_edges(edges, path)
    fields = [T.StructField(n, T.LongType()) for n in ("u", "v", "k")]
    read = ws.spark.read.schema(T.StructType(fields)).option("sep", "\t").csv(path)
    return read.select("k", "u", "v")


@query
def core_edges_by_k(t, ws):
    return _core_files(t, ws, cores.core_edges_by_k(ws, t.network(), runs=True))


@query
def core_edges_by_k_in_out(t, ws):
    return _core_files(t, ws, cores.core_edges_by_k_in_out(ws, t.follows(), runs=True))


@query
def graph_size(t, ws):
    return degrees.graph_size(t.network())


# --- joins and set operations of the ancestor query --------------------------


@query
def temporal_citations(t, ws):
    return cite.temporal_citations(t.citations_raw(), t.papers())


@query
def seed_neighbors(t, ws):
    return cite.seed_neighbors(t.citations(), t.seeds())


@query
def two_hop_distinct(t, ws):
    return cite.two_hop_distinct(ws, t.citations(), t.seeds())


@query
def new_pairs_diff(t, ws):
    citations = ws.materialize(t.citations(), "citations").df
    seeds = t.seeds()
    return cite.new_pairs(
        cite.two_hop_distinct(ws, citations, seeds), cite.seed_neighbors(citations, seeds)
    )


@query
def relax_one_hop(t, ws):
    citations = ws.materialize(t.citations(), "citations").df
    return reach.relax_one_hop(ws, cite.seed_neighbors(citations, t.seeds()), citations)


def _reach(t, ws, **options):
    return reach.min_hops(ws, t.citations(), t.seeds(), **options)


def _common(t, ws):
    block = ws.tuning.pair_block_rows
    return cite.common_ancestors(_reach(t, ws), t.papers(), block_rows=block)


@query
def common_ancestors(t, ws):
    return _common(t, ws)


@query
def pair_depth(t, ws):
    return cite.pair_depth(_common(t, ws))


@query
def pick_min_max(t, ws):
    found = _reach(t, ws)
    return cite.oriented_meetings(found, found, block_rows=ws.tuning.pair_block_rows)


# --- reachability ------------------------------------------------------------


@query
def reachable_pairs(t, ws):
    return reach.reachable_pairs(_reach(t, ws))


@query
def min_hops(t, ws):
    return _reach(t, ws)


@query
def reachable_by_depth(t, ws):
    return reach.reachable_by_depth(ws, t.citations(), t.seeds())


@query
def distance_vectors(t, ws):
    vectors, _ = reach.distance_vectors(ws, t.citations(), t.seeds())
    return reach.vector_text(vectors)


@query
def cheapest_paths(t, ws):
    return reach.cheapest_paths(ws, t.weighted_citations(), t.seeds())


# --- least common ancestors --------------------------------------------------


def _lca(t, ws, **options):
    return lca.least_common_ancestors(ws, t.papers(), t.citations_raw(), t.seeds(), **options)


def lca_oldest(t, ws):
    return _lca(t, ws)


QUERIES["lca"] = lca_oldest


@query
def lca_newest_year(t, ws):
    return _lca(t, ws, year_order="newest")


@query
def lca_include_self(t, ws):
    return _lca(t, ws, include_self=True)


@query
def lca_no_temporal_filter(t, ws):
    return _lca(t, ws, temporal_filter=False)


@query
def lca_least_sum(t, ws):
    return lca.nearest_common_ancestors(ws, t.papers(), t.citations_raw(), t.seeds())


@query
def lca_program(t, ws):
    return lca.lca_program(ws, t.papers(), t.citations_raw(), t.seeds())


@query
def lca_implicit_vertices(t, ws):
    """Papers also cite the orders they are in, which have no paper rows."""
    cited = t.citations_raw().unionByName(t.order_citations())
    return lca.least_common_ancestors(ws, t.papers(), cited, t.seeds(), implicit_vertices=True)


@query
def cocitation_lca(t, ws):
    return lca.cocitation_lca(ws, t.papers(), t.citations(), t.papers().select("id"))


# --- degrees and cores -------------------------------------------------------


@query
def vertex_degree(t, ws):
    return degrees.vertex_degree(t.network())


@query
def vertex_degree_in_out(t, ws):
    return degrees.vertex_degree_in_out(t.follows())


def _half_degree(degree):
    """Half the mean degree, rounded up: a core of that order always exists."""
    k = F.ceil(F.sum("degree") / (2 * F.count(F.lit(1))))
    return degree.agg(k.cast("long").alias("k")).first()[0] or 1


def _network(t, ws):
    network = ws.materialize(t.network(), "network").df
    return network, _half_degree(degrees.vertex_degree(network))


@query
def degree_filter(t, ws):
    return degrees.degree_filter(*_network(t, ws))


@query
def kcore_edges(t, ws):
    return cores.kcore_edges(ws, *_network(t, ws))


@query
def kcore_vertices(t, ws):
    return cores.kcore_vertices(ws, *_network(t, ws))


@query
def kcore_in_out(t, ws):
    follows = ws.materialize(t.follows(), "follows").df
    return cores.kcore_in_out(ws, follows, _half_degree(degrees.vertex_degree_in_out(follows)))


@query
def core_sizes_in_out(t, ws):
    return cores.core_sizes_in_out(ws, t.follows())


@query
def core_numbers(t, ws):
    return cores.core_numbers(ws, t.network())


@query
def core_sizes(t, ws):
    return cores.core_sizes(ws, t.network())


@query
def core_sizes_range(t, ws):
    """Only the cores from half the mean degree to three above."""
    network, k = _network(t, ws)
    return cores.core_sizes(ws, network, kmin=k, kmax=k + 3)


# --- merger tree -------------------------------------------------------------


def _mean(df, column):
    """The whole part of the mean."""
    return df.agg(F.expr(f"sum({column}) div count(*)")).first()[0]


def _halos(t):
    return mergertree.significant_halos(t.halos(), _mean(t.halos(), "totalParticles"))


def _particles(t):
    return mergertree.significant_particles(t.poi(), _halos(t))


def _weighted(t, ws):
    found = ws.materialize(mergertree.snapshot_transitions(_particles(t)), "transitions").df
    return mergertree.weighted_edges(found, _mean(found, "sharedParticleCount"))


def _tree(t, ws, **options):
    poi = ws.materialize(t.poi(), "poi").df
    halos = poi.groupBy(
        "nowGroup", F.col("grp").alias("grpID"), F.col("timestep").alias("timeStep")
    ).agg(F.count(F.lit(1)).alias("totalParticles"))
    big = mergertree.significant_halos(halos, _mean(halos, "totalParticles"))
    shared = mergertree.snapshot_transitions(mergertree.significant_particles(poi, big))
    shared = ws.materialize(shared, "shared").df
    return mergertree.tree_of(ws, shared, _mean(shared, "sharedParticleCount"), **options)


@query
def significant_halos(t, ws):
    return _halos(t)


@query
def max_timestep(t, ws):
    return mergertree.max_timestep(_halos(t))


@query
def cross_singleton(t, ws):
    return mergertree.halos_with_max_time(_halos(t))


@query
def significant_particles(t, ws):
    return _particles(t)


@query
def snapshot_transitions(t, ws):
    return mergertree.snapshot_transitions(_particles(t))


@query
def weighted_edges(t, ws):
    return _weighted(t, ws)


@query
def tree_root_edges(t, ws):
    return mergertree.tree_root_edges(_weighted(t, ws))


@query
def merger_tree(t, ws):
    return _tree(t, ws)


@query
def merger_tree_unfiltered(t, ws):
    return _tree(t, ws, recurse_on="all")


# --- run-time analytics ------------------------------------------------------


@query
def timing_lines(t, ws):
    return fits.timing_lines(t.log_lines())


def _digits(fit):
    """Seven significant digits, however small a coefficient is."""
    return fit.select(
        "l_returnflag", *[F.format_string("%.6e", F.col(c)).alias(c) for c in ("a", "b")]
    )


@query
def fit_inverse(t, ws):
    y = fits.seconds_to_minutes(F.col("l_extendedprice"))
    return _digits(fits.fit_inverse(t.table("lineitem"), "l_quantity", y, ["l_returnflag"]))


@query
def fit_quadratic(t, ws):
    y = fits.seconds_to_minutes(F.col("l_extendedprice"))
    return _digits(fits.fit_quadratic(t.table("lineitem"), "l_quantity", y, ["l_returnflag"]))


@query
def fit_quadratic_small_slope(t, ws):
    y = fits.seconds_to_minutes(F.col("l_extendedprice"))
    lines = t.table("lineitem").withColumn("n", F.col("l_quantity") * 1000)
    return _digits(fits.fit_quadratic(lines, "n", y, ["l_returnflag"]))


@query
def fit_result_csv(t, ws):
    """A result file with padded fields, read and fitted."""
    path = ws.path("results")
    fields = ("l_returnflag", "l_quantity", "l_extendedprice")
    padded = [F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in fields]
    writer = t.table("lineitem").select(*padded).write.option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).csv(path)
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([T.StructField(n, k) for n, k in zip(fields, kinds, strict=True)])
    read = text.read_delimited(ws.spark, path, schema, header=True, trim=True)
    y = fits.seconds_to_minutes(F.col("l_extendedprice"))
    return _digits(fits.fit_inverse(read, "l_quantity", y, ["l_returnflag"]))
