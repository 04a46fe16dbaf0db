from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from iterweave import sinks
from iterweave.sources import graph, manifest, text
from tests.conftest import rows

PAPER, LINK = "id long, year long", "p1 long, p2 long"
LINES = [
    "paper,year",
    "x,1",
    "3",
    "4,1990,extra",
    "",
    " 7 ,1",
    "5,1991",
    "6,",
    "99999999999999999999,1",
]


def lines(table):
    return table([(s,) for s in LINES], "line string")


def test_digit_rule_ignores_further_fields(table):
    assert rows(text.reject_non_numeric(lines(table))) == [(4, 1990), (5, 1991)]


def test_lenient_parse_needs_two_numbers(table):
    assert rows(text.lenient_parse(lines(table))) == [(5, 1991)]


def test_rejects_are_counted(table):
    assert rows(text.reject_counts(lines(table))) == [
        ("accepted", 1),
        ("field count", 3),
        ("not a number", 5),
    ]


def test_delimiter_is_literal(table):
    piped = table([("1|2",), ("1,2",)], "line string")
    assert rows(text.lenient_parse(piped, "|")) == [(1, 2)]


def test_delimited_read_of_a_glob_with_padded_header(spark, tmp_path):
    for name in ("run-1.csv", "run-2.csv"):
        (tmp_path / name).write_text("N, time\n1000, 105.5\n")
    (tmp_path / "other.csv").write_text("N, time\n1, 1\n")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.DoubleType())])
    got = text.read_delimited(spark, f"{tmp_path}/run-*", schema, header=True, trim=True)
    assert rows(got) == [(1000, 105.5), (1000, 105.5)]


def test_lines_that_do_not_fit_are_skipped_and_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,2\nx,3\n4\n5,6,7\n8,9.5\n,2\n 9 ,10\n")
    (tmp_path / "s.csv").write_text("1,  pad  \n")
    longs = T.StructType([T.StructField(n, T.LongType()) for n in "ab"])
    got = text.read_delimited(spark, f"{tmp_path}/x.csv", longs)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2), (9, 10), (None, 2)]
    assert got.count() == 3
    counted = text.count_rejects(spark, f"{tmp_path}/x.csv", longs)
    assert rows(counted) == [("accepted", 3), ("field count", 2), ("not a number", 2)]
    mixed = T.StructType([longs["a"], T.StructField("s", T.StringType())])
    assert rows(text.read_delimited(spark, f"{tmp_path}/s.csv", mixed)) == [(1, "  pad  ")]
    assert rows(text.read_delimited(spark, f"{tmp_path}/s.csv", mixed, trim=True)) == [(1, "pad")]


def test_text_files_feed_the_line_parsers(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("1,2\nbad\n")
    assert rows(text.lenient_parse(text.read_lines(spark, str(tmp_path)))) == [(1, 2), (1, 2)]


def document(path, **changes):
    doc = {
        "relationKey": {"userName": "lab", "programName": "import", "relationName": "groups"},
        "schema": {
            "columnTypes": ["LONG_TYPE", "DOUBLE_TYPE", "FLOAT_TYPE", "STRING_TYPE"],
            "columnNames": ["grp", "mass", "hi", "kind"],
        },
        "source": {"dataType": "File", "filename": str(path)},
        "delimiter": ";",
    }
    return {**doc, **changes}


def test_manifest_ingest(spark, tmp_path):
    path = tmp_path / "groups.csv"
    path.write_text("1;2.5;0.5;gas\n2;3.5;1.5;dark\n")
    got = manifest.ingest(spark, json.dumps(document(path)))
    assert [f.dataType.simpleString() for f in got.schema] == [
        "bigint",
        "double",
        "float",
        "string",
    ]
    assert rows(got) == [(1, 2.5, 0.5, "gas"), (2, 3.5, 1.5, "dark")]
    assert manifest.Manifest.parse(document(path)).name == "lab.import.groups"
    assert rows(sinks.scan(spark, "lab_import_groups")) == rows(got)


@pytest.mark.parametrize(
    "changes",
    [
        {"schema": {"columnTypes": ["LONG_TYPE"], "columnNames": []}},
        {"schema": {"columnTypes": ["DATE_TYPE"], "columnNames": ["x"]}},
        {"source": {"dataType": "URI"}},
    ],
)
def test_bad_manifests(changes):
    with pytest.raises(ValueError):
        manifest.Manifest.parse(document("x", **changes))


def test_graph_building(table):
    papers = table([(1, 1990), (2, 1991), (8, 1992)], PAPER)
    links = table([(1, 2), (2, 2), (1, 9), (8, 1), (3, 1)], LINK)
    assert rows(graph.id_cutoff_subgraph(papers, links, 8)) == [(1, 2), (2, 2)]
    assert (2, 2) not in rows(graph.drop_self_edges(links))
    assert rows(graph.with_implicit_vertices(papers, links)) == [
        (1, 1990),
        (2, 1991),
        (3, 0),
        (8, 1992),
        (9, 0),
    ]
    assert rows(graph.first_n_seeds(papers, 2)) == [(1,), (2,)]
    assert rows(graph.symmetrize(table([(1, 2), (2, 1), (2, 3)], LINK))) == [
        (1, 2),
        (2, 1),
        (2, 3),
        (3, 2),
    ]


def test_samples(table):
    edges = table([(i, i + 1) for i in range(2000)], LINK)
    by_hash = rows(graph.sample_edges_by_hash(edges, 0.25))
    assert 400 < len(by_hash) < 600
    assert by_hash == rows(graph.sample_edges_by_hash(edges.repartition(7), 0.25))
    assert graph.sample_edges_by_hash(edges, 1.0).count() == 2000
    drawn = rows(graph.sample_edges(edges, 0.25))
    assert len(set(drawn)) == len(drawn) and 350 < len(drawn) < 650
    assert drawn == rows(graph.sample_edges(edges, 0.25))


def test_store_overwrites(spark, table):
    sinks.store(table([(1, 2)], LINK), "rel")
    assert rows(sinks.store(table([(3, 4)], LINK), "rel")) == [(3, 4)]
    assert rows(sinks.scan(spark, "rel")) == [(3, 4)]
    with pytest.raises(ValueError):
        sinks.store(table([(1, 2)], LINK), "no `good` name")


def test_store_over_its_own_source(spark, table):
    sinks.store(table([(1, 2), (3, 4)], LINK), "own")
    sinks.store(sinks.scan(spark, "own").filter("p1 > 1"), "own")
    assert rows(sinks.scan(spark, "own")) == [(3, 4)]
    # A write that fails leaves the relation as it was.
    broken = sinks.scan(spark, "own").selectExpr("p1", "raise_error('no') as p2")
    with pytest.raises(Exception, match="no"):
        sinks.store(broken, "own")
    assert rows(sinks.scan(spark, "own")) == [(3, 4)]
    assert len(spark.catalog.listTables(pattern="own__v_*")) == 1
    sinks.drop(spark, "own")
    assert not spark.catalog.listTables(pattern="own*")


def test_report_is_in_pair_order(spark, table, tmp_path):
    answers = table(
        [(2, 3, 9, 1, 1990), (1, 9, 5, 2, 1991), (1, 2, 7, 1, 1992)],
        "p1 long, p2 long, ca long, depth long, year long",
    )
    path = tmp_path / "report"
    sinks.write_lca_report(answers.repartition(3), str(path))
    body = []
    for part in sorted(path.glob("part-*")):
        head, *rest = part.read_text().splitlines()
        assert head == "p1,p2,a,depth,year"
        body += rest
    assert body == ["1,2,7,1,1992", "1,9,5,2,1991", "2,3,9,1,1990"]


def test_core_edges_are_one_folder_per_k(table, tmp_path):
    path = tmp_path / "cores"
    sinks.write_core_edges(table([(1, 5, 6), (2, 7, 8)], "k long, u long, v long"), str(path))
    assert sorted(p.name for p in path.glob("k=*")) == ["k=1", "k=2"]
    assert "".join(p.read_text() for p in path.glob("k=2/part-*")) == "7\t8\n"
    edges = table([(k, i, i) for k in (1, 2) for i in range(100)], "k long, u long, v long")
    sinks.write_core_edges(edges.repartition(8), str(path), rows_per_file=30)
    assert all(1 <= len(list(path.glob(f"k={k}/part-*"))) <= 4 for k in (1, 2))


@pytest.mark.parametrize("part", ["40b", "128m"])
def test_rejected_lines_are_kept_with_their_place(spark, ws, tmp_path, part):
    schema = T.StructType([T.StructField("p1", T.LongType()), T.StructField("p2", T.LongType())])
    bad = {3: "x,1", 7: "1,2,3", 20: "5", 33: "4,y"}
    for name in ("a.csv", "b.csv"):
        held = [bad.get(i, "" if i == 10 else f"{i},{i}") for i in range(1, 41)]
        (tmp_path / name).write_text("\n".join(held) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        accepted, rejected = text.quarantine(ws, str(tmp_path), schema)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    why = {3: "not a number", 7: "field count", 20: "field count", 33: "not a number"}
    got = sorted((r.file.split("/")[-1], r.number, r.outcome, r.line) for r in rejected.collect())
    assert got == sorted((f, n, why[n], line) for f in ("a.csv", "b.csv") for n, line in bad.items())
    assert rows(accepted) == rows(text.read_delimited(spark, str(tmp_path), schema))
    counts = dict(rows(text.count_rejects(spark, str(tmp_path), schema)))
    assert counts == {"accepted": accepted.count(), "field count": 4, "not a number": 4}
