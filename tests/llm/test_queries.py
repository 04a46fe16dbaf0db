"""The registered queries against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from iterweave.llm import op05_toxicity, op07_decontamination, op08_sanitise
from iterweave.llm.common import shingles, two_word_shingles, words_of
from iterweave.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import components

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    got = normal(QUERIES[name](spark, FOLDER).toPandas())
    want = normal(duck.execute(ORACLES[name]).fetch_df())
    assert len(want)
    pd.testing.assert_frame_equal(got, want, rtol=0, atol=0)


def test_near_duplicates_of_the_tables(spark, duck):
    rows = duck.execute("select doc_id, text from documents").fetchall()
    sets = {i: two_word_shingles(words_of((t or "").encode())) for i, t in rows}
    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    links = set()
    for i, s in sets.items():
        for j in {j for x in s for j in holders[x] if j < i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                links.add((j, i))
    want = components(links, sets)
    got = QUERIES["op6_near_duplicates"](spark, FOLDER).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_base_spans_of_the_tables(spark, duck):
    got = {r.doc_id: r for r in QUERIES["op8_sanitise"](spark, FOLDER).collect()}
    for i, text in duck.execute("select doc_id, text from documents").fetchall():
        kinds = [k for k, _, _ in op08_sanitise.base_spans(text or "")]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [kinds.count(k) for k in op08_sanitise.KINDS]


def test_pipeline(spark, ws):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if name != "toxicity" else None
        docs = ws.materialize(stage(spark, docs, folder), name).df
        if name != "mixing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_dedup":
            sets = {i: shingles(words_of(t.encode()), 5) for i, t in before.items()}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a]
                     and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert kept[name] == {i: before[i] for i, c in components(links, sets).items() if i == c}
    read = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    chain = op05_toxicity.train(table, labels, op05_toxicity.categories_of(), ws)
    lookup = op05_toxicity.Lookup(chain.features)
    p = chain.predict(op05_toxicity.Rows.gather([lookup.of(t) for t in read.values()]))[:, -1]
    calm = {i for i, x in zip(read, p, strict=True) if x < op05_toxicity.THRESHOLD}
    assert set(kept["toxicity"]) == calm
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    automaton = op07_decontamination.SuffixAutomaton(
        [(i.item_id, op07_decontamination.normal_words(i.text.encode())) for i in items]
    )
    for i, text in kept["near_dedup"].items():
        found = op07_decontamination.normal_words(text.encode())
        hit = sum(b - a for a, b in automaton.hits(found)[0])
        assert (i in kept["decontamination"]) == (hit == 0 or 20 * hit < len(found))
    mixed = docs.collect()
    assert {r.doc_id for r in mixed} == set(kept["decontamination"])
    assert all(r.taken <= 3 * r.size for r in mixed)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(again) == sorted(mixed)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, name):
    folder = "/root/testdata/sf0.001"
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, folder).count() == 0
