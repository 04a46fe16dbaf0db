"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from iterweave.llm import (
    op01_warc,
    op02_line_dedup,
    op03_mixing,
    op04_chat_trees,
    op05_toxicity,
    op06_bottomk,
    op07_decontamination,
    op08_sanitise,
    op09_threshold,
    op10_ppm_language,
    op11_repair,
    op12_merkle,
    op13_imatch,
)
from iterweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(op01_warc.SQL)
def op1_warc_derivatives(spark, sf_dir):
    return op01_warc.op1_warc_derivatives(spark, table(spark, sf_dir, "pages"))


@query(op02_line_dedup.SQL)
def op2_line_dedup(spark, sf_dir):
    return op02_line_dedup.op2_line_dedup(spark, table(spark, sf_dir, "documents"))


@query(op03_mixing.SQL)
def op3_mix_sources(spark, sf_dir):
    return op03_mixing.op3_mix_sources(spark, table(spark, sf_dir, "documents"))


@query(op04_chat_trees.SQL)
def op4_chat_format(spark, sf_dir):
    return op04_chat_trees.op4_chat_format(spark, table(spark, sf_dir, "conversations"))


@query()
def op6_near_duplicates(spark, sf_dir):
    return op06_bottomk.op6_near_duplicates(spark, table(spark, sf_dir, "documents"))


@query()
def op7_decontaminate(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return op07_decontamination.op7_decontaminate(spark, docs, items)


@query()
def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return op05_toxicity.op5_toxicity(spark, docs, labels)


@query()
def op8_sanitise(spark, sf_dir):
    return op08_sanitise.op8_sanitise(spark, table(spark, sf_dir, "documents"))


@query(op09_threshold.SQL)
def op9_exact_top_k(spark, sf_dir):
    return op09_threshold.op9_exact_top_k(spark, table(spark, sf_dir, "embeddings"))


@query()
def op10_language_id(spark, sf_dir):
    return op10_ppm_language.op10_language_id(spark, table(spark, sf_dir, "documents"))


@query()
def op11_repair_conversations(spark, sf_dir):
    return op11_repair.op11_repair_conversations(spark, table(spark, sf_dir, "conversations"))


@query(op12_merkle.SQL)
def op12_merkle_manifest(spark, sf_dir):
    return op12_merkle.op12_merkle_manifest(spark, table(spark, sf_dir, "documents"))


@query(op13_imatch.SQL)
def op13_fingerprints(spark, sf_dir):
    return op13_imatch.op13_fingerprints(spark, table(spark, sf_dir, "documents"))
