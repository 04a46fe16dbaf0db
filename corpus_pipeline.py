"""A corpus pipeline: documents in, a mix to target weights out.

Each stage takes what the one before it kept; ``run`` writes every stage's result as
Parquet in the shared folder and reads it again, so a lost executor never costs more than
tasks of the current stage.

1. toxicity: documents that the classifier chain rejects go.
2. line dedup: repeated line chunks and repeated passages of more than 50 words are cut out;
   documents of which nothing is left go.
3. near-dedup: of each component of near duplicates (shingles of five words, a similarity of
   0.8 or more) the smallest id stays.
4. decontamination: documents over the coverage limit go, spans are cut from the others.
5. mixing: how many words of each document the mix takes.

All stages but the last return the columns of their input (columns that clash with an
operator's own are dropped).  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iterweave.llm import (
    op02_line_dedup,
    op03_mixing,
    op05_toxicity,
    op06_bottomk,
    op07_decontamination,
)
from iterweave.llm.common import table
from iterweave.workspace import Workspace


SHINGLE = 5  # words


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    chain = op05_toxicity.train(docs, labels, op05_toxicity.categories_of(), Workspace(spark))
    scored = op05_toxicity.score(docs, chain)
    rejected = chain.categories[-1]
    added = {rejected, *(f"p_{c}" for c in chain.categories)}
    return scored.filter(~F.col(rejected)).select(*[c for c in docs.columns if c not in added])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = op02_line_dedup.dedup_lines(docs, passages=True)
    emptied = (F.col("n_removed") + F.col("n_passage_lines") > 0) & (F.trim("text") == "")
    return cut.filter(~emptied).drop("n_chunks", "n_removed", "n_passage_lines")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    near = op06_bottomk.near_duplicates(docs, width=SHINGLE)
    gone = near.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept")
    return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op07_decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_mixing.taken(op03_mixing.mix(docs))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The classifier and the suffix automaton are not expressible; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.materialize(stage(spark, docs, sf_dir), name).df
    return docs
