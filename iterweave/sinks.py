"""Writing relations: every sink writes from the executors, none collects."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = 4  # ks for which an edge of several cores moves once: a task sorts so many of its files


def _quoted(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"not a relation name: {name!r}")
    return f"`{name}`"


def store(df: DataFrame, name: str) -> DataFrame:
    """Overwrite the named relation and return a scan of it.

    The rows go into a new table; the name, a view, moves over to it only when the table
    is complete, and the old one is dropped last.  So a relation may be computed from
    itself, and a failed write leaves it as it was.  Scans taken before end here.
    """
    spark, view = df.sparkSession, _quoted(name)
    version = f"{name}__v_{uuid.uuid4().hex}"
    try:
        df.write.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS `{version}`")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM `{version}`")
    for table in spark.catalog.listTables(pattern=f"{name}__v_*"):
        if table.name.lower() != version.lower():
            spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    return scan(spark, name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """The relation stored under a name."""
    return spark.table(_quoted(name))


def drop(spark: SparkSession, name: str) -> None:
    """Remove a named relation and its rows."""
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")
    for table in spark.catalog.listTables(pattern=f"{name}__v_*"):
        spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")


def write_delimited(
    df: DataFrame, path: str, *, delimiter: str = ",", header: bool = False
) -> None:
    df.write.mode("overwrite").option("sep", delimiter).option("header", header).csv(path)


def write_lca_report(answers: DataFrame, path: str) -> None:
    """CSV with a header, ordered by pair: part files in name order are in pair order."""
    report = answers.select("p1", "p2", F.col("ca").alias("a"), "depth", "year")
    write_delimited(report.orderBy("p1", "p2"), path, header=True)


def write_core_edges(edges: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """One folder of tab-separated edge files per k, of (k, u, v) or of runs (low, high, u, v).

    A core is dealt to as many tasks as it has files to fill: small cores make one file,
    and the first core, which holds every edge, is still written by many tasks.  Runs are
    spelled out where they are written: an edge moves once for ``RUN`` ks.  It is dealt by the
    last of them, whose core is the smallest, so that no core gets more files."""
    width, runs = RUN, edges
    if "k" in edges.columns:
        width, runs = 1, edges.select(F.col("k").alias("low"), F.col("k").alias("high"), "u", "v")
    spelled = F.explode(F.sequence("low", "high")).alias("k")
    sizes = runs.groupBy("low", "high").agg(F.count(F.lit(1)).alias("n")).select(spelled, "n")
    files = F.ceil(F.sum("n") / F.lit(rows_per_file)).cast("long").alias("files")
    sizes = sizes.groupBy(F.col("k").alias("high")).agg(files)
    part = F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"high div {width}")))
    cut = runs.withColumn("part", part).select(
        "part",
        F.greatest("low", F.col("part") * width).alias("low"),
        F.least("high", F.col("part") * width + (width - 1)).alias("high"),
        "u",
        "v",
    )
    (
        cut.join(sizes, "high")
        .withColumn("file", F.pmod(F.xxhash64("u", "v"), "files"))
        .repartition("part", "file")
        .select(spelled, "u", "v")
        .write.mode("overwrite")
        .partitionBy("k")
        .option("sep", "\t")
        .csv(path)
    )
