"""Durable intermediate tables for iterative programs.

A fixpoint loop has to cut its lineage every round, otherwise the plan of round n
contains the plans of rounds 1..n-1.  Every cut here is a parquet table in the
cluster's shared folder, so losing executors costs a task retry, never a recompute
of earlier rounds, and the next round sees true file sizes when Spark decides
whether a side is small enough to broadcast.

Row counts and other loop controls come from ``Observation`` metrics collected by
the write itself: a round is one job, with no second pass to count its output.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from iterweave import sinks
from iterweave.tuning import DEFAULT, Tuning

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster: that of checkpoints, or
    else the warehouse."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


@dataclass(frozen=True)
class Stored:
    """A written table: how to read it, and what was measured while writing it."""

    df: DataFrame
    rows: int
    path: str
    metrics: dict = field(default_factory=dict)


_OPEN: list[Workspace] = []


def close_all() -> None:
    """Close every workspace that is still open, once all results are consumed."""
    for ws in list(_OPEN):
        ws.close()


class Workspace:
    """Owns the scratch tables of one program run.

    Results are lazy reads of these tables, so keep the workspace open until they
    have been consumed; ``close()`` (or leaving the ``with`` block) deletes it.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, tuning: Tuning = DEFAULT
    ):
        self.spark = spark
        self.tuning = tuning
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/iterweave-{uuid.uuid4().hex}"
        self._tables: list[str] = []
        self._relations: list[str] = []
        _OPEN.append(self)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    @property
    def partitions(self) -> int:
        """How many partitions the cluster is set to shuffle into."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def name(self, name: str) -> str:
        """A relation name of this run's own; dropped with the workspace."""
        unique = f"{name}_{uuid.uuid4().hex[:12]}"
        self._relations.append(unique)
        return unique

    def materialize(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        **measures: Column,
    ) -> Stored:
        """Write ``df`` once and hand back a read of it, with its row count."""
        path = self.path(name)
        metrics = self._write(df, path, partition_by, measures)
        read = self.spark.read.schema(df.schema).parquet(path)
        return Stored(read, metrics["rows"], path, metrics)

    def materialize_bucketed(
        self, df: DataFrame, name: str, buckets: int, by: Sequence[str]
    ) -> Stored:
        """Write ``df`` hash-distributed on ``by``: later joins on exactly these
        columns shuffle the other side only."""
        path = self.path(name)
        table = f"iterweave_{uuid.uuid4().hex}"
        seen = Observation()
        (
            df.repartition(buckets, *by)
            .observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.bucketBy(buckets, *by)
            .sortBy(*by)
            .option("path", path)
            .saveAsTable(table)
        )
        self._tables.append(table)
        return Stored(self.spark.table(table), seen.get["rows"], path, seen.get)

    def rounds(self, name: str, schema: T.StructType) -> RoundLog:
        return RoundLog(self, self.path(name), schema)

    def keyed_rounds(self, name: str, schema: T.StructType, keys: Sequence[str]) -> KeyedLog:
        return KeyedLog(self, self.path(name), schema, keys)

    def discard(self, *tables: Stored | RoundLog | KeyedLog) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            if isinstance(table, KeyedLog):
                self.spark.sql(f"DROP TABLE IF EXISTS {table.table}")
                self._tables.remove(table.table)
            self._delete(table.path)

    def close(self) -> None:
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        for name in self._relations:
            sinks.drop(self.spark, name)
        self._relations.clear()
        self._delete(self.root)
        if self in _OPEN:
            _OPEN.remove(self)

    def _write(self, df, path, partition_by, measures, mode="errorifexists") -> dict:
        seen, df = self._observed(df, measures)
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return seen.get

    @staticmethod
    def _observed(df: DataFrame, measures: dict[str, Column]) -> tuple[Observation, DataFrame]:
        seen = Observation()
        wanted = {"rows": F.count(F.lit(1)), **measures}
        return seen, df.observe(seen, *[c.alias(n) for n, c in wanted.items()])

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


class RoundLog:
    """An append-only relation with one directory per round.

    The round number is a partition column: reading "everything up to round r" is
    one file scan (a union per round would add partitions and plan nodes each time),
    and reading one round prunes to its directory.
    """

    ROUND = "round"

    def __init__(self, ws: Workspace, path: str, schema: T.StructType):
        self._ws = ws
        self.path = path
        self._fields = schema.fieldNames()
        self.schema = T.StructType([*schema.fields, T.StructField(self.ROUND, T.LongType())])

    def append(self, df: DataFrame, number: int, more: bool = False, **measures: Column) -> dict:
        """Write a round, or ``more`` rows of one that is there."""
        path = f"{self.path}/{self.ROUND}={number}"
        mode = "append" if more else "errorifexists"
        return self._ws._write(df.select(*self._fields), path, (), measures, mode)

    def read(self, first: int, last: int | None = None) -> DataFrame:
        last = first if last is None else last
        if first > last:
            return self._ws.spark.createDataFrame([], self.schema)
        reader = self._ws.spark.read.schema(self.schema)
        paths = [f"{self.path}/{self.ROUND}={n}" for n in range(first, last + 1)]
        return reader.option("basePath", self.path).parquet(*paths)


class KeyedLog:
    """A round log that is hash-distributed on ``keys``, one file per bucket and round.

    Joining with what is known, or aggregating it by the keys, moves only the other side: the
    table stays where it is, however many rounds it holds.  There is one bucket per shuffle
    partition, so a join's other side arrives in the same distribution and what is new is
    written from the task that found it.
    """

    ROUND = RoundLog.ROUND

    def __init__(self, ws: Workspace, path: str, schema: T.StructType, keys: Sequence[str]):
        self._ws = ws
        self.path = path
        self.keys = list(keys)
        self.table = f"iterweave_{uuid.uuid4().hex}"
        self._fields = schema.fieldNames()
        self.schema = T.StructType([*schema.fields, T.StructField(self.ROUND, T.LongType())])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        by = ", ".join(f"`{k}`" for k in self.keys)
        ws.spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY ({self.ROUND}) "
            f"CLUSTERED BY ({by}) INTO {ws.partitions} BUCKETS LOCATION '{path}'"
        )
        ws._tables.append(self.table)

    def append(self, df: DataFrame, number: int, **measures: Column) -> dict:
        numbered = df.select(*self._fields).withColumn(self.ROUND, F.lit(number).cast("long"))
        seen, numbered = self._ws._observed(numbered, measures)
        numbered.write.insertInto(self.table)
        return seen.get

    def read(self, first: int, last: int | None = None) -> DataFrame:
        last = first if last is None else last
        found = self._ws.spark.table(self.table)
        return found.filter(F.col(self.ROUND).between(first, last))
