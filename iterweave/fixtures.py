"""Program inputs derived from the order tables, each from whole tables.

papers      a part is a paper, published in 1950 + its size
citations   a line's part cites the parts on the next line of its order
seeds       the papers of the newest year
network     the citations as an undirected co-purchase network
poi, halos  a customer is a particle; its group in a year is the priority class of its
            last order of that year; market segments are separate universes
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from iterweave.operators.citations import canonical_citations
from iterweave.sources.graph import drop_self_edges, symmetrize


@dataclass(frozen=True)
class Inputs:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def papers(self) -> DataFrame:
        year = (F.col("p_size") + 1950).cast("long")
        return self.table("part").select(F.col("p_partkey").alias("id"), year.alias("year"))

    def seeds(self) -> DataFrame:
        papers = self.papers()
        newest = papers.agg(F.max("year")).scalar()
        return papers.filter(F.col("year") == newest).select("id")

    def citations_raw(self) -> DataFrame:
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), "l_partkey"
        )
        # An order has a few lines, so a line number repeats a few times at most.
        cited = lines.select("o", (F.col("n") - 1).alias("n"), F.col("l_partkey").alias("p2"))
        return lines.join(cited, ["o", "n"]).select(F.col("l_partkey").alias("p1"), "p2")

    def citations(self) -> DataFrame:
        return canonical_citations(self.citations_raw(), self.papers())

    def follows(self) -> DataFrame:
        return drop_self_edges(self.citations_raw()).toDF("u", "v")

    def network(self) -> DataFrame:
        return symmetrize(self.follows())

    def part_orders(self) -> DataFrame:
        """Edges whose targets are mostly unknown as papers: part -> order."""
        return self.table("lineitem").select(
            F.col("l_partkey").alias("p1"), F.col("l_orderkey").alias("p2")
        )

    def order_citations(self) -> DataFrame:
        """A part cites the orders it is in; their ids follow the parts', so none is a paper."""
        last = self.table("part").agg(F.max("p_partkey")).scalar()
        return self.part_orders().withColumn("p2", F.col("p2") + last)

    def weighted_citations(self) -> DataFrame:
        """Citations with the least quantity of a citing line as their weight."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o"),
            F.col("l_linenumber").alias("n"),
            "l_partkey",
            F.col("l_quantity").cast("long").alias("weight"),
        )
        cited = lines.select("o", (F.col("n") - 1).alias("n"), F.col("l_partkey").alias("dst"))
        linked = lines.join(cited, ["o", "n"]).groupBy(F.col("l_partkey").alias("src"), "dst")
        weights = linked.agg(F.min("weight").alias("weight"))
        known = self.citations().toDF("src", "dst")
        return weights.join(known, ["src", "dst"])

    def poi(self) -> DataFrame:
        last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("last")
        yearly = (
            self.table("orders")
            .groupBy(
                F.col("o_custkey").alias("iOrder"),
                (F.year("o_orderdate") - 1994).cast("long").alias("timestep"),
            )
            .agg(last)
        )
        customer = self.table("customer").select(
            F.col("c_custkey").alias("iOrder"), F.col("c_mktsegment").alias("nowGroup")
        )
        grp = F.substring("last.o_orderpriority", 1, 1).cast("long").alias("grp")
        return yearly.join(customer, "iOrder").select("nowGroup", "iOrder", "timestep", grp)

    def halos(self) -> DataFrame:
        return (
            self.poi()
            .groupBy("nowGroup", F.col("grp").alias("grpID"), F.col("timestep").alias("timeStep"))
            .agg(F.count(F.lit(1)).alias("totalParticles"))
        )

    def raw_lines(self) -> DataFrame:
        """One text line per part, damaged in three ways for three of the sizes."""
        return self._lines().select("line")

    def _lines(self) -> DataFrame:
        size, key = F.col("p_size"), F.col("p_partkey").cast("string")
        line = (
            F.when(size == 1, F.concat(F.lit("x"), key, F.lit(",1999")))
            .when(size == 2, F.concat(key, F.lit(",1999,extra")))
            .when(size == 3, key)
            .otherwise(F.concat_ws(",", key, (size + 1950).cast("string")))
        )
        return self.table("part").select(size.alias("size"), line.alias("line"))

    def sized_lines(self) -> DataFrame:
        """The same lines with the part's size."""
        return self._lines().select("size", "line")

    def log_lines(self) -> DataFrame:
        """One timing-report line per order line; returned ones report another clock."""
        clock = F.when(F.col("l_returnflag") == "R", "user").otherwise("real")
        line = F.concat(
            clock,
            F.lit("\t"),
            F.col("l_linenumber").cast("string"),
            F.lit("m"),
            F.col("l_quantity").cast("int").cast("string"),
            F.lit("s"),
        )
        return self.table("lineitem").select(F.col("l_orderkey").alias("run_id"), line.alias("line"))
