"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is a stream of its documents' words, documents in a pseudo-random order that
depends on their ids only.  The stream is cut into blocks of equally many words.  The
points of the golden-ratio sequence are mapped through the cumulative weights, so that
slot n of the mix belongs to one source; the r-th slot of a source takes its block
``r mod blocks``, in epoch ``r div blocks``.  Joining slots with blocks gives the mix:
which words of which document are taken in which slot.

A low-discrepancy sequence serves each source within a few slots of its share.  Slots past
a source's target are skipped; the few that it was short of follow at the end; its last
slot is cut to the word.  So each source yields its rounded target exactly.

Sizes grow with the data only where work is spread: documents are ordered inside 2**16
hash buckets per source and the slots are ranked inside chunks, so a source with a third
of all rows is never ordered in one task.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of
its own, after all others; a null id is ordered like the empty string; repeated rows are
separate documents; an empty table gives an empty mix.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.llm.common import WORD, word_count
from iterweave.workspace import Workspace

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
MAX_EPOCHS = 3  # a source is taken at most this often
BLOCK_WORDS = 4096
BUCKET_BITS = 16  # documents of a source are ordered inside 2**16 hash buckets
CHUNK_SLOTS = 1 << 16  # slots are ranked inside runs of this many

# The golden-ratio sequence on a grid: point n is n * GOLDEN mod GRID.
GRID_BITS = 31
GRID = 1 << GRID_BITS
GOLDEN = 1327217885  # odd, nearest to GRID / 1.618033988749895
CELL_BITS = 14  # points find their source by cells of the grid


@dataclass(frozen=True)
class Mix:
    """``pieces``: one row per document piece and slot; ``sources``: targets."""

    documents: DataFrame
    pieces: DataFrame
    slots: DataFrame
    sources: DataFrame


def _long(value) -> Column:
    return F.lit(value).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    place = F.conv(F.substring(key, 1, 15), 16, 10).cast("long")
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("skey"),
        word_count(F.col("text")).alias("size"),
        place.alias("place"),
        F.shiftright(place, 60 - BUCKET_BITS).alias("bucket"),
    )


def source_targets(totals: DataFrame, weights=WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """Share the whole size by weight; sources stop at ``cap`` times their size.

    Taking sources by rising cap per weight, a source is capped exactly when its cap is
    below its share of what the sources before it left over.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    before = Window.orderBy("ratio", F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[_long(w) for w in weights]), turn + 1)
    most = _long(cap) * F.col("source_size")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), _long(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), _long(0)
    )
    open_size = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("most"))).over(everything), _long(0)
    )
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    share = open_size.cast("double") * F.col("weight") / open_weight
    return (
        totals.withColumn("weight", weight)
        .withColumn("most", most)
        .withColumn("ratio", F.col("most").cast("double") / F.col("weight"))
        .withColumn("capped", F.col("ratio") < left.cast("double") / weight_left)
        .withColumn("target", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(share))
        .select("skey", "source", "source_size", "most", "target")
    )


def _with_slots(sources: DataFrame, block: int) -> DataFrame:
    """How many blocks each source has and how many slots it needs."""
    size, take = F.col("source_size"), F.col("take")
    some = F.when(size > 0, size).otherwise(_long(1))
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    return (
        sources.withColumn("take", F.least("most", F.floor(F.col("target") + 0.5)).cast("long"))
        .withColumn("blocks", blocks)
        .withColumn("whole", (take - take % some) / some)
        .withColumn("whole", F.col("whole").cast("long"))
        .withColumn("rest", take % some)
        .withColumn("need", F.expr(f"whole * blocks + (rest + {block - 1}) div {block}"))
    )


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """(slot, skey, rank): the source of every slot and its rank among that source's slots."""
    up_to = Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, 0)
    scale = F.lit(float(GRID) / max(slots, 1))
    edges = (
        sources.select("skey", "need", F.sum("need").over(up_to).alias("upper"))
        .withColumn("low", F.floor((F.col("upper") - F.col("need")) * scale).cast("long"))
        .withColumn("high", F.floor(F.col("upper") * scale).cast("long"))
    )
    shift = GRID_BITS - CELL_BITS
    cells = edges.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift)))
    )
    points = (
        spark.range(slots)
        .withColumnRenamed("id", "slot")
        .withColumn("point", (F.col("slot") % GRID * _long(GOLDEN)) % GRID)
        .withColumn("cell", F.shiftright("point", shift))
    )
    drawn = points.join(cells, "cell").filter("point >= low and point < high")
    drawn = drawn.select("slot", "skey", "need", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk"))
    counts = drawn.groupBy("skey", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("skey").orderBy("chunk")
    counts = counts.withColumn("base", F.sum("n").over(earlier) - F.col("n"))
    inside = Window.partitionBy("skey", "chunk").orderBy("slot")
    ranked = (
        drawn.join(counts.drop("n"), ["skey", "chunk"])
        .withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)
        .filter(F.col("rank") < F.col("need"))
        .select("slot", "skey", "rank")
    )
    served = counts.groupBy("skey").agg(F.sum("n").alias("served"))
    short = (
        edges.select("skey", "need")
        .join(served, "skey", "left")
        .withColumn("served", F.coalesce("served", _long(0)))
        .filter("need > served")
        .withColumn("rank", F.explode(F.sequence("served", F.col("need") - 1)))
        .select((_long(slots) + F.col("rank") - F.col("served")).alias("slot"), "skey", "rank")
    )
    return ranked.unionByName(short)


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    cap: int = MAX_EPOCHS,
    block: int = BLOCK_WORDS,
    ws: Workspace | None = None,
) -> Mix:
    """Plan the mix.  ``pieces`` has (slot, epoch, block, source, doc_id, first_word, words):
    take ``words`` words of the document from word ``first_word`` on (0-based)."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark)
    sized = ws.materialize(sizes(docs), "sizes").df
    totals = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    stored = ws.materialize(
        _with_slots(source_targets(totals, weights, cap), block), "sources", slots=F.sum("need")
    )
    sources, slots = stored.df, int(stored.metrics["slots"] or 0)

    earlier = Window.partitionBy("skey").orderBy("bucket")
    buckets = (
        sized.groupBy("skey", "bucket")
        .agg(F.sum("size").alias("in_bucket"))
        .withColumn("base", F.sum("in_bucket").over(earlier) - F.col("in_bucket"))
        .join(sources.select("skey", "source_size", "target"), "skey")
        .drop("in_bucket")
    )
    inside = (
        Window.partitionBy("skey", "bucket")
        .orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    documents = (
        sized.join(buckets, ["skey", "bucket"])
        .withColumn("until", F.col("base") + F.sum("size").over(inside))
        .withColumn("start", F.col("until") - F.col("size"))
        .select("doc_id", "source", "skey", "size", "source_size", "target", "start", "until")
    )
    documents = ws.materialize(documents, "documents").df

    slot_blocks = (
        schedule(spark, sources, slots)
        .join(sources.select("skey", "blocks", "whole", "rest"), "skey")
        .withColumn("epoch", F.expr("rank div blocks"))
        .withColumn("block", F.expr("rank % blocks"))
        .select(
            "slot",
            "skey",
            "epoch",
            "block",
            F.when(F.col("epoch") == F.col("whole"), F.col("rest")).alias("limit"),
        )
    )
    held = F.sequence(F.expr(f"start div {block}"), F.expr(f"(until - 1) div {block}"))
    parts = (
        documents.filter("size > 0")
        .withColumn("block", F.explode(held))
        .withColumn("from", F.greatest("start", F.col("block") * block))
        .withColumn("to", F.least("until", (F.col("block") + 1) * block))
    )
    to = F.least("to", F.coalesce("limit", "to"))
    pieces = (
        parts.join(slot_blocks, ["skey", "block"])
        .withColumn("words", to - F.col("from"))
        .filter("words > 0")
        .select(
            "slot",
            "epoch",
            "block",
            "skey",
            "source",
            "doc_id",
            "start",
            (F.col("from") - F.col("start")).alias("first_word"),
            "words",
        )
    )
    return Mix(documents, pieces, slot_blocks, sources)


def taken(mixed: Mix) -> DataFrame:
    """How many words of every document the mix takes.  A document with words is known by
    its place in its source's stream, so repeated rows stay apart."""
    used = mixed.pieces.groupBy("skey", "start").agg(F.sum("words").alias("taken"))
    some = mixed.documents.filter("size > 0").join(used, ["skey", "start"], "left")
    none = mixed.documents.filter("size = 0").withColumn("taken", _long(0))
    return some.unionByName(none, allowMissingColumns=True).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", _long(0)).alias("taken"),
    )


def op3_mix_sources(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return taken(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


# The closed form: a source's stream is taken ``whole`` times and then up to ``rest``.
SQL = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as place
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, 3 * source_size as most,
         [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3) + 1]::bigint as weight
  from totals),
ratios as (select *, most::double / weight as ratio from weighted),
capping as (
  select *, ratio < (sum(source_size) over () - coalesce(sum(most) over earlier, 0))::double
                    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as capped
  from ratios
  window earlier as (order by ratio, source nulls last
                     rows between unbounded preceding and 1 preceding)),
targets as (
  select *, case when capped then most::double else
    (sum(source_size) over () - coalesce(sum(case when capped then most end) over (), 0))::double
    * weight / sum(case when not capped then weight end) over () end as target
  from capping),
takes as (select *, least(most, floor(target + 0.5)::bigint) as take from targets),
placed as (
  select s.doc_id, s.size, t.source_size, t.target, t.take,
         sum(s.size) over (partition by s.source order by s.place, s.doc_id, s.size
                           rows between unbounded preceding and current row) - s.size as start
  from sized s join takes t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       case when size = 0 then 0 else
         (take // source_size) * size + greatest(0, least(size, take % source_size - start))
       end::bigint as taken
from placed
"""
