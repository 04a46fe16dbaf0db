"""Removal of repeated line chunks, with content-defined chunk boundaries.

Every line is hashed; a rolling hash covers a line and the one before it.  A chunk ends
after a line whose rolling hash is a local minimum, so a boundary depends on a few lines
around it only: text inserted elsewhere in the document does not move it.  Local minima
are at least two lines apart and none is taken at the very ends, so chunks have two lines
or more.  A line of more than 50 words is a passage of its own: it is a chunk by itself.

A chunk is removed where it repeats: all its occurrences in the corpus but the first (by
document id, then by position) go, if it has several lines or is such a long line.
Occurrences are grouped by their bytes and meet by the SHA-256 of them.

Chunking happens inside the row, without a shuffle.  The chunks are grouped with map-side
aggregation, so a chunk that a third of all documents hold reaches the reducers once per
task; what returns to the documents is the numbers of the removed chunks.

Chunks miss a passage of a few short lines that holds no two boundaries of its own.  With
``passages`` (the pipeline's stage; the query and its SQL are the chunks alone) a second
step finds those: from every line on, and back from every line, the fewest lines that hold
more than 50 words are a window.  Any shared run of lines with more than 50 words shares
the windows inside it, and these cover it.  Windows meet by the SHA-256 of their bytes; the
lines of all occurrences but the first go, but not of those that overlap the first.
Windows are taken from the text as it was read, so chunks that go break no passage.

Defined results: a null text stays null, an empty one empty (one empty line); documents
without an id come first, those of the same id (or none) by a hash of their texts; repeated
rows (same id and text) count as one document and all keep what it keeps; an empty table
gives an empty result; other columns pass through unchanged
(``n_chars``, if present, follows the text).  A document may end up empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from iterweave.llm.common import let, once, word_count
from iterweave.workspace import Workspace

MIN_LINES = 2
LONG_WORDS = 50  # a line of more words is a chunk by itself
ROLL, RANGE = 31, 2**31 - 1
ROW_BITS = 62  # of a row's hash: with the id in front it fits a decimal of 38 digits

_PRIVATE = ("_chunks", "_row", "_id", "_gone", "_lines", "_windows")


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.translate(line, " ", ""))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _rolled(hashes: Column) -> Column:
    """Of every line and the one before it."""
    shifted = F.concat(F.array(F.lit(0).cast("long")), F.slice(hashes, F.lit(1), F.size(hashes) - 1))
    return F.zip_with(hashes, shifted, lambda now, before: (before * ROLL + now) % RANGE)


def _ends(roll: Column, long: Column) -> Column:
    """The numbers (from 1) of the lines after which a chunk ends."""
    n = F.size(roll)

    def ends_chunk(i: Column) -> Column:
        before, here, after = (F.get(roll, i - 2), F.get(roll, i - 1), F.get(roll, i))
        lowest = (i >= 2) & (i <= n - 2) & (here < before) & (here <= after)
        return lowest | F.get(long, i - 1) | F.get(long, i)

    inner = F.filter(F.sequence(F.lit(1), n - 1), ends_chunk)
    return F.when(n > 1, F.concat(inner, F.array(n))).otherwise(F.array(n))


def _cut(lines: Column, long: Column, ends: Column) -> Column:
    def chunk(end: Column, i: Column) -> Column:
        first = F.when(i == 0, F.lit(1)).otherwise(F.get(ends, i - 1) + 1)
        text = F.array_join(F.slice(lines, first, end - first + 1), "\n")
        removable = (end - first + 1 >= MIN_LINES) | F.get(long, end - 1)
        return F.struct(
            text.alias("text"),
            removable.alias("removable"),
            (first - 1).alias("first"),
            (end - 1).alias("last"),
        )

    return F.transform(ends, chunk)


def chunks_of(text: Column) -> Column:
    """An array of (text, removable, first, last), in order, that join to the text; first and
    last line count from 0."""

    def of_lines(lines: Column) -> Column:
        def of_marks(long: Column) -> Column:
            return let(
                _rolled(F.transform(lines, _line_hash)),
                lambda roll: let(_ends(roll, long), lambda ends: _cut(lines, long, ends)),
            )

        return let(F.transform(lines, lambda line: _spaces(line) >= LONG_WORDS), of_marks)

    return let(_lines_of(text), of_lines)


def _lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows_of(text: Column) -> Column:
    """An array of (first, last, key): the shortest runs of lines with more than 50 words
    that start with a line or end with one; the lines count from 0."""

    def of_lines(lines: Column) -> Column:
        # The line of every word: a line that n words come before starts at place n.
        places = F.flatten(
            F.transform(lines, lambda line, i: F.array_repeat(i, word_count(line).cast("int")))
        )
        return let(places, lambda line_of: _windows(lines, line_of))

    def _windows(lines: Column, line_of: Column) -> Column:
        n = F.size(line_of)

        def place(at: Column) -> Column:
            return F.get(line_of, at).cast("long")

        def code(first: Column, last: Column) -> Column:  # arrays of longs are made distinct by hashing
            return F.shiftleft(first, 32) + last

        starts = F.filter(
            F.sequence(F.lit(0), n - 1 - LONG_WORDS), lambda at: (at == 0) | (place(at - 1) != place(at))
        )
        ends = F.filter(
            F.sequence(F.lit(LONG_WORDS), n - 1), lambda at: (at == n - 1) | (place(at + 1) != place(at))
        )
        forth = F.transform(starts, lambda at: code(place(at), place(at + LONG_WORDS)))
        back = F.transform(ends, lambda at: code(place(at - LONG_WORDS), place(at)))

        def window(at: Column) -> Column:
            first = F.shiftright(at, 32).cast("int")
            last = at.bitwiseAND(F.lit(2**32 - 1)).cast("int")
            held = F.array_join(F.slice(lines, first + 1, last - first + 1), "\n")
            key = F.unhex(F.sha2(held.cast("binary"), 256))
            return F.struct(first.alias("first"), last.alias("last"), key.alias("key"))

        found = F.transform(F.array_distinct(F.concat(forth, back)), window)
        return F.when(n > LONG_WORDS, found).otherwise(
            F.array().cast("array<struct<first:int,last:int,key:binary>>")
        )

    return let(_lines_of(text), of_lines)


def repeated_windows(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(_id, _row, _lines): for each document that holds passages seen before, the numbers
    (from 0) of their lines."""
    windows = (
        _keyed(docs)
        .select("_id", "_row", F.explode(windows_of(F.col("text"))).alias("w"))
        .select("_id", "_row", "w.first", "w.last", "w.key")
    )
    place = F.struct("_id", "_row", "first", "last")
    groups = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept"))
    repeated = ws.materialize(groups.filter("n > 1").select("key", "kept"), "repeated").df
    same = (F.col("_id") == F.col("kept._id")) & (F.col("_row") == F.col("kept._row"))
    found = windows.join(repeated, "key").filter(~same | (F.col("first") > F.col("kept.last")))
    # A row's windows are bounded by its text.
    per_row = found.groupBy("_id", "_row").agg(F.collect_set(F.struct("first", "last")).alias("_windows"))
    lines = F.flatten(F.transform("_windows", lambda w: F.sequence(w["first"], w["last"])))
    return per_row.select("_id", "_row", F.array_distinct(lines).alias("_lines"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(_id, _row, _gone): for each document that loses chunks, their numbers (from 0)."""
    chunks = (
        _keyed(docs)
        .select("_id", "_row", F.posexplode(chunks_of(F.col("text"))).alias("no", "chunk"))
        .filter("chunk.removable")
        .select("_id", "_row", "no", "chunk.text")
    )
    # Grouping by the text itself is the byte comparison.
    groups = chunks.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("holder"))
    repeated = groups.filter("n > 1").select(_digest().alias("key"), "holder")
    found = (
        chunks.select("_id", "_row", "no", _digest().alias("key"))
        .join(repeated, "key")
        .select(
            "_id",
            "_row",
            F.struct("key", "no", (_place() == F.col("holder")).alias("first")).alias("at"),
        )
    )
    # In the first document only the first of equal chunks stays.  A row's chunks are
    # bounded by its text.
    per_row = found.groupBy("_id", "_row").agg(F.sort_array(F.collect_set("at")).alias("_at"))
    gone = F.filter(
        "_at",
        lambda x, i: ~x["first"] | (F.coalesce(F.get("_at", i - 1)["key"] == x["key"], F.lit(False))),
    )
    return per_row.select("_id", "_row", F.transform(gone, lambda x: x["no"]).alias("_gone")).filter(
        F.size("_gone") > 0
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by id and text: no row number is needed that a rerun could give differently."""
    row = F.shiftrightunsigned(F.xxhash64("text"), 64 - ROW_BITS)
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn(
        "_row", row
    )


def _place() -> Column:
    """(_id, _row) as one number: the least of pairs would need sorting, that of numbers only
    hashing."""
    by_id = F.col("_id").cast("decimal(20,0)") * F.lit(2**ROW_BITS).cast("decimal(19,0)")
    return by_id + F.col("_row").cast("decimal(20,0)")


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def dedup_lines(docs: DataFrame, passages: bool = False, ws: Workspace | None = None) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and ``n_chunks``,
    ``n_removed``; with ``passages`` also what chunks leave of repeated passages, and
    ``n_passage_lines``."""
    added = ["n_chunks", "n_removed", *(["n_passage_lines"] if passages else [])]
    keep = [c for c in docs.columns if c not in (*_PRIVATE, *added)]
    docs = docs.select(*keep)
    joined = _keyed(docs).join(repeated_chunks(docs), ["_id", "_row"], "left")
    if passages:
        ws = ws or Workspace(docs.sparkSession)
        joined = joined.join(repeated_windows(docs, ws), ["_id", "_row"], "left")
    df = once(joined, "_chunks", chunks_of(F.col("text")))
    nothing = F.array().cast("array<int>")
    gone = F.coalesce("_gone", nothing)
    if passages:
        lines = F.coalesce("_lines", nothing)
        of_chunks = F.flatten(
            F.transform(
                gone,
                lambda no: F.sequence(F.get("_chunks", no)["first"], F.get("_chunks", no)["last"]),
            )
        )
        text = let(
            _lines_of(F.col("text")),
            lambda all_lines: F.array_join(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.concat(of_chunks, lines)),
                    lambda i: F.get(all_lines, i),
                ),
                "\n",
            ),
        )
        whole = F.col("_gone").isNull() & F.col("_lines").isNull()
    else:
        numbers = F.sequence(F.lit(0), F.size("_chunks") - 1)
        left = F.array_except(numbers, gone)
        text = F.array_join(F.transform(left, lambda i: F.get("_chunks", i)["text"]), "\n")
        whole = F.col("_gone").isNull()
    out = {
        "n_chunks": F.size("_chunks").cast("long"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        "text": F.when(whole, F.col("text")).otherwise(text),
    }
    if passages:
        out["n_passage_lines"] = F.size(lines).cast("long")
    df = df.withColumns(out)
    if "n_chars" in keep:
        changed = F.col("n_removed") > 0
        if passages:
            changed = changed | (F.col("n_passage_lines") > 0)
        df = df.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")))
    return df.select(*keep, *added)


def op2_line_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return dedup_lines(docs).select(
        "doc_id",
        "n_chunks",
        "n_removed",
        F.length(text).cast("long").alias("kept_chars"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


SQL = f"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
numbered as (
  select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as i, len(lines) as n
  from split),
hashed as (
  select *, length(line) - length(replace(line, ' ', '')) >= {LONG_WORDS} as long,
         ('0x' || substr(md5(line), 1, 8))::bigint as h
  from numbered),
rolled as (
  select *, (coalesce(lag(h) over w, 0) * {ROLL} + h) % {RANGE} as r,
         lead(long) over w as long_next
  from hashed window w as (partition by doc_id order by i)),
ends as (
  select *, i < n and ((i >= 2 and i <= n - 2 and r < lag(r) over w and r <= lead(r) over w)
                       or long or long_next) as cut
  from rolled window w as (partition by doc_id order by i)),
parted as (
  select *, coalesce(sum(cut::int) over (partition by doc_id order by i
                     rows between unbounded preceding and 1 preceding), 0) as no
  from ends),
chunks as (
  select doc_id, no, string_agg(line, chr(10) order by i) as chunk,
         count(*) >= {MIN_LINES} or bool_or(long) as removable
  from parted group by doc_id, no),
judged as (
  select *, removable and row_number() over (partition by chunk, removable
                                             order by doc_id, no) > 1 as gone
  from chunks),
joined as (
  select doc_id, count(*) as n_chunks, count(*) filter (gone) as n_removed,
         coalesce(string_agg(chunk, chr(10) order by no) filter (not gone), '') as kept
  from judged group by doc_id)
select doc_id, n_chunks, n_removed, length(kept) as kept_chars, sha256(kept) as kept_sha256
from joined
"""
