"""Conversation structure repair: the cheapest edits that make the roles of a conversation
``(s?(ua)+)?``, by initials of system, user and assistant.

Edits: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty text by user
or assistant) 2; a kept or reroled truncated row adds 1; blank and duplicate rows can only be
deleted.  Of the cheapest edit sequences the one whose initials are ASCII-least is taken.

Both passes are secondary-sorted streams: rows are partitioned by conversation, sorted by turn
and read batch by batch, with a conversation's state carried from one batch to the next.  The
first pass goes from the last row to the first.  Its state is the least cost of the rest of the
conversation from each of the pattern's four states; a row's edit for every state takes two
bits, so one byte is its backpointer.  These are spilled in blocks to a written table, so a
conversation of any length holds one block in memory.  The second pass goes forward, with each
block ahead of its rows, and follows the backpointers from the start.  A conversation is in one
task by this method, but no task ever holds one; duplicates are marked before, by a window over
equal rows of a conversation.

Defined results: a null role or text is one space; a null conv_id is a conversation of its own;
rows of the same turn are ordered by role, then text; repeated rows are duplicates; a role that
starts with none of the initials can only be reroled or deleted; no rows, no conversation; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from iterweave.llm.common import once
from iterweave.workspace import Workspace

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs
BLOCK = 65_536  # rows whose backpointers a task holds

# The pattern's states: nothing yet, after s, after u, after a.  AHEAD is the state after the
# next user or assistant, ENDS are those that may be the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
AHEAD = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NAMES = {AFTER_U: "user", AFTER_A: "assistant"}
ENDS = (START, AFTER_A)
LETTERS = "DIKR"  # in ASCII order, which settles ties

FINE, MUST_GO, CUT = 0, 1, 2  # what a row's fault means for its edits
NEVER = 1 << 60


def _with_inserts(costs: list[int]) -> list[int]:
    """Least costs when turns may be inserted first; the longest chain is s, then u and a."""
    for _ in AHEAD:
        costs = [min(c, INSERT + costs[AHEAD[q]]) for q, c in enumerate(costs)]
    return costs


AT_END = tuple(_with_inserts([0 if q in ENDS else NEVER for q in range(4)]))


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, None where the pattern has no such role."""
    if initial == "s":
        return AFTER_S if state == START else None
    after = {"u": AFTER_U, "a": AFTER_A}.get(initial)
    return after if after == AHEAD[state] else None


def step_back(after: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
    """From the least costs after a row to those before it, less their minimum: (costs,
    minimum, backpointers); two bits per state name the first edit of the ASCII-least way."""
    options = []
    for q in range(4):
        found = {"D": DELETE + after[q]}
        if fault != MUST_GO:
            extra = TRUNCATED if fault == CUT else 0
            kept = kept_state(q, initial)
            if kept is not None:
                found["K"] = extra + after[kept]
            found["R"] = extra + REROLE + after[AHEAD[q]]
        options.append(found)
    costs = _with_inserts([min(o.values()) for o in options])
    code = 0
    for q, found in enumerate(options):
        found["I"] = INSERT + costs[AHEAD[q]]
        letter = min(x for x, cost in found.items() if cost == costs[q])
        code |= LETTERS.index(letter) << (2 * q)
    least = min(costs)
    return tuple(c - least for c in costs), least, code


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``conv`` (a key without nulls), ``pos`` (from 1),
    ``initial``, ``fault`` (blank, duplicate, truncated or null) and ``illegal`` (whether the
    row must not follow the one before it); partitioned by ``conv``."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = rows.select(key.alias("conv"), "turn", role, text)
    rows = rows.withColumn("same", F.md5(F.concat("role", F.lit("\n"), "text").cast("binary")))
    rows = rows.repartition("conv")
    order = ("turn", "role", "text")
    # Both windows keep the partitioning by conversation.
    seen = F.row_number().over(Window.partitionBy("conv", "role", "same").orderBy("turn"))
    rows = rows.withColumn("seen", seen)
    along = Window.partitionBy("conv").orderBy(*order)
    pair = F.concat(F.lag("initial").over(along), F.col("initial"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    return (
        rows.withColumn("initial", F.substring("role", 1, 1))
        .withColumn("pos", F.row_number().over(along).cast("long"))
        .withColumn("illegal", F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)))
        .withColumn("fault", fault)
        .drop("seen", "same")
    )


def _conversations(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """The rows of a stream, one at a time, across batches."""
    for frame in frames:
        yield from frame.itertuples(index=False)


def _in_frames(rows: Iterator[tuple], columns: list[str], size: int = 2000) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, columns=columns, dtype=object)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns, dtype=object)


def backpointers(marked: DataFrame, buckets: int, block: int = BLOCK) -> DataFrame:
    """(conv, pos, codes, cost): a byte per row of ``marked``, last row first, in blocks that
    are named by the first of their positions; ``cost`` is that of the whole conversation, in
    the block of its first row."""

    def blocks(stream: Iterator[tuple]) -> Iterator[tuple]:
        known: dict = {}
        conv, costs, total, codes, pos = None, AT_END, 0, bytearray(), 0
        for row in stream:
            if row.conv != conv:
                if codes:
                    yield conv, pos, bytes(codes), total + costs[START]
                conv, costs, total, codes = row.conv, AT_END, 0, bytearray()
            elif len(codes) == block:
                yield conv, pos, bytes(codes), None
                codes = bytearray()
            case = costs, row.initial, row.need
            if case not in known:  # few: costs differ by less than the price of an insertion pair
                known[case] = step_back(*case)
            costs, more, code = known[case]
            total += more
            codes.append(code)
            pos = row.pos
        if codes:
            yield conv, pos, bytes(codes), total + costs[START]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _in_frames(blocks(_conversations(frames)), ["conv", "pos", "codes", "cost"], 50)

    need = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(
        F.col("fault") == "truncated", CUT
    )
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("")
    rows = marked.select(
        "conv", "pos", initial.alias("initial"), F.coalesce(need, F.lit(FINE)).alias("need")
    )
    rows = rows.repartition(buckets, "conv").sortWithinPartitions("conv", F.desc("pos"))
    return rows.mapInPandas(run, "conv string, pos long, codes binary, cost long")


EDITS = ["conv", "step", "edit", "role", "text", "cost", "repaired_sha256"]


def repair(
    marked: DataFrame, ws: Workspace, block: int = BLOCK, edits: bool = True
) -> DataFrame:
    """The edits of every conversation in order: (conv, step, edit, role, text), role and text
    as they are after the edit (text null for deleted rows).  The row that follows a
    conversation's last edit has step 0, all its ``edit`` initials, its ``cost`` and the digest
    of its repaired rows.  Without ``edits`` there are only these rows.

    ``marked`` comes from ``faults``, as a written table."""
    blocks = ws.materialize(backpointers(marked, ws.partitions, block), "backpointers").df

    def follow(stream: Iterator[tuple]) -> Iterator[tuple]:
        conv = first = None
        state, codes, cost = START, b"", None
        audit, text_digest, step, written = bytearray(), sha256(), 0, False

        def put(edit: str, role: str, text: str | None) -> tuple:
            nonlocal step, written
            step += 1
            audit.extend(edit.encode())
            if text is not None:
                line = f"{role}:{text}" if not written else f"\n{role}:{text}"
                text_digest.update(line.encode("utf-8", "surrogatepass"))
                written = True
            return conv, step, edit, role, text, None, None

        def finish() -> Iterator[tuple]:
            nonlocal state
            while state not in ENDS:
                state = AHEAD[state]
                yield put("I", NAMES[state], "")
            yield conv, 0, audit.decode(), None, None, cost, text_digest.hexdigest()

        for row in stream:
            if row.conv != conv:
                if conv is not None:
                    yield from finish()
                conv, state = row.conv, START
                cost = int(row.cost)  # the first row's block comes first
                audit, text_digest, step, written = bytearray(), sha256(), 0, False
            if row.codes is not None:
                first, codes = row.pos, row.codes
                continue
            code = codes[len(codes) - 1 - (row.pos - first)]
            while (letter := LETTERS[code >> (2 * state) & 3]) == "I":
                state = AHEAD[state]
                yield put("I", NAMES[state], "")
            if letter == "D":
                yield put("D", row.role, None)
            elif letter == "K":
                state = kept_state(state, row.role[:1])
                yield put("K", row.role, row.text)
            else:
                state = AHEAD[state]
                yield put("R", NAMES[state], row.text)
        if conv is not None:
            yield from finish()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = follow(_conversations(frames))
        wanted = found if edits else (row for row in found if row[1] == 0)
        yield from _in_frames(wanted, EDITS, 500)

    none = F.lit(None)
    ahead = blocks.select(
        "conv", "pos", "codes", F.col("cost").cast("double").alias("cost"), none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).alias("kind")
    )
    rows = marked.select(
        "conv", "pos", none.cast("binary").alias("codes"), none.cast("double").alias("cost"), "role", "text", F.lit(1).alias("kind")
    )
    stream = ahead.unionByName(rows).repartition(ws.partitions, "conv")
    stream = stream.sortWithinPartitions("conv", "pos", "kind")
    schema = "conv string, step long, edit string, role string, text string, cost long, repaired_sha256 string"
    return stream.mapInPandas(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by a checksum of conversation and turn."""
    blank = F.lit(" ")
    ids = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), blank).alias(c) for c in ("role", "text")]
    )
    rows = once(rows, "kind", F.crc32(F.concat_ws(":", *ids).cast("binary")) % 20)
    text = (
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        rows.filter("kind <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies))
        .drop("col")
    )


def op11_repair_conversations(
    spark: SparkSession, conversations: DataFrame, block: int = BLOCK
) -> DataFrame:
    ws = Workspace(spark)
    marked = ws.materialize(faults(damage(conversations)), "marked").df
    repaired = repair(marked, ws, block, edits=False)

    def number(condition) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = marked.groupBy("conv").agg(
        F.coalesce(turns, F.lit(0)).alias("gaps"),
        *[number(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        number(F.col("illegal")).alias("illegal"),
    )
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    every = conversations.select("conv_id", key.alias("conv")).distinct()
    found = every.join(counts, "conv", "left").join(repaired, "conv", "left")
    zero = [
        F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    return found.select(
        "conv_id",
        *zero,
        F.coalesce("edit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )
