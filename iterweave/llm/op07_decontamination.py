"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items form one suffix automaton, whose states stand for
sets of word sequences that occur in the items.  Each document's words are streamed through
it, tracking the longest match that ends at every word.  Where the match is at least
``WINDOW`` words long, the window ending there occurs in an item; an item shorter than a
window is one window itself, found at the states its end leads to.  All words inside such
windows are hit.

A span is a run of hit words.  ``decontaminate`` drops documents whose hits exceed the
coverage limit and cuts the spans out of the others.

The automaton grows with the benchmark, not with the corpus.  Items are streamed to the
driver in blocks of at most ``BLOCK_WORDS`` words (an item is never split); each block's
automaton is one broadcast and one step of a pass over the documents.  A pass takes
``BLOCKS_A_PASS`` blocks and is written before the next one starts, so a task holds that many
automata, and the driver that many blocks, whatever the benchmark's size.

Defined results: a null or wordless text has no words and no hits; null or wordless items
match nothing; items with the same text all count, and a null item_id is left out of the
list; repeated rows are treated alike; empty tables give empty or clean results; columns
other than those used pass through ``decontaminate`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from iterweave.workspace import Workspace

WINDOW = 13
COVERAGE = 20  # contaminated when hits are at least 1/20 of the words
BLOCK_WORDS = 200_000  # words per automaton
BLOCKS_A_PASS = 4

# Separators become spaces and A-Z lower case; what is left are the words.
_SEPARATORS = [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_NORMAL = bytearray(range(256))
for _byte in _SEPARATORS:
    _NORMAL[_byte] = 0x20
for _byte in range(0x41, 0x5B):
    _NORMAL[_byte] = _byte + 0x20
_NORMAL = bytes(_NORMAL)
_WORD = re.compile(rb"[^ ]+")


def normal_words(data: bytes | None) -> list[bytes]:
    return data.translate(_NORMAL).split() if data else []


class SuffixAutomaton:
    """Of word sequences; numbers the words it knows."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: By state: the items that hold its sequences (states of window length and more).
        self.items: dict[int, set] = {}
        #: By state: items shorter than a window that end here.
        self.short: dict[int, set] = {}
        read = []
        for item, words in items:
            codes = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            last = 0
            for code in codes:
                last = self._extend(last, code)
            read.append((item, codes))
        for item, codes in read:
            self._mark(item, codes)
        self._mark_above()

    def _add(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """A copy of ``target`` for the sequences one word longer than ``state``'s."""
        copy = self._add(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(code) == target:
            self.step[state][code] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, code: int) -> int:
        known = self.step[last].get(code)
        if known is not None:  # an earlier item went the same way
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, code, known)
        new, state = self._add(self.length[last] + 1, {}, 0), last
        while state >= 0 and code not in self.step[state]:
            self.step[state][code] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][code]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, code, target)
            self.link[new] = target
        return new

    def _mark(self, item, codes: list[int]) -> None:
        state = 0
        for code in codes:
            state = self.step[state][code]
            at = state
            while self.length[at] >= self.window and item not in self.items.setdefault(at, set()):
                self.items[at].add(item)
                at = self.link[at]
        if 0 < len(codes) < self.window:
            self.short.setdefault(state, set()).add(item)

    def _mark_above(self) -> None:
        """By state: the nearest state on its chain of suffixes at which a short item ends."""
        self.nearest = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            found = state if state in self.short else self.nearest[self.link[state]]
            self.nearest[state] = found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans of hit words (first, end), and the items with windows in them."""
        number, step, link, length = self.numbers.get, self.step, self.link, self.length
        nearest, window = self.nearest, self.window
        spans: list[tuple[int, int]] = []
        found: set = set()
        state = matched = 0
        for at, word in enumerate(words):
            code = number(word)
            if code is None:
                state = matched = 0
                continue
            while state and code not in step[state]:
                state = link[state]
                matched = length[state]
            if code not in step[state]:
                continue
            state = step[state][code]
            matched += 1
            reach = 0
            if matched >= window:
                reach, holder = window, state
                while length[link[holder]] >= window:
                    holder = link[holder]
                found |= self.items[holder]
            short = nearest[state]
            if short == state and matched < length[state]:
                short = nearest[link[state]]
            while short > 0:
                found |= self.short[short]
                reach = max(reach, length[short])
                short = nearest[link[short]]
            if reach:
                first = at + 1 - reach
                while spans and first <= spans[-1][1]:
                    first = min(first, spans.pop()[0])
                spans.append((first, at + 1))
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list]:
    items = benchmark.select(
        F.col("item_id").cast("string"), F.col("text").cast("binary").alias("data")
    )
    block, held = [], 0
    for item, data in items.toLocalIterator():
        words = normal_words(bytes(data) if data is not None else None)
        if not words:
            continue
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((item, words))
        held += len(words)
    if block:
        yield block


_INSIDE = ("_data", "_n_words", "_spans", "_items")
_SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
_FOUND = T.StructType(
    [
        T.StructField("_n_words", T.LongType()),
        T.StructField("_spans", T.ArrayType(_SPAN)),
        T.StructField("_items", T.ArrayType(T.StringType())),
    ]
)


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans' words and what lies between them."""
    at = [m.span() for m in _WORD.finditer(data.translate(_NORMAL))]
    out, kept_to = [], 0
    for first, end in spans:
        out.append(data[kept_to : at[first][0]])
        kept_to = at[end - 1][1]
    return b"".join([*out, data[kept_to:]])


def _scanned(found: DataFrame, block: Broadcast, window: int, first: bool, last: bool) -> DataFrame:
    """One block's step: adds to the spans and items; the last one cuts the text."""
    passed = [f for f in found.schema.fields if f.name not in _INSIDE]
    text = T.StructField("_data", T.StringType() if last else T.BinaryType())
    schema = T.StructType([*passed, text, *_FOUND.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(block.value, window)
        for batch in batches:
            texts = batch.column("_data").to_pylist()
            spans_of = [] if first else batch.column("_spans").to_pylist()
            items_of = [] if first else batch.column("_items").to_pylist()
            sizes, spans, names = [], [], []
            for at, data in enumerate(texts):
                words = normal_words(data)
                hit, held = automaton.hits(words)
                if not first:
                    hit = merged([*hit, *((x["first"], x["end"]) for x in spans_of[at])])
                    held |= set(items_of[at])
                if last and hit:
                    texts[at] = cut(data, hit)
                sizes.append(len(words))
                spans.append([{"first": a, "end": b} for a, b in hit])
                names.append(sorted(x for x in held if x is not None))
            columns = [batch.column(f.name) for f in passed]
            columns += [
                pa.array(texts, pa.binary()).cast(pa.string()) if last else pa.array(texts, pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct({"first": pa.int64(), "end": pa.int64()}))),
                pa.array(names, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    return found.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    ws: Workspace | None = None,
) -> DataFrame:
    """``docs`` without ``text``, and ``_data`` (the text with the spans cut out),
    ``_n_words``, ``_spans`` (hit runs in word positions) and ``_items``."""
    others = [F.col(c) for c in docs.columns if c not in ("text", *_INSIDE)]
    found = docs.select(*others, F.col("text").cast("binary").alias("_data"))
    blocks = _blocks(benchmark, block_words)
    ws = ws or Workspace(docs.sparkSession)
    now, first = next(blocks, []), True
    alive: list[Broadcast] = []
    while now is not None:
        if len(alive) == BLOCKS_A_PASS:
            found = ws.materialize(found, "scanned").df
            while alive:
                alive.pop().destroy()
        following = next(blocks, None)
        alive.append(docs.sparkSession.sparkContext.broadcast(now))
        found = _scanned(found, alive[-1], window, first, last=following is None)
        now, first = following, False
    return found


def n_hit() -> Column:
    return F.expr("aggregate(_spans, 0L, (n, s) -> n + s.end - s.first)")


def contaminated() -> Column:
    return (n_hit() > 0) & (COVERAGE * n_hit() >= F.col("_n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents within the coverage limit, their hit spans cut out.  Columns as ``docs``
    (those with this module's private names are dropped); ``n_chars`` follows the text."""
    keep = [c for c in docs.columns if c not in _INSIDE]
    clean = contamination(docs.select(*keep), benchmark).filter(~contaminated())
    clean = clean.withColumn("text", F.col("_data"))
    if "n_chars" in keep:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size("_spans") > 0, length).otherwise(F.col("n_chars")))
    return clean.select(*keep)


def op7_decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    names = F.array_join("_items", ",")
    return contamination(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
