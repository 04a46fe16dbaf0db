"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: how often each symbol followed each context of
up to three bytes.  A symbol's probability comes from the longest known context; where the
context has not seen the symbol, an escape (method C: as many escapes as distinct symbols)
passes on to the next shorter one, whose symbols already seen above are excluded.  The
statistics are frozen after training, so a text's code length under a language is exact:
the sum of -log2 of these probabilities.  The language with the shortest code wins; the
score is its posterior under equal priors.

Symbols are bytes of the UTF-8 text: ASCII letters in lower case, all other ASCII as one
separator, and the bytes above 0x7F as they are.  Bytes never seen in training are one
further symbol.

Bounded: training takes at most ``MAX_DOCS`` whole documents a language (those with the
smallest hashes of their ids); the table has one row for each of at most ``MAX_CONTEXTS``
contexts (the most frequent; others fall back to the next shorter context).  The counts
are a Spark aggregation; the table is broadcast.  Every text is scored whole, in one pass
without a shuffle.

Defined results: null text, or text without a letter, is ``und`` with score 0, as is
everything when there is nothing to learn from; equal code lengths go to the smaller
language name; an empty text in ``lang`` is a language like others; rows without an id are
never held out and never learned from; repeated rows are treated alike; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_DOCS = 300
MAX_CONTEXTS = 20_000  # of each length and language, by that language's own counts
SLICE = 1 << 20  # symbols scored at once
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")

SEPARATOR, LETTERS = 0, 26


def base_symbols() -> np.ndarray:
    """Byte to symbol: 0 for a separator, 1-26 letters, 27 and up the bytes above 0x7F."""
    table = np.zeros(256, np.int64)
    for letter in range(LETTERS):
        table[0x41 + letter] = table[0x61 + letter] = 1 + letter
    table[0x80:] = np.arange(128) + LETTERS + 1
    return table


BASE = base_symbols()
WIDTH = LETTERS + 1 + 128  # base symbols


def grams(data: bytes) -> np.ndarray:
    """The symbols with their three predecessors, as one number; separators come first."""
    s = np.concatenate([np.zeros(3, np.int64), BASE[np.frombuffer(data, np.uint8)]])
    return ((s[:-3] * WIDTH + s[1:-2]) * WIDTH + s[2:-1]) * WIDTH + s[3:]


@dataclass
class Model:
    """``bits[row * width + symbol]``: code lengths by language; ``rows``: by context."""

    languages: list[str]
    symbols: np.ndarray  # byte to symbol of this model
    width: int
    rows: np.ndarray
    bits: np.ndarray

    def code_lengths(self, data: bytes) -> np.ndarray:
        total = np.zeros(len(self.languages))
        tail = np.zeros(3, np.int64)
        for at in range(0, len(data), SLICE):
            s = np.concatenate([tail, self.symbols[np.frombuffer(data[at : at + SLICE], np.uint8)]])
            context = (s[:-3] * self.width + s[1:-2]) * self.width + s[2:-1]
            place = self.rows[context] * self.width + s[3:]
            total += self.bits[place].sum(axis=0, dtype=np.float64)
            tail = s[-3:]
        return total

    def predict(self, data: bytes) -> tuple[str, float]:
        lengths = self.code_lengths(data)
        best = int(lengths.argmin())
        return self.languages[best], float(1 / np.exp2(lengths[best] - lengths).sum())


def has_letter(data: bytes | None) -> bool:
    if not data:
        return False
    return bool(_ASCII_LETTER.search(data)) or any(map(str.isalpha, data.decode("utf-8", "replace")))


def training_counts(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(lang, gram, n) over the training documents."""
    usable = docs.filter("doc_id is not null and lang is not null and text is not null").filter(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    )
    nearest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("lang", "doc_id")
        .withColumn("rank", F.row_number().over(nearest))  # limited per task before the shuffle
        .filter(F.col("rank") <= max_docs)
        .select("doc_id")
        .distinct()
    )
    sample = usable.join(F.broadcast(chosen), "doc_id")  # max_docs rows a language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[np.ndarray]] = {}
            for lang, data in zip(
                batch.column("lang").to_pylist(), batch.column("data").to_pylist(), strict=True
            ):
                by_language.setdefault(lang, []).append(grams(data))
            for lang, parts in by_language.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                names = pa.array([lang] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(found), pa.array(n)], ["lang", "gram", "n"])

    data = sample.select("lang", F.col("text").cast("binary").alias("data"))
    counted = data.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _refined(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """PPM's probabilities from counts by context (rows) and those of the next shorter
    context: method C escapes, with exclusion.  Contexts never seen take the shorter's."""
    total = counts.sum(axis=1, keepdims=True)
    seen = counts > 0
    distinct = seen.sum(axis=1, keepdims=True)
    unseen = np.where(seen, 0.0, shorter)
    left = unseen.sum(axis=1, keepdims=True)
    whole = distinct == counts.shape[1]  # nothing left to escape to
    base = total + np.where(whole, 0, distinct)
    safe = np.maximum(base, 1)
    escaped = unseen * (distinct / safe) / np.where(left > 0, left, 1.0)
    return np.where(total > 0, np.where(seen, counts / safe, escaped), shorter)


def build(counts: list[tuple[str, int, int]], max_contexts: int = MAX_CONTEXTS) -> Model:
    languages = sorted({lang for lang, _, _ in counts})
    number = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([number[x[0]] for x in counts], np.int64)
    gram = np.array([x[1] for x in counts], np.int64)
    n = np.array([x[2] for x in counts], np.int64)
    used = np.unique(np.concatenate([gram // WIDTH**i % WIDTH for i in range(4)] + [np.arange(1)]))
    width = len(used) + 1  # the last symbol stands for all bytes not seen
    dense = np.full(WIDTH, width - 1, np.int64)
    dense[used] = np.arange(len(used))
    a, b, c, d = (dense[gram // WIDTH**i % WIDTH] for i in (3, 2, 1, 0))

    three, two = (a * width + b) * width + c, b * width + c
    kept3, kept2 = (
        np.unique(
            np.concatenate([_frequent(key[lang == i], n[lang == i], max_contexts) for i in number.values()])
        )
        for key in (three, two)
    )
    # Rows: contexts of one symbol, then of two, then of three.  A context of three is kept
    # with its last two known, so each falls back to a row of its own.
    kept3 = kept3[np.isin(kept3 % width**2, kept2)]
    row2 = np.tile(np.arange(width), width)
    row2[kept2] = width + np.arange(len(kept2))
    row3 = np.tile(row2, width)
    row3[kept3] = width + len(kept2) + np.arange(len(kept3))
    bits = np.empty((width + len(kept2) + len(kept3), width, len(languages)), np.float32)
    for i in range(len(languages)):
        own = lang == i

        def table(rows: np.ndarray, count: int, own: np.ndarray = own) -> np.ndarray:
            at = rows >= 0
            flat = np.bincount(rows[at] * width + d[own][at], n[own][at], count * width)
            return flat.reshape(count, width)

        def places(keys: np.ndarray, kept: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(kept, keys), max(len(kept) - 1, 0))
            return np.where(kept[at] == keys, at, -1) if len(kept) else np.full(len(keys), -1)

        zero = _refined(table(np.zeros(own.sum(), np.int64), 1), np.full((1, width), 1.0 / width))
        one = _refined(table(c[own], width), np.repeat(zero, width, axis=0))
        second = _refined(table(places(two[own], kept2), len(kept2)), one[kept2 % width])
        below = second[np.searchsorted(kept2, kept3 % width**2)]
        third = _refined(table(places(three[own], kept3), len(kept3)), below)
        bits[:, :, i] = -np.log2(np.concatenate([one, second, third]))
    return Model(languages, dense[BASE], width, row3.astype(np.int32), bits.reshape(-1, len(languages)))


def _frequent(keys: np.ndarray, n: np.ndarray, limit: int) -> np.ndarray:
    """The ``limit`` most frequent keys, sorted."""
    found, at = np.unique(keys, return_inverse=True)
    often = np.bincount(at, n)
    return np.sort(found[np.argsort(-often, kind="stable")[:limit]])


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    counts = [(r["lang"], r["gram"], r["n"]) for r in training_counts(docs, max_docs).collect()]
    return build(counts) if counts else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            made = [
                known.predict(x) if known and has_letter(x) else (UNKNOWN, 0.0)
                for x in batch.column("data").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    data = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return data.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op10_language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "lang", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return identify(docs, train(docs)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
