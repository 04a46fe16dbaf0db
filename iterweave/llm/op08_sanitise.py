"""Personal data: patterns, and information-theoretic sanitisation of the terms around them.

Base spans are e-mail addresses, IP addresses, card and phone numbers by fixed patterns.
Each distinct value is a protected entity.  Removing it is not enough where other terms
give it away, so the corpus says how strongly a term reveals an entity: for a term t that
stands near entity e,

    disclosure(t, e) = log2( p(e | t) / p(e) ),   p(e | t) = documents with e near t / documents with t

A term is removed wherever it occurs (also where the entity is not named) when, for some
entity, p(e | t) is at least ``MIN_SHARE`` and the disclosure at least ``MIN_BITS``.  What
counts as seen are different wordings, one for the words around each mention, because copies
of one passage are one observation.  From ``MIN_WINDOWS`` wordings on, p(e | t) is as above;
below that it is smoothed,

    p(e | t) = wordings / (wordings + documents with t but not near e + SMOOTHING),

so rare entities are judged too, and a term seen in one wording alone says too little.

Three passes over the texts, none of which moves a text: (1) base spans and the terms near
them; (2) documents per candidate term, counted per task before the shuffle; (3) where the
revealing terms occur.  What passes 2 and 3 look for is sent to the tasks as a bitmap of
fixed size, whatever the number of terms; it only spares work, and exact joins decide.

Defined results: a null text is empty; repeated rows are separate documents in all counts;
a document without an id is treated like others; spans of terms that touch a base span are
left out; an empty table gives an empty result; other columns are ignored by ``spans`` and
passed through by ``sanitise``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from iterweave.workspace import Workspace

KINDS = ("email", "ip", "card", "phone")  # also their order at equal starts
TERM = "term"
NEAR = 8  # words on either side of an entity
MIN_WINDOWS = 3  # from here on p(e | t) needs no smoothing
SMOOTHING = 2
MIN_SHARE = 0.5
MIN_BITS = 4.0
BITMAP_BITS = 20

# The patterns of the base kinds.  The look-behinds change no match: inside
# a run of digits no match starts where none starts at the run's first digit.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORDS = re.compile(r"[^\W\d_]{3,}")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")  # free: end of the last match
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield "email", start, free
        else:
            free = max(free, start)
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    found: list[Span] = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def entity_of(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else re.sub(r'[^0-9.]' if kind == 'ip' else '[^0-9]', '', value)}"


def _free_words(text: str, base: list[Span]) -> list[re.Match]:
    """Words that touch no base span."""
    ends, reach = [], 0
    for _, _, end in base:
        reach = max(reach, end)
        ends.append(reach)
    starts = [s for _, s, _ in base]

    def free(m: re.Match) -> bool:
        before = bisect_left(starts, m.end())  # spans that start before the word ends
        return before == 0 or ends[before - 1] <= m.start()

    return [m for m in _WORDS.finditer(text) if free(m)]


def contexts(text: str, base: list[Span], near: int = NEAR) -> list[dict]:
    """Per entity of the text: the terms near its mentions, and for each different window the
    hash of its wording and its terms."""
    words = _free_words(text, base)
    starts = [m.start() for m in words]
    by_entity: dict[str, dict[int, set]] = {}
    for kind, start, end in base:
        at = bisect_left(starts, start)
        window = [m[0].lower() for m in words[max(0, at - near) : at + near]]
        wording = xxhash.xxh3_64_intdigest(" ".join(window)) >> 1
        by_entity.setdefault(entity_of(kind, text[start:end]), {})[wording] = set(window)
    return [
        {
            "entity": e,
            "terms": sorted(set().union(*windows.values())),
            "windows": [{"wording": w, "terms": sorted(t)} for w, t in windows.items()],
        }
        for e, windows in by_entity.items()
    ]


_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
_WINDOW = T.StructType(
    [T.StructField("wording", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType()))]
)
_CONTEXT = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("windows", T.ArrayType(_WINDOW)),
    ]
)
_ARROW_SPANS = pa.list_(pa.struct({"kind": pa.string(), "start": pa.int64(), "end": pa.int64()}))
_ARROW_CONTEXTS = pa.list_(
    pa.struct(
        {
            "entity": pa.string(),
            "terms": pa.list_(pa.string()),
            "windows": pa.list_(pa.struct({"wording": pa.int64(), "terms": pa.list_(pa.string())})),
        }
    )
)


def _as_structs(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are known by id and text; no row number is needed that a rerun could change."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("row"))


def found_entities(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """(doc_id, row, base, contexts) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, around = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text) if text else []
                base.append(_as_structs(spans))
                around.append(contexts(text, spans, near) if spans else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array(base, _ARROW_SPANS),
                    pa.array(around, _ARROW_CONTEXTS),
                ],
                ["doc_id", "row", "base", "contexts"],
            )

    rows = _keyed(docs)
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            rows.schema["row"],
            T.StructField("base", T.ArrayType(_SPAN)),
            T.StructField("contexts", T.ArrayType(_CONTEXT)),
        ]
    )
    return rows.mapInArrow(run, schema)


class Bitmap:
    """A set of terms with false positives, of fixed size."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.cache: dict[str, bool] = {}

    def __contains__(self, term: str) -> bool:
        known = self.cache.get(term)
        if known is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            known = self.cache[term] = bool(self.bits[term_bit(term)])
        return known


def term_bit(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) >> (64 - BITMAP_BITS)


def bitmap_of(terms: DataFrame) -> Bitmap:
    """Made in Spark: at most 2**BITMAP_BITS / 64 rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
        for batch in batches:
            for term in batch.column("term").to_pylist():
                bit = term_bit(term)
                words[bit >> 6] |= np.uint64(1 << (bit & 63))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["at", "bits"])

    parts = terms.select("term").mapInArrow(run, "at long, bits long")
    rows = parts.groupBy("at").agg(F.bit_or("bits").alias("bits")).collect()
    bits = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in rows:
        bits[r["at"]] = r["bits"]
    return Bitmap(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool))


def documents_per_term(docs: DataFrame, wanted: Bitmap) -> DataFrame:
    """(term, documents) for terms in the bitmap, counted per task first."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n: dict[str, int] = {}
            for text in batch.column("text").to_pylist():
                words = set(_WORDS.findall(text)) if text else ()
                for term in {w.lower() for w in words if w.lower() in known}:
                    n[term] = n.get(term, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["term", "n"]
            )

    counted = docs.select("text").mapInArrow(run, "term string, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("documents"))


def term_spans(docs: DataFrame, wanted: Bitmap) -> DataFrame:
    """(doc_id, row, term, start, end): occurrences that touch no base span; one set per
    row key, however often the row repeats."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            at, terms, starts, ends = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text or not any(w.lower() in known for w in set(_WORDS.findall(text))):
                    continue
                for m in _free_words(text, base_spans(text)):
                    if m[0].lower() in known:
                        at.append(i)
                        terms.append(m[0].lower())
                        starts.append(m.start())
                        ends.append(m.end())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows),
                    batch.column("row").take(rows),
                    pa.array(terms, pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                ],
                ["doc_id", "row", "term", "start", "end"],
            )

    rows = _keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row long, term string, start long, end long")


def revealing_terms(
    docs: DataFrame,
    found: DataFrame,
    ws: Workspace,
    min_windows: int = MIN_WINDOWS,
    min_share: float = MIN_SHARE,
    min_bits: float = MIN_BITS,
) -> DataFrame:
    """(term): terms that give an entity away."""
    near = found.select(F.explode("contexts").alias("c")).select("c.*")
    entities = near.groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    # A document counts once per term, a wording once however many documents hold it; the
    # row without a wording is the document's.
    of_documents = near.select("entity", F.explode("terms").alias("term")).select(
        "entity", "term", F.lit(None).cast("long").alias("wording")
    )
    of_windows = (
        near.select("entity", F.explode("windows").alias("w"))
        .select("entity", F.explode("w.terms").alias("term"), "w.wording")
    )
    wordings = F.col("wordings")
    pairs = (
        of_documents.union(of_windows)
        .groupBy("entity", "term", "wording")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term")
        .agg(
            F.sum(F.when(F.col("wording").isNull(), F.col("n"))).alias("both"),
            F.count("wording").alias("wordings"),
        )
        # No more than what p(e | t) can be rules a pair out here.
        .filter((wordings >= min_windows) | (wordings / (wordings + SMOOTHING) >= min_share))
    )
    pairs = ws.materialize(pairs, "pairs")
    if not pairs.rows:
        return pairs.df.select("term")
    total = found.count()
    terms = pairs.df.select("term").distinct()
    held = documents_per_term(docs, bitmap_of(terms))
    others = F.col("documents") - F.col("both")
    share = F.when(wordings >= min_windows, F.col("both") / F.col("documents")).otherwise(
        wordings / (wordings + others + SMOOTHING)
    )
    bits = F.log2(share * total / F.col("with_entity"))
    return (
        pairs.df.join(held, "term")
        .join(entities, "entity")
        .filter((share >= min_share) & (bits >= min_bits))
        .select("term")
        .distinct()
    )


def spans(docs: DataFrame, ws: Workspace | None = None, **limits) -> DataFrame:
    """(doc_id, row, base, spans) per row of ``docs``: base spans, and all spans."""
    ws = ws or Workspace(docs.sparkSession)
    found = ws.materialize(found_entities(docs), "entities").df
    terms = ws.materialize(revealing_terms(docs, found, ws, **limits), "terms")
    if not terms.rows:
        return found.select("doc_id", "row", "base", F.col("base").alias("spans"))
    at = F.struct(F.lit(TERM).alias("kind"), "start", "end")
    extra = (
        term_spans(docs, bitmap_of(terms.df))
        .join(terms.df, "term")
        .groupBy("doc_id", "row")  # bounded by the text
        .agg(F.collect_set(at).alias("extra"))
        .select(F.col("doc_id").alias("extra_id"), F.col("row").alias("extra_row"), "extra")
    )
    both = F.concat("base", F.coalesce("extra", F.array().cast("array<struct<kind:string,start:long,end:long>>")))
    order = F.transform(
        both,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("no"), s.alias("span")
        ),
    )
    # No term touches a base span, so terms need no place among the kinds.
    return found.join(
        extra, F.col("doc_id").eqNullSafe(F.col("extra_id")) & (F.col("row") == F.col("extra_row")), "left"
    ).select("doc_id", "row", "base", F.transform(F.sort_array(order), lambda x: x["span"]).alias("spans"))


def sanitise(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with every span replaced by its kind: ``<EMAIL>``, ..., ``<TERM>``."""
    columns = [c for c in docs.columns if c not in ("_row", "_spans")]
    docs = docs.select(*columns).withColumn("_row", F.xxhash64("text"))
    found = (
        spans(docs, **limits)
        .select(F.col("doc_id").alias("_id"), F.col("row").alias("_found"), F.col("spans").alias("_spans"))
        .dropDuplicates(["_id", "_found"])
    )
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_found")), "left")
    kept = joined.select(*columns, "_spans")
    schema = T.StructType([docs.schema[c] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, found in enumerate(batch.column("_spans").to_pylist()):
                if found:
                    texts[i] = replaced(texts[i], [(s["kind"], s["start"], s["end"]) for s in found])
            out = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(out, columns)

    return kept.mapInArrow(run, schema)


def replaced(text: str, found: list[Span]) -> str:
    """Spans by their kinds; of spans that overlap, the first stands for all."""
    out, free = [], 0
    for kind, start, end in found:
        if start >= free:
            out += [text[free:start], f"<{kind.upper()}>"]
        free = max(free, end)
    return "".join([*out, text[free:]])


def op8_sanitise(spark: SparkSession, docs: DataFrame) -> DataFrame:
    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return spans(docs).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
