"""Toxicity by a classifier chain.

The chain predicts one category after the other.  Each link is a logistic model over the
words of a text, their character 5-grams and the probabilities of all earlier categories.
What a later link is trained on are the earlier links' *out-of-fold* predictions: each
labelled row gets them from models that have not seen its fold, so the later link learns
how far to trust them on new text.  Features are chosen inside the same folds.

What is bounded, and by what: the models are fitted on at most ``MAX_ROWS`` labelled rows
(those with the smallest hashes of their ids), ``FEATURES`` features a model, and
``FOLDS`` folds.  The feature statistics of these rows are a Spark aggregation; only the
chosen features and the rows' use of them, both bounded, reach the driver, where the small
models are fitted.  Every text of the corpus is then scored whole in one pass without a
shuffle.

Defined results: a null or wordless text has the probabilities of no features and is never
toxic; rows without an id are scored like others; labels that are null, or of unknown
documents, are not learned from; a document labelled twice has a category if one label
says so; a category without rows of both kinds gets the constant share of its positive
rows; with no labels at all nothing is toxic.  Other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from iterweave.workspace import Workspace

MAX_ROWS = 10_000
FOLDS = 3
FEATURES = 800
MIN_ROWS = 3  # a feature is in at least so many of the labelled rows
GRAM = 5
THRESHOLD = 0.3  # rather one clean text too many out than a toxic one in
RIDGE = 1.0
PARTS = 8  # tasks that count the labelled rows' features
CACHED_WORDS = 200_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_in(text: str | None) -> set[str]:
    return set(_LETTERS.findall(text.lower())) if text else set()


def features_of(word: str) -> set[str]:
    """The word itself and its character 5-grams, with its ends marked."""
    marked = f"^{word}$"
    return {marked, *(marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1))}


class Lookup:
    """Words to the numbers of the chosen features they contain."""

    def __init__(self, features: list[str]):
        self.numbers = {f: i for i, f in enumerate(features)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def of(self, text: str | None) -> list[int]:
        found: set[int] = set()
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        for word in words_in(text):
            known = self.cache.get(word)
            if known is None:
                known = tuple(self.numbers[f] for f in features_of(word) if f in self.numbers)
                self.cache[word] = known
            if known:
                found.update(known)
        return sorted(found)


@dataclass
class Rows:
    """Which features each row has: ``of[i]`` is a feature of row ``at[i]``."""

    count: int
    at: np.ndarray
    of: np.ndarray

    @staticmethod
    def gather(lists: list[list[int]]) -> Rows:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter((f for x in lists for f in x), np.int32, int(sizes.sum()))
        return Rows(len(lists), np.repeat(np.arange(len(lists)), sizes), flat)

    def only(self, kept: np.ndarray) -> Rows:
        """The rows where ``kept`` is true, numbered anew."""
        number = np.cumsum(kept) - 1
        inside = kept[self.at]
        return Rows(int(kept.sum()), number[self.at[inside]], self.of[inside])


@dataclass
class Link:
    """One logistic model: weights by feature number, and of the earlier categories."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, rows: Rows, earlier: np.ndarray, features: int) -> np.ndarray:
        weight = np.zeros(features + 1)
        weight[self.features] = self.weights
        score = np.bincount(rows.at, weight[rows.of], rows.count)
        return sigmoid(score + earlier @ self.earlier + self.bias)


@dataclass
class Chain:
    categories: list[str]
    features: list[str] = field(default_factory=list)
    links: list[Link] = field(default_factory=list)

    def predict(self, rows: Rows) -> np.ndarray:
        """Probabilities by row and category."""
        out = np.zeros((rows.count, len(self.categories)))
        for number, link in enumerate(self.links):
            out[:, number] = link.predict(rows, out[:, :number], len(self.features))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_link(
    rows: Rows, earlier: np.ndarray, y: np.ndarray, chosen: np.ndarray, features: int, steps: int = 200
) -> Link:
    """Ridge logistic regression by accelerated gradient descent."""
    count, width = rows.count, len(chosen)
    share = (y.sum() + 0.5) / (count + 1.0)
    if not count or y.min() == y.max():
        # Of one kind only: its share, as a constant.
        bias = 30.0 if count and y[0] else -30.0
        return Link(chosen[:0], np.empty(0), np.zeros(earlier.shape[1]), bias)
    place = np.full(features, -1)
    place[chosen] = np.arange(width)
    inside = place[rows.of] >= 0
    at, of = rows.at[inside], place[rows.of[inside]]
    extra = np.hstack([earlier, np.ones((count, 1))])
    # Rows with many features bound the curvature of the loss.
    spread = np.bincount(at, minlength=count).max(initial=0) + extra.shape[1]
    used = np.bincount(of, minlength=width)
    # Scaling by use makes frequent and rare features learn alike.
    scale = np.concatenate([1 / np.sqrt(used + RIDGE), np.full(extra.shape[1], 1 / np.sqrt(count))])
    theta = np.zeros(width + extra.shape[1])
    theta[-1] = np.log(share / (1 - share)) / scale[-1]
    ridge = RIDGE * scale**2
    ridge[-1] = 0.0
    look, momentum = theta.copy(), 1.0
    step = 1.0 / (0.25 * min(spread, 64) + RIDGE)
    for _ in range(steps):
        real = look * scale
        score = np.bincount(at, real[of], count) + extra @ real[width:]
        error = sigmoid(score) - y
        gradient = np.concatenate([np.bincount(of, error[at], width), extra.T @ error])
        following = look - step * (gradient * scale + ridge * look)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look = following + (momentum - 1) / after * (following - theta)
        theta, momentum = following, after
    real = theta * scale
    return Link(chosen, real[:width], real[width:-1], float(real[-1]))


def labelled_rows(docs: DataFrame, labels: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """(doc_id, text, fold, one 0/1 column per category): at most MAX_ROWS rows."""
    known = labels.select("doc_id", *[c.cast("int").alias(n) for n, c in categories.items()])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in categories])
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS)
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    joined = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    return joined.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int"))


def chosen_features(rows: DataFrame, categories: list[str]) -> DataFrame:
    """(category, fold, feature): the strongest features for every model, by chi-square.
    Fold f stands for the model that has not seen fold f, FOLDS for the one of all rows."""
    names = list(categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = list(zip(*(batch.column(c).to_pylist() for c in ["fold", *names]), strict=True))
            seen: dict[tuple, int] = {}
            for text, kind in zip(batch.column("text").to_pylist(), kinds, strict=True):
                for f in set().union(*map(features_of, words_in(text))):
                    seen[f, kind] = seen.get((f, kind), 0) + 1
            columns = [[k[0] for k in seen], *zip(*(k[1] for k in seen), strict=True)]
            columns = columns if seen else [[] for _ in range(len(names) + 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    *(pa.array(list(c), pa.int32()) for c in columns[1:]),
                    pa.array(list(seen.values()), pa.int64()),
                ],
                ["feature", "fold", *names, "n"],
            )

    schema = f"feature string, fold int, {', '.join(f'{c} int' for c in names)}, n long"
    counted = rows.repartition(PARTS, "doc_id").select("text", "fold", *names).mapInArrow(count, schema)
    whole = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("long").alias(c) for c in names]
    )
    totals = {r["fold"]: r for r in whole.collect()}  # one row per fold
    sums = []
    for f in range(FOLDS):
        inside = F.col("fold") == f
        sums.append(F.sum(F.when(inside, F.col("n")).otherwise(0)).alias(f"n_{f}"))
        for c in names:
            hit = inside & (F.col(c) == 1)
            sums.append(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"{c}_{f}"))
    stats = counted.groupBy("feature").agg(F.sum("n").alias("n"), *sums).filter(F.col("n") >= MIN_ROWS)
    candidates = []
    for out in range(FOLDS + 1):
        learn = [f for f in range(FOLDS) if f != out]
        total = float(sum(totals[f]["n"] for f in learn if f in totals))
        n = sum((F.col(f"n_{f}") for f in learn), F.lit(0)).cast("double")
        for c in names:
            positive = float(sum(totals[f][c] for f in learn if f in totals))
            hit = sum((F.col(f"{c}_{f}") for f in learn), F.lit(0)).cast("double")
            off = hit * total - n * positive
            spread = n * (total - n) * positive * (total - positive)
            candidates.append(
                F.struct(
                    F.lit(c).alias("category"),
                    F.lit(out).alias("fold"),
                    F.coalesce(F.try_divide(off * off, spread), F.lit(0.0)).alias("strength"),
                )
            )
    best = Window.partitionBy("category", "fold").orderBy(F.desc("strength"), "feature")
    return (
        stats.select("feature", F.explode(F.array(*candidates)).alias("x"))
        .select("feature", "x.*")
        .filter("strength > 0")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= FEATURES)
        .select("category", "fold", "feature")
    )


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], ws: Workspace) -> Chain:
    """``categories``: names in chain order, with the 0/1 expression over ``labels``."""
    names = list(categories)
    rows = ws.materialize(labelled_rows(docs, labels, categories), "labelled").df
    chosen = chosen_features(rows, names).collect()
    features = sorted({r["feature"] for r in chosen})
    number = {f: i for i, f in enumerate(features)}
    by_model = {
        (c, f): np.array(sorted(number[r["feature"]] for r in chosen if (r["category"], r["fold"]) == (c, f)), np.int64)
        for c in names
        for f in range(FOLDS + 1)
    }
    shared = rows.sparkSession.sparkContext.broadcast(features)

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        for batch in batches:
            found = pa.array([lookup.of(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ["doc_id", "fold", *names]), found],
                ["doc_id", "fold", *names, "features"],
            )

    fields = [rows.schema[c] for c in ["doc_id", "fold", *names]]
    schema = T.StructType([*fields, T.StructField("features", T.ArrayType(T.IntegerType()))])
    data = rows.mapInArrow(used, schema).toArrow().sort_by("doc_id")  # at most MAX_ROWS rows
    lists = data.column("features").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    uses = Rows(data.num_rows, np.repeat(np.arange(data.num_rows), sizes), lists.flatten().to_numpy())
    folds = data.column("fold").to_numpy()
    chain = Chain(names, features)
    unseen = np.zeros((data.num_rows, len(names)))  # out-of-fold probabilities
    for at, name in enumerate(names):
        y = data.column(name).to_numpy().astype(float)
        earlier = unseen[:, :at]
        chain.links.append(fit_link(uses, earlier, y, by_model[name, FOLDS], len(features)))
        if at + 1 < len(names):
            for f in range(FOLDS):
                hold = folds == f
                link = fit_link(uses.only(~hold), earlier[~hold], y[~hold], by_model[name, f], len(features))
                unseen[hold, at] = link.predict(uses.only(hold), earlier[hold], len(features))
    return chain


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category, and whether the last one's
    probability reaches the threshold, under its name."""
    target = chain.categories[-1]
    added = [*(f"p_{c}" for c in chain.categories), target]
    docs = docs.select(*[c for c in docs.columns if c not in added])
    model = docs.sparkSession.sparkContext.broadcast(chain)
    schema = T.StructType(
        [
            *docs.schema.fields,
            *(T.StructField(c, T.DoubleType()) for c in added[:-1]),
            T.StructField(target, T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.value.features)
        for batch in batches:
            rows = [lookup.of(t) for t in batch.column("text").to_pylist()]
            p = model.value.predict(Rows.gather(rows))
            reached = p[:, -1] >= threshold if model.value.links else np.zeros(len(rows), bool)
            reached &= np.array([len(r) > 0 for r in rows], bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x) for x in p.T), pa.array(reached)], schema.fieldNames()
            )

    return docs.mapInArrow(run, schema)


def categories_of() -> dict[str, Column]:
    """The label table's categories, in chain order."""
    return {"low_quality": F.lit(1) - F.col("quality"), "toxic": F.col("toxic")}


def op5_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    chain = train(docs, labels, categories_of(), Workspace(spark))
    return score(docs.select("doc_id", "text"), chain).drop("text")
