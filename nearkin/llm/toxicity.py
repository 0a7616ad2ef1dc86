"""Toxicity categories predicted one after the other by a chain of linear models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.llm.arrow import LOWER, NOT_WORD, batches_of_bytes, flat, hashes, runs
from nearkin.llm.columns import text_or_empty

#: Labelled rows that train a chain, at most.
TRAIN_ROWS = 20_000
#: Values that a word's hash can take; the number of weights of a model.
BUCKETS = 1 << 18
FOLDS = 4
STEPS = 150
#: Rows that a word must occur in to count.
MIN_DOCS = 5
#: The least logarithm of the ratio of a word's shares in the two classes.
MIN_RATIO = 0.7
THRESHOLD = 0.5

# Words that tell apart two categories among documents labelled toxic.
INSULTS = ("idiot", "moron", "clown", "stupid", "loser")
CONTEMPT = ("trash", "scum", "worthless", "pathetic", "disgusting")
#: The categories in the order of the chain; the last is what the labels say.
CHAIN = ("insult", "contempt", "toxic")


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts, the distinct buckets of their words in lower case, and each text's first one."""
    data, bounds = flat(texts)
    data = LOWER[data]
    starts, ends, first = runs(~NOT_WORD[data], bounds)
    buckets = (hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    both = np.unique(owner * BUCKETS + buckets)
    owner, buckets = both // BUCKETS, both % BUCKETS
    return buckets, np.searchsorted(owner, np.arange(len(bounds)))


@dataclass
class Linear:
    """Weights of word buckets and of the categories before, and a constant."""

    words: np.ndarray
    earlier: np.ndarray
    constant: float

    def predict(self, buckets: np.ndarray, first: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.words[buckets], dtype=np.float64)])
        score = sums[first[1:]] - sums[first[:-1]] + earlier @ self.earlier + self.constant
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit_linear(buckets: np.ndarray, first: np.ndarray, earlier: np.ndarray, target: np.ndarray, l2: float = 1e-3) -> Linear:
    """Logistic regression by accelerated gradient steps; both classes weigh the same.

    A word's feature is the logarithm of how much likelier it is in one class than in the other,
    as counted over the rows; words of fewer than MIN_DOCS rows or a logarithm under MIN_RATIO
    have none. So words that tell the classes apart in many rows decide before words of a few can.
    """
    n = len(target)
    owner = np.repeat(np.arange(n), np.diff(first))
    positives, negatives = float(target.sum()), float(n - target.sum())
    with_word = np.bincount(buckets, minlength=BUCKETS)
    positive = np.bincount(buckets, weights=target[owner], minlength=BUCKETS)
    ratio = np.log((positive + 1) / (positives + 2)) - np.log((with_word - positive + 1) / (negatives + 2))
    ratio[(with_word < MIN_DOCS) | (np.abs(ratio) < MIN_RATIO)] = 0
    telling = ratio[buckets] != 0
    buckets, owner = buckets[telling], owner[telling]
    scale = ratio[buckets]
    weight = np.where(target > 0, 1 / (2 * max(1.0, positives)), 1 / (2 * max(1.0, negatives)))
    norms = np.bincount(owner, weights=scale**2, minlength=n) + (earlier**2).sum(axis=1) + 1
    step = 4 / float(weight @ norms)
    size = BUCKETS + earlier.shape[1] + 1
    now, ahead = np.zeros(size), np.zeros(size)
    for t in range(STEPS):
        words, rest, constant = ahead[:BUCKETS], ahead[BUCKETS:-1], ahead[-1]
        score = np.bincount(owner, weights=scale * words[buckets], minlength=n) + earlier @ rest + constant
        apart = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) * weight
        slope = np.concatenate(
            [np.bincount(buckets, weights=scale * apart[owner], minlength=BUCKETS), earlier.T @ apart, [apart.sum()]]
        )
        slope[:-1] += l2 * ahead[:-1]
        then = ahead - step * slope
        ahead = then + t / (t + 3) * (then - now)
        now = then
    return Linear((now[:BUCKETS] * ratio).astype(np.float32), now[BUCKETS:-1], float(now[-1]))


def _rows_of(buckets: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)[chosen]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes) + np.repeat(first[:-1][chosen], sizes)
    return buckets[at], ends


@dataclass
class Chain:
    """One linear model per category, each reading the probabilities of those before."""

    categories: tuple[str, ...]
    models: list[Linear]

    def predict(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros((len(first) - 1, len(self.models)))
        for i, model in enumerate(self.models):
            out[:, i] = model.predict(buckets, first, out[:, :i])
        return out


def fit_chain(buckets: np.ndarray, first: np.ndarray, targets: np.ndarray, categories: tuple[str, ...], folds: int = FOLDS) -> Chain:
    """Fit category after category.

    What a later model reads of an earlier category in training are predictions of models that
    did not see the row, as in use; the chain keeps models fitted on all rows.
    """
    n = len(first) - 1
    fold = np.arange(n) % folds
    seen = np.zeros((n, len(categories)))
    models = []
    for i in range(len(categories)):
        earlier = seen[:, :i]
        models.append(fit_linear(buckets, first, earlier, targets[:, i]))
        if i + 1 == len(categories):
            break
        for k in range(folds):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if not len(inside) or not len(outside):
                continue
            part = fit_linear(*_rows_of(buckets, first, inside), earlier[inside], targets[inside, i])
            seen[outside, i] = part.predict(*_rows_of(buckets, first, outside), earlier[outside])
    return Chain(categories, models)


def category_labels(text: Column, toxic: Column) -> list[Column]:
    """Labels of the chain's categories: words of two kinds among toxic documents, and toxic."""
    words = F.split(F.lower(text), r"[^a-z]+")
    return [
        *[
            F.when((toxic == 1) & F.arrays_overlap(words, F.array(*map(F.lit, kind))), 1).otherwise(0).alias(name)
            for name, kind in (("insult", INSULTS), ("contempt", CONTEMPT))
        ],
        F.when(toxic == 1, 1).otherwise(0).alias("toxic"),
    ]


def train(labelled: DataFrame, categories: tuple[str, ...] = CHAIN, text_col: str = "text", rows: int = TRAIN_ROWS) -> Chain | None:
    """A chain fitted on at most ``rows`` rows of ``labelled``, chosen by a hash of the text.

    ``labelled`` has the text and a 0/1 column per category; rows with a null label are left out.
    Only word buckets of the chosen rows reach the driver. None without rows.
    """
    chosen = (
        labelled.select(text_or_empty(text_col).alias("text"), *[F.col(c).cast("int").alias(c) for c in categories])
        .dropna(subset=list(categories))
        .orderBy(F.xxhash64("text"), *categories)
        .limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text"):
            buckets, first = word_features(batch.column("text"))
            values = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(buckets, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [values, *[batch.column(c) for c in categories]], names=["buckets", *categories]
            )

    table = chosen.mapInArrow(run, ", ".join(["buckets array<int>", *[f"`{c}` int" for c in categories]])).toArrow()
    if not table.num_rows:
        return None
    lists = table["buckets"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    first = lists.offsets.to_numpy().astype(np.int64)
    buckets = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)[first[0] :]
    targets = np.stack([table[c].to_numpy() for c in categories], axis=1).astype(np.float64)
    return fit_chain(buckets, first - first[0], targets, categories)


def predict(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, a probability per category, and ``is_toxic`` by the last one.

    A null text has no words; rows may repeat; an empty table gives an empty one. Without a chain
    all probabilities are 0.
    """
    spark = docs.sparkSession
    categories = chain.categories if chain else CHAIN
    shared = spark.sparkContext.broadcast(chain)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches_of_bytes(batches, "text"):
            n = batch.num_rows
            found = own.predict(*word_features(batch.column("text"))) if own else np.zeros((n, len(categories)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(found[:, i]) for i in range(len(categories))], pa.array(found[:, -1] >= THRESHOLD)],
                names=["doc_id", *[f"p_{c}" for c in categories], "is_toxic"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"`p_{c}` double" for c in categories) + ", is_toxic boolean")


def train_on_labels(docs: DataFrame, labels: DataFrame) -> Chain | None:
    """The chain of CHAIN's categories from ``labels`` (``doc_id, toxic``).

    Rows are chosen by a hash of the id before texts are joined to them, so the join moves no
    more texts than are used.
    """
    chosen = (
        labels.filter("doc_id is not null and toxic is not null").select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "toxic").limit(TRAIN_ROWS)
    )
    labelled = docs.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    return train(labelled.select("text", *category_labels(F.col("text"), F.col("toxic"))))
