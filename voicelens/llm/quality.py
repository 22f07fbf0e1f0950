"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document has one latent score, the sum of the weights of its hashed features;
ordered thresholds cut the latent line into grades:
``P(grade >= k) = sigmoid(score - threshold_k)``.  All grades share the weights.
From the probabilities follow the expected grade and the tail probability by
which documents are selected.

Features are presence features of the whole text, hashed into ``2 ** bits``
weights: its distinct words and their stems (first letters), and bucketed shares (of repeated neighbours, of
distinct words, of repeated lines, of words with symbols, of upper-case words,
and its length).

Training uses at most ``max_labels`` rated documents, chosen by a hash of their
id, as sorted feature positions (a document has at most ``2 ** bits`` of them).
One task runs gradient steps over that bounded sample, with rates of their own
for every weight and an absolute penalty, so that a feature few documents show
counts if it decides and is zero if not; models trained on
parts and averaged found far fewer of the rare decisive words.  Scoring is one
pass over all documents without a shuffle.
"""

from __future__ import annotations

import math
import operator
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
EPOCHS = 6
MAX_LABELS = 20_000
GRADES = 3
#: Characters of a word's stem feature.
STEM = 5
#: Chosen on rated documents held out of the fit: a document's features are divided by this power of the sum of their squares
#: (a full 0.5 hides a decisive word in a long text), the absolute penalty, the rate, and the extra weight of middle grades.
SCALE, PENALTY, RATE, MIDDLE = 0.25, 4.0, 2.0, 2.5
MEMO_WORDS = 100_000
SYMBOLS = "#*$%&|<>!?~^=+@{}[]\\_"


class FeatureIndex(dict):
    """Hashed position of each word, filled on first use."""

    def __missing__(self, word: str) -> int:
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        return value


_index = FeatureIndex()
_INNER = str.maketrans("", "", ".,;:!?\"'()")


def _bucket(name: str, share: float) -> str:
    return f"\0{name}{min(10, math.ceil(share * 10))}"


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature positions of a whole text (null: those of an empty one)."""
    if len(_index) > MEMO_WORDS:
        _index.clear()
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    distinct = set(words)
    lines = [x for x in text.split("\n") if x]
    names = {w.lower().translate(_INNER) for w in distinct}
    names.update([f"{w[:STEM]}~" for w in names if len(w) > STEM])
    symbols = sum(w[-1] in SYMBOLS for w in words)
    names.update((
        _bucket("again", sum(map(operator.eq, words, words[1:])) / n),
        _bucket("distinct", len(distinct) / n),
        _bucket("lines", 1 - len(set(lines)) / max(1, len(lines))),
        _bucket("symbols", symbols / n),
        _bucket("upper", sum(map(str.isupper, words)) / n),
        f"\0long{len(words).bit_length()}",
    ))
    return np.unique(np.fromiter(map(_index.__getitem__, names), np.int64, len(names)))


class Model:
    """Shared weights, rarity of each feature in the rated sample, and ordered thresholds.

    Features of nearly every document weigh little; a document's features are
    scaled down by their number (``SCALE``).
    """

    def __init__(self, weights: np.ndarray, rarity: np.ndarray, thresholds: np.ndarray):
        self.weights, self.rarity, self.thresholds = weights, rarity, thresholds
        self.weighted, self.squares = weights * rarity, rarity * rarity

    def tails(self, at: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 ... of a document with these features."""
        z = self.weighted[at].sum() / (self.squares[at].sum() + 1e-12) ** SCALE - self.thresholds
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def keep_all() -> Model:
    """The model of a corpus without ratings: every document has the highest grade."""
    return Model(np.zeros(1 << BITS), np.ones(1 << BITS), np.full(GRADES - 1, -10.0))


def fit(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, threshold_rate: float = 0.05, decay: float = 0.5, penalty: float = PENALTY) -> Model:
    """Penalised maximum likelihood by regularised-leader steps over rows (features, grade), in their order."""
    seen = np.zeros(1 << BITS)
    for at, _ in rows:
        seen[at] += 1
    rarity = np.minimum(1.0, np.log((len(rows) + 1) / (seen + 1)) / math.log(20) + 0.05)
    sizes = np.bincount([grade for _, grade in rows], minlength=GRADES)
    importance = np.minimum(4.0, np.sqrt(len(rows) / ((sizes > 0).sum() * np.maximum(sizes, 1))))
    importance[1:-1] *= MIDDLE
    pulled, squares, t = np.zeros(len(seen)), np.zeros(len(seen)), np.arange(GRADES - 1) * 1.5 - 3.0

    def weights(at):
        z = pulled[at]
        return np.where(np.abs(z) <= penalty, 0.0, -(z - np.sign(z) * penalty) * rate / (1 + np.sqrt(squares[at])))

    for epoch in range(epochs):
        slower = 1 / (1 + decay * epoch)
        for at, grade in rows:
            x = rarity[at]
            x = x / ((x * x).sum() + 1e-12) ** SCALE
            w = weights(at)
            tail = np.r_[1.0, 1 / (1 + np.exp(-np.clip((w * x).sum() - t, -30, 30))), 0.0]
            slope = tail * (1 - tail)
            pull = importance[grade] / max(tail[grade] - tail[grade + 1], 1e-9)
            down = -pull * (slope[grade] - slope[grade + 1]) * x                            # against log P(grade), by weight
            more = squares[at] + down * down
            pulled[at] += down - (np.sqrt(more) - np.sqrt(squares[at])) / rate * w
            squares[at] = more
            step = np.zeros(GRADES - 1)                                                     # and by threshold
            if grade > 0:
                step[grade - 1] += pull * slope[grade]
            if grade < GRADES - 1:
                step[grade] -= pull * slope[grade + 1]
            t = np.maximum.accumulate(t - slower * threshold_rate * step)
    return Model(weights(slice(None)), rarity, t)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 sound but toxic, 2 sound; rows with a null rating are left out, of repeated ones the lowest counts."""
    return (labels.where("doc_id is not null and quality is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.when(F.col("quality") <= 0, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2).alias("grade"))
            .groupBy("doc_id").agg(F.min("grade").alias("grade")))


def training_rows(docs: DataFrame, labels: DataFrame, max_labels: int) -> DataFrame:
    """Features and grade of the rated documents, at most ``max_labels`` of them."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id")  # at most max_labels rows of 12 bytes

    def run(batches):
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "grade", "at"])

    return texts.select("doc_id", "text", "grade").mapInArrow(run, "doc_id long, grade int, at array<int>")


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Fit a model on the rated documents; without any it keeps every document."""
    rows = training_rows(docs, labels, max_labels)

    def run(_, frame):
        frame = frame.assign(order=[zlib.crc32(str(d).encode()) for d in frame["doc_id"]]).sort_values(["order", "doc_id"])
        model = fit([(np.asarray(at, np.int32), int(g)) for at, g in zip(frame["at"], frame["grade"], strict=True)])
        return pd.DataFrame({"weights": [model.weights.astype(np.float32).tobytes()], "rarity": [model.rarity.astype(np.float32).tobytes()], "thresholds": [model.thresholds.tobytes()]})

    found = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(run, "weights binary, rarity binary, thresholds binary").collect()  # one model
    if not found:
        return keep_all()
    return Model(np.frombuffer(found[0].weights, np.float32), np.frombuffer(found[0].rarity, np.float32), np.frombuffer(found[0].thresholds))


def score(docs: DataFrame, model: Model, keep_tail: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) for each row of ``docs`` (columns doc_id, text; others are ignored).

    ``tail_probability`` is that of the highest grade; a document is kept from
    ``keep_tail`` on.  Null text is scored as empty; rows with null or repeated
    doc_id are scored each; an empty table gives no rows.
    """
    parts = model.weights, model.rarity, model.thresholds

    def run(batches):
        own = Model(*parts)
        for batch in batches:
            tails = [own.tails(features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([float(t.sum()) for t in tails], pa.float64()), pa.array([float(t[-1]) for t in tails], pa.float64()),
                 pa.array([bool(t[-1] >= keep_tail) for t in tails], pa.bool_())], names=["doc_id", "expected_grade", "tail_probability", "kept"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean"))


def kept_documents(docs: DataFrame, model: Model, keep_tail: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model selects, with all their columns."""
    parts = model.weights, model.rarity, model.thresholds

    @F.pandas_udf("boolean")
    def selected(texts: pd.Series) -> pd.Series:
        own = Model(*parts)
        return texts.map(lambda t: bool(own.tails(features(t))[-1] >= keep_tail)).astype(bool)

    return docs.where(selected(F.col("text").cast("string")))
