"""Text quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A word is what stands between white space. Its features are the word, its core (without punctuation at its ends, in lower case), the
punctuation and case pattern around the core, and the pair of such patterns with the word before; pairs of neighbouring words, and that a word follows itself. All are hashed to
2^BITS indices. A text's vector holds 1 + log(count) for each index, scaled to length 1. Learning is per coordinate: the weight of
an index follows from its sum of gradients and of squared gradients, with an L1 term that keeps rare indices at zero. A text's score is
the logistic function of a sparse dot product.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import fold, keep_rows, map_texts, prepare, share, table, text_of

BITS = 18
#: The classifier learns from about so many labelled documents (all, where there are fewer).
SAMPLE_DOCS = 6_000
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.02, 0.1, 8
#: Texts that score at least this are good.
THRESHOLD = 0.7
MEMO_ENTRIES = 300_000
MASK = (1 << BITS) - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed(kind: str, text: str) -> int:
    return zlib.crc32(f"{kind}{text}".encode()) & MASK


AGAIN = hashed("r", "")


class Features:
    """Indices and values of a text's vector; hashes of words are kept in a memo."""

    def __init__(self):
        self.memo: dict[str, tuple[int, int, int]] = {}

    def of_word(self, word: str) -> tuple[int, int, int]:
        core = word.strip(string.punctuation)
        case = "-" if not core else "u" if core.isupper() and len(core) > 1 else "t" if core[0].isupper() else "l" if core.islower() else "m"
        begin = word.find(core) if core else 0
        pattern = f"{word[:begin][:8]}\0{case}\0{word[begin + len(core) :][:8]}" if core else word[:16]
        return hashed("w", word), hashed("c", core.lower()), hashed("p", pattern)

    def of_text(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        try:
            rows = list(map(memo.__getitem__, words))
        except KeyError:
            for word in set(words):
                if word not in memo:
                    memo[word] = self.of_word(word)
            rows = list(map(memo.__getitem__, words))
        own = np.array(rows, np.uint64)
        # Bigrams of words and of patterns.
        pairs = ((own[:-1] * MIX + own[1:] + np.array([1, 2, 3], np.uint64)) * MIX >> np.uint64(64 - BITS))[:, [0, 2]]
        again = np.full(int((own[:-1, 1] == own[1:, 1]).sum()), AGAIN, np.uint64)  # a word right after itself
        index, count = np.unique(np.concatenate([own.ravel(), pairs.ravel(), again]), return_counts=True)
        value = 1 + np.log(count)
        return index.astype(np.int64), value / np.sqrt(value @ value)


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


class Leader:
    """Follow-the-regularised-leader, proximal form, for logistic loss."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        size = (1 << BITS) + 1  # the last index is the constant term
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        g = (logistic(w @ value) - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g


class Model:
    def __init__(self, weights: np.ndarray):
        self.weights, self.constant, self.features = weights[:-1], weights[-1], Features()

    def score(self, text: str) -> float:
        index, value = self.features.of_text(text)
        return logistic(self.weights[index] @ value + self.constant)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the texts of ``docs`` that have a label of 0 or 1 in ``labels``.

    The sample is by hash of the id; updates go through it in the order of that hash, so the same rows give the same model. With no labelled row every
    score is 0.5. A text's vector has at most 2^BITS entries, so the sample is bounded whatever the texts' length.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    n = known.count()
    if n == 0:
        return Model(np.zeros((1 << BITS) + 1))
    order = F.xxhash64("id")
    drawn = known.where(F.pmod(order, F.lit(1_000_000)) < 1_000_000 * min(1.0, sample_docs / n))
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col)).join(F.broadcast(drawn), "id")  # bounded by sample_docs

    def make():
        features = Features()

        def step(batch: pa.RecordBatch) -> dict:
            found = [features.of_text(text) for text in batch.column("text").to_pylist()]
            return {
                "draw": batch.column("draw"),
                "label": batch.column("label"),
                "index": pa.array([i for i, _ in found], pa.list_(pa.int32())),
                "value": pa.array([v for _, v in found], pa.list_(pa.float32())),
            }

        return step

    columns = [order.alias("draw"), F.col("label"), F.col("text")]
    leader = Leader()
    sample = map_texts(rows, columns, "draw long, label int, index array<int>, value array<float>", make).toArrow()
    keys = sample.select(["draw", "label"]).append_column("at", pa.array(np.arange(len(sample))))
    turns = keys.sort_by([("draw", "ascending"), ("label", "ascending"), ("at", "ascending")])
    index, value, labels = sample["index"], sample["value"], turns["label"].to_pylist()
    for _ in range(EPOCHS):
        for at, label in zip(turns["at"].to_pylist(), labels, strict=True):
            # The constant term comes last. Vectors are widened one at a time: the sample is in memory once, as it came.
            leader.update(np.append(np.asarray(index[at].values, np.int64), 1 << BITS), np.append(np.asarray(value[at].values, float), 1.0), label)
    del sample, index, value
    pa.default_memory_pool().release_unused()
    return Model(leader.weights(slice(None)))


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if the score reaches the threshold) for each row.

    A null or empty text is scored by the constant term. Rows are independent of each other; other columns are not read.
    """

    def make(model: Model):
        def step(batch: pa.RecordBatch) -> dict:
            scores = [model.score(text) for text in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "score": scores, "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32())}

        return step

    columns = [docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col)]
    return map_texts(docs, columns, "doc_id long, score double, predicted int", make, share(docs.sparkSession, model))


def good_texts(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least the threshold, with all their columns."""

    def make(model: Model):
        return lambda texts: [model.score(text) >= threshold for text in texts]

    return keep_rows(docs, text_col, make, share(docs.sparkSession, model))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.where(fold(F.col("doc_id"), 4) != 2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = train(docs, training_labels(table(spark, sf_dir, "labels")))
    return score_texts(docs, model).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
