"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import (crc32_of_id, documents_input, labelled_sample, labelled_texts,
                                   pieces, read_table, ship_package)

SAMPLE_ROWS = 16_000       # labelled rows learned from, at most (by one task)
BITS = 20                  # of the feature space: bounds the model at 2**20 weights
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 1.0
THRESHOLD = 0.7

_SEPARATORS = re.compile(rb"[^0-9a-z\x80-\xff]+")
# One odd multiplier for each place in a gram, and one salt for each kind of gram.
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_SALT = {kind: np.uint64(0x165667B19E3779F9 * (2 * kind + 1) % 2 ** 64) for kind in range(4)}


def word_hashes(text: str | None) -> np.ndarray:
    """crc32 of each lower-cased word (runs of letters and digits)."""
    words = _SEPARATORS.sub(b" ", (text or "").lower().encode("utf-8", "surrogatepass")).split()
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def grams(hashes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, owner) of the words, the pairs, and the pairs that skip one or two words."""
    shift = np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        yield ((hashes * _ODD[0] ^ _SALT[0]) * _ODD[1]) >> shift, owner
        for gap in (1, 2, 3):
            same = owner[gap:] == owner[:-gap]
            pair = (hashes[:-gap] * _ODD[0] + hashes[gap:] * _ODD[1] ^ _SALT[gap]) * _ODD[0]
            yield (pair >> shift)[same], owner[gap:][same]


def features(text: str | None) -> np.ndarray:
    """The distinct features of a text."""
    hashes = word_hashes(text)
    found = [f for f, _ in grams(hashes, np.zeros(len(hashes), np.int8))]
    return np.unique(np.concatenate(found).astype(np.int32))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step: zero within L1, a rate of its own for each coordinate beyond."""
    return np.where(np.abs(z) <= L1, 0.0,
                    (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and intercept after `EPOCHS` passes over (features, label), in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    positive = sum(y for _, y in rows)
    bias = float(np.log((positive + 1) / (len(rows) - positive + 1)))
    for _ in range(EPOCHS):
        for found, y in rows:
            zs, ns = z[found], n[found]
            w = _weights(zs, ns)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[found] = zs + g - sigma * w
            n[found] = ns + g * g
    return _weights(z, n), bias


def _learn_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "doc_id", "text"])
    w, bias = learn([(features(t), int(y)) for t, y in zip(rows["text"], rows["y"], strict=True)])
    at = np.flatnonzero(w)
    return pd.DataFrame({"feature": np.append(at, -1), "weight": np.append(w[at], bias)})


class Model:
    """Sparse weights (sorted features) and an intercept; at most 2**BITS of them."""

    def __init__(self, features_: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features_, weights, bias

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float32)
        w[self.features] = self.weights
        return w


def fit(spark: SparkSession, docs: DataFrame, sample: DataFrame) -> Model:
    """Learn from the texts of `sample` (doc_id, y), a frame of at most SAMPLE_ROWS ids.

    The sample is learned from in one task, in the order of a hash of the id;
    its size is bounded, as an id that repeats gives one text and one label
    (the least of each). Labelled ids without a document, and documents without
    a label, play no part; with no labelled row at all the model is empty and
    every score is 0.5.
    """
    ship_package(spark)
    order = F.xxhash64(F.col("doc_id"), F.lit("toxic-order"))
    rows = labelled_texts(docs, sample).select(
        "doc_id", "text", "y", order.alias("order"), F.lit(0).alias("learner"))
    model = rows.groupBy("learner").applyInPandas(
        _learn_rows, "feature long, weight double").toPandas()
    bias = model[model["feature"] < 0]
    model = model[model["feature"] >= 0].sort_values("feature")
    return Model(model["feature"].to_numpy(), model["weight"].to_numpy(),
                 float(bias["weight"].iloc[0]) if len(bias) else 0.0)


def scores_of(texts: list[str | None], dense: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each whole text; a feature counts once, however often it occurs."""
    hashes = [word_hashes(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
    total = np.full(len(texts), bias)
    flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    keys = []
    for found, of in grams(flat, owner):
        at = np.flatnonzero(dense[found])
        keys.append((of[at].astype(np.int64) << BITS) | found[at].astype(np.int64))
    key = np.unique(np.concatenate(keys))      # also where grams of different kinds share a feature
    np.add.at(total, key >> BITS, dense[key & ((1 << BITS) - 1)])
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(spark: SparkSession, docs: DataFrame, model: Model, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the intercept's score.

    Each row is scored by itself: repeated rows get equal scores, null ids stay,
    an empty table gives no rows, and columns besides id and text are left
    behind, whatever their names. A text is scored whole; a task holds some
    forty bytes for each word of 256 texts.
    """
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = sent.value.dense()
        for batch in pieces(batches, 256):
            found = scores_of(batch.column("text").to_pylist(), dense, sent.value.bias)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)],
                                             schema=schema)

    return documents_input(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def drop_toxic(spark: SparkSession, docs: DataFrame, model: Model, *, text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below the threshold; nothing is shuffled."""
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = sent.value.dense()
        for batch in pieces(batches, 256):
            found = scores_of(batch.column(text_col).to_pylist(), dense, sent.value.bias)
            yield batch.filter(pa.array(found < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out():
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return crc32_of_id() % 3 == 1


def fitted(spark: SparkSession, sf_dir: str) -> Model:
    """The model learned from the labelled rows of the tables in `sf_dir`."""
    sample = labelled_sample(read_table(spark, sf_dir, "labels"), "toxic", held_out(), SAMPLE_ROWS)
    docs = documents_input(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return fit(spark, docs, sample)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels are learned from rows not held out only."""
    found = score(spark, read_table(spark, sf_dir, "documents"), fitted(spark, sf_dir))
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
