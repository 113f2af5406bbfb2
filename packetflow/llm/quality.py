"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of 516 bytes that overlap by 4, so
that learned filters (8 bytes wide, every 4 bytes) cover the whole document.
Each chunk is max-pooled; the mean, largest and smallest pooled value of every
filter over all chunks go through a small dense layer to one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import (crc32_of_id, documents_input, labelled_sample, labelled_texts,
                                   pieces, read_table, ship_package)

SAMPLE_ROWS = 5_000        # labelled rows learned from, at most (by one task)
EMBED, FILTERS, HIDDEN = 8, 16, 16
STRIDE, CHUNK = 4, 512     # the filters span two strides; a chunk adds one to its 512 bytes
STEPS, BATCH, RATE = 1_250, 32, 0.004
BLOCK_CHUNKS = 256         # chunks convolved at a time
THRESHOLD = 0.3
SEED = 11

Weights = dict[str, np.ndarray]


def chunks_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All chunks (rows of 516 bytes, zero-padded), and each text's first; an empty text has one."""
    rows, first = [], [0]
    for text in texts:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        n = max(-(-len(raw) // CHUNK), 1)
        padded = np.zeros(n * CHUNK + STRIDE, np.uint8)
        padded[:len(raw)] = raw
        rows.append(np.lib.stride_tricks.as_strided(padded, (n, CHUNK + STRIDE), (CHUNK, 1)))
        first.append(first[-1] + n)
    return np.concatenate(rows), np.array(first)


def initial() -> Weights:
    rng = np.random.default_rng(SEED)
    half = STRIDE * EMBED
    return {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "first": rng.normal(0, half ** -0.5, (half, FILTERS)).astype(np.float32),
            "second": rng.normal(0, half ** -0.5, (half, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "dense": rng.normal(0, (3 * FILTERS) ** -0.5, (3 * FILTERS, HIDDEN)).astype(np.float32),
            "dense_bias": np.zeros(HIDDEN, np.float32),
            "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32)}


def _convolved(chunks: np.ndarray, w: Weights) -> np.ndarray:
    """Filter outputs at every stride of each chunk."""
    steps = w["embed"][chunks].reshape(len(chunks), -1, STRIDE * EMBED)
    return steps[:, :-1] @ w["first"] + steps[:, 1:] @ w["second"] + w["bias"]


def pooled(chunks: np.ndarray, w: Weights) -> np.ndarray:
    """Max-pooled, rectified filter outputs of each chunk."""
    parts = [_convolved(chunks[i:i + BLOCK_CHUNKS], w).max(axis=1)
             for i in range(0, len(chunks), BLOCK_CHUNKS)]
    return np.maximum(np.concatenate(parts), 0)


def _combined(chunk: np.ndarray, first: np.ndarray) -> np.ndarray:
    at, n = first[:-1], np.diff(first)[:, None]
    return np.concatenate((np.add.reduceat(chunk, at) / n, np.maximum.reduceat(chunk, at),
                           np.minimum.reduceat(chunk, at)), axis=1).astype(chunk.dtype)


def probabilities(texts: list[str | None], w: Weights) -> np.ndarray:
    chunks, first = chunks_of(texts)
    found = _combined(pooled(chunks, w), first)
    hidden = np.maximum(found @ w["dense"] + w["dense_bias"], 0)
    logit = (hidden @ w["out"] + w["out_bias"][0]).astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def gradients(texts: list[str | None], y: np.ndarray, w: Weights) -> Weights:
    """Of the mean log loss; the maxima pass it to where they were reached."""
    chunks, first = chunks_of(texts)
    best, at = [], []
    for i in range(0, len(chunks), BLOCK_CHUNKS):
        z = _convolved(chunks[i:i + BLOCK_CHUNKS], w)
        at.append(z.argmax(axis=1))
        best.append(np.take_along_axis(z, at[-1][:, None], 1)[:, 0])
    raw, at = np.concatenate(best), np.concatenate(at)
    chunk = np.maximum(raw, 0)
    found = _combined(chunk, first)
    before = found @ w["dense"] + w["dense_bias"]
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"][0], -35, 35)))
    error = ((p - y) / len(y)).astype(np.float32)
    g = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
    back = error[:, None] * w["out"] * (before > 0)
    g["dense"], g["dense_bias"] = found.T @ back, back.sum(axis=0)
    mean, high, low = np.split(back @ w["dense"].T, 3, axis=1)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    flow = (mean / n[:, None])[owner]
    for part, value in ((high, found[:, FILTERS:2 * FILTERS]), (low, found[:, 2 * FILTERS:])):
        reached = (chunk == value[owner]).astype(np.float32)
        flow += part[owner] * reached / np.add.reduceat(reached, first[:-1])[owner]
    flow = (flow * (raw > 0)).astype(np.float32)
    # Each filter's maximum of each chunk came from the bytes of two strides.
    where = (at * STRIDE)[:, :, None] + np.arange(2 * STRIDE)
    patch = chunks[np.arange(len(chunks))[:, None, None], where]
    seen = w["embed"][patch].reshape(len(chunks), FILTERS, -1)
    taps = np.einsum("cf,cfk->kf", flow, seen, optimize=True)
    g["first"], g["second"] = np.split(taps, 2)
    g["bias"] = flow.sum(axis=0)
    both = np.concatenate((w["first"], w["second"])).T.reshape(FILTERS, 2 * STRIDE, EMBED)
    into = flow[:, :, None, None] * both
    flat = patch.reshape(-1).astype(np.int64)
    g["embed"] = np.stack([np.bincount(flat, into[..., k].reshape(-1), 256)
                           for k in range(EMBED)], axis=1)
    return g


def train(texts: list[str | None], labels: list[int]) -> Weights:
    """Adam for `STEPS` batches, in an order that depends on the seed alone."""
    w, y = initial(), np.asarray(labels, np.float32)
    if not len(y):
        return w | {"out": np.zeros(HIDDEN, np.float32)}
    rng = np.random.default_rng(SEED)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    step, order = 0, np.zeros(0, np.int64)
    while step < STEPS:
        if not len(order):
            order = rng.permutation(len(y))
        chosen, order = order[:BATCH], order[BATCH:]
        step += 1
        rate = RATE * (1 - step / (STEPS + 1))
        for k, g in gradients([texts[i] for i in chosen], y[chosen], w).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** step))
                    / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return w


def _train_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "doc_id", "text"])
    w = train(rows["text"].tolist(), rows["y"].tolist())
    return pd.DataFrame({"name": list(w), "value": [w[k].reshape(-1).tolist() for k in w]})


def fit(spark: SparkSession, docs: DataFrame, sample: DataFrame) -> Weights:
    """Learn from the texts of `sample` (doc_id, y), at most SAMPLE_ROWS ids, in one task.

    An id that repeats gives one text and one label (the least of each). Without a labelled row every score is 0.5.
    """
    ship_package(spark)
    rows = labelled_texts(docs, sample).select(
        "doc_id", "text", "y", F.xxhash64(F.col("doc_id"), F.lit("quality-order")).alias("order"),
        F.lit(0).alias("learner"))
    learned = rows.groupBy("learner").applyInPandas(_train_rows, "name string, value array<float>")
    shapes = {k: v.shape for k, v in initial().items()}
    found = {r.name: np.array(r.value, np.float32).reshape(shapes[r.name]) for r in learned.collect()}
    return found or train([], [])


def score(spark: SparkSession, docs: DataFrame, weights: Weights, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null texts count as empty ones, which are one chunk of zeros.

    Each row is scored by itself: repeated rows get equal scores, null ids stay,
    an empty table gives no rows, and columns besides id and text are left
    behind, whatever their names. A text is scored whole, some chunks at a
    time; a task holds one number a filter for each chunk of 64 texts.
    """
    ship_package(spark)
    sent = spark.sparkContext.broadcast(weights)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            if batch.num_rows:
                found = probabilities(batch.column("text").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)],
                                                 schema=schema)

    return documents_input(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def held_out():
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return crc32_of_id() % 5 == 0


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels are learned from rows not held out only."""
    docs = read_table(spark, sf_dir, "documents")
    sample = labelled_sample(read_table(spark, sf_dir, "labels"), "quality", held_out(), SAMPLE_ROWS)
    weights = fit(spark, documents_input(docs, "doc_id", "text"), sample)
    return score(spark, docs, weights).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
