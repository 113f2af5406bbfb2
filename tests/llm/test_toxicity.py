import math
import re
import zlib

import numpy as np
import pytest

from packetflow.llm import toxicity
from packetflow.llm.common import read_table
from packetflow.llm.toxicity import Model, features, fit, fitted, learn, op4_toxicity, score, scores_of
from tests.conftest import SF_ORACLE, SF_SMALL


def test_whole_batches_equal_single_texts():
    rng = np.random.default_rng(3)
    dense = np.where(rng.random(1 << toxicity.BITS) < 0.3, 1.0, 0).astype(np.float32)
    texts = [None, "", "one", "one two", "one two one two three", "a b c d e f g " * 50]
    whole = scores_of(texts, dense, -2.0)
    for text, got in zip(texts, whole, strict=True):
        total = -2.0 + dense[features(text)].sum()
        assert got == pytest.approx(1 / (1 + np.exp(-min(total, 35))))


def plain_features(text):
    """Word and skip-pair features in whole numbers, one text at a time."""
    whole = (1 << 64) - 1
    odd = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    salt = [0x165667B19E3779F9 * (2 * kind + 1) & whole for kind in range(4)]
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    h = [zlib.crc32(w.encode()) for w in words]
    out = {((x * odd[0] & whole ^ salt[0]) * odd[1] & whole) >> 44 for x in h}
    for gap in (1, 2, 3):
        for x, y in zip(h, h[gap:]):
            out.add(((x * odd[0] + y * odd[1] & whole ^ salt[gap]) * odd[0] & whole) >> 44)
    return sorted(out)


def plain_ftrl(rows, alpha=2.0, beta=1.0, l1=5.0, l2=1.0, epochs=5):
    """FTRL-proximal over (features, label), coordinate by coordinate."""
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n[i])) / alpha + l2)

    positive = sum(y for _, y in rows)
    bias = math.log((positive + 1) / (len(rows) - positive + 1))
    for _ in range(epochs):
        for found, y in rows:
            w = {i: weight(i) for i in found}
            g = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - y
            for i in found:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * w[i]
    return {i: weight(i) for i in z if weight(i)}, bias


def test_query_equals_plain_ftrl(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").collect()}
    labels = read_table(spark, SF_SMALL, "labels")
    sample = toxicity.labelled_sample(labels, "toxic", toxicity.held_out(), toxicity.SAMPLE_ROWS)
    order = toxicity.F.xxhash64(toxicity.F.col("doc_id"), toxicity.F.lit("toxic-order"))
    rows = [(plain_features(docs[r.doc_id]), r.y) for r in
            sorted(sample.withColumn("at", order).collect(), key=lambda r: (r["at"], r.doc_id))
            if r.doc_id in docs]
    assert {r.doc_id for r in sample.collect()} == {
        r.doc_id for r in labels.collect() if r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    w, bias = plain_ftrl(rows)
    for r in op4_toxicity(spark, SF_SMALL).collect():
        total = bias + sum(w.get(i, 0.0) for i in plain_features(docs[r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


def test_learns_a_word_and_drops_the_noise():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(" ".join(rng.choice(words, 40)) + (" scum" if i % 5 == 0 else ""), int(i % 5 == 0))
            for i in range(1500)]
    w, bias = learn([(features(t), y) for t, y in rows[:1200]])
    got = scores_of([t for t, _ in rows[1200:]], w.astype(np.float32), bias) >= 0.7
    assert (got == [bool(y) for _, y in rows[1200:]]).mean() > 0.99
    assert np.count_nonzero(w) < 0.05 * len(w)


def test_held_out_rows_are_not_learned_from(spark):
    got = {r.doc_id: r for r in op4_toxicity(spark, SF_SMALL).collect()}
    for doc, row in got.items():
        assert row.held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels")
    sample = toxicity.labelled_sample(labels, "toxic", toxicity.held_out(), 10_000)
    assert not {r.doc_id for r in sample.collect()} & {d for d, r in got.items() if r.held_out}
    assert docs.count() == len(got)


def test_separates_the_learned_rows(spark):
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF_ORACLE, "labels").collect()}
    rows = [(labels[r.doc_id], r.score) for r in op4_toxicity(spark, SF_ORACLE).collect()
            if r.doc_id in labels and not r.held_out]
    toxic, clean = ([s for y, s in rows if y == k] for k in (1, 0))
    assert np.mean([t > c for t in toxic for c in clean]) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (None, "", 0.2), (2, "x " * 50_000, 0.3),
                                  (2, "x", 0.4)], "doc_id long, text string, score double")
    model = fitted(spark, SF_SMALL)
    rows = score(spark, docs, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "None"]
    assert len({r.score for r in rows if r.doc_id in (1, None)}) == 1
    assert score(spark, docs.limit(0), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, y int")
    empty = fit(spark, docs, none)
    assert isinstance(empty, Model) and {r.score for r in score(spark, docs, empty).collect()} == {0.5}
