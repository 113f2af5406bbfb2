import zlib

import numpy as np
import pytest

from packetflow.llm import quality
from packetflow.llm.common import read_table
from packetflow.llm.quality import fit, gradients, initial, op7_quality, probabilities, score, train
from tests.conftest import SF_ORACLE


def test_gradients_are_the_slopes_of_the_loss():
    texts, y = ["Some words, and more of them. " * 60, "!!%% " * 7, "", "é" * 900], np.array([1, 0, 1, 0.])
    w = {k: v.astype(np.float64) for k, v in initial().items()}
    loss = lambda w: -np.mean(y * np.log(p := probabilities(texts, w)) + (1 - y) * np.log(1 - p))
    found = gradients(texts, y, w)
    rng = np.random.default_rng(0)
    for k in w:
        for _ in range(4):
            at = np.unravel_index(np.abs(found[k]).argmax() if rng.random() < 0.5
                                  else rng.integers(found[k].size), found[k].shape)
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][at] += 1e-4
            down[k][at] -= 1e-4
            assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(found[k][at], abs=2e-3)


def plain_probability(text, w):
    """The network over one text, filter by filter and place by place."""
    raw = (text or "").encode()
    values = []                                    # of each chunk: every filter's largest output
    for start in range(0, max(len(raw), 1), 512):
        chunk = raw[start:start + 516].ljust(516, b"\0")
        best = [0.0] * 16
        for at in range(0, 512, 4):
            seen = [float(v) for b in chunk[at:at + 8] for v in w["embed"][b]]
            for f in range(16):
                out = float(w["bias"][f])
                out += sum(x * float(k) for x, k in zip(seen[:32], w["first"][:, f], strict=True))
                out += sum(x * float(k) for x, k in zip(seen[32:], w["second"][:, f], strict=True))
                best[f] = max(best[f], out)
        values.append(best)
    by_filter = list(zip(*values, strict=True))
    found = [sum(v) / len(v) for v in by_filter] + [max(v) for v in by_filter] + [min(v) for v in by_filter]
    hidden = [max(sum(x * float(k) for x, k in zip(found, w["dense"][:, i], strict=True))
                  + float(w["dense_bias"][i]), 0.0) for i in range(16)]
    logit = sum(h * float(k) for h, k in zip(hidden, w["out"], strict=True)) + float(w["out_bias"][0])
    return 1 / (1 + np.exp(-logit))


def test_forward_pass_equals_plain_loops():
    rng = np.random.default_rng(9)
    w = {k: v + rng.normal(0, 0.1, v.shape).astype(np.float32) for k, v in initial().items()}
    texts = [None, "", "short", "x" * 512, "y" * 513, "Plain words of prose, some é and ñ. " * 40, "#!% " * 300]
    assert probabilities(texts, w) == pytest.approx([plain_probability(t, w) for t in texts], abs=1e-5)


def test_whole_texts_count():
    w = train(["fine words here. " * 9, "##!!##!! " * 9] * 40, [1, 0] * 40)
    good, bad, late = probabilities(["calm words flow. " * 20, "##!!##!! " * 20,
                                     "calm words flow. " * 4000 + "##!!##!! " * 4000], w)
    assert good > 0.7 and bad < 0.3 and late < good


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_ORACLE, "labels").collect()}
    rows = op7_quality(spark, SF_ORACLE).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([y == p for y, p in judged]) >= 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "", 0.1), (2, "x" * 400_000, 0.2), (2, "x", 0.3)],
                                 "doc_id long, text string, score double")
    rows = score(spark, docs, initial()).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "None"]
    assert len({r.score for r in rows if r.doc_id in (1, None)}) == 1
    assert score(spark, docs.limit(0), initial()).collect() == []
    none = fit(spark, docs, spark.createDataFrame([], "doc_id long, y int"))
    assert {r.score for r in score(spark, docs, none).collect()} == {0.5}
    assert quality.CHUNK % quality.STRIDE == 0
