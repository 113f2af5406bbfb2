from collections import Counter

import numpy as np
import pytest

from packetflow.llm.common import read_table
from packetflow.llm.scoring import SMOOTHING, cross_entropy_difference, losses, op5_lm_scoring
from tests.conftest import SF_SMALL


def plain(rows, target, size):
    counts = Counter(w for _, t in rows for w in (t or "").split())
    words = [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))[:size]]
    place = {w: i + 2 for i, w in enumerate(words)}
    n = len(words) + 2
    tables = np.zeros((2, n, n))
    coded = [(d, [0] + [place.get(w, 1) for w in (t or "").split()]) for d, t in rows]
    for d, ids in coded:
        for h, w in zip(ids, ids[1:], strict=False):
            tables[1, h, w] += 1
            tables[0, h, w] += d in target
    out = []
    for d, ids in coded:
        loss = []
        for c in tables:
            uni = (c.sum(axis=0) + 1) / (c.sum() + n)
            loss.append(sum(-np.log((c[h, w] + SMOOTHING * uni[w]) / (c[h].sum() + SMOOTHING))
                            for h, w in zip(ids, ids[1:], strict=False)) / max(len(ids) - 1, 1))
        out.append((d, len(ids) - 1, loss[0] - loss[1]))
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    target = {r.doc_id for r in read_table(spark, SF_SMALL, "labels").collect()
              if r.quality == 1 and r.toxic == 0}
    want = sorted(score_all(rows, target))
    got = sorted((r.doc_id, r.n_tokens, r.difference) for r in op5_lm_scoring(spark, SF_SMALL).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)


def test_probabilities_sum_to_one():
    found = losses(np.random.default_rng(0).integers(0, 9, (7, 7)).astype(float))
    assert np.exp(-found).sum(axis=1) == pytest.approx(1)


def test_odd_rows(spark):
    rows = [(1, "a b a b a b", 0), (1, "a b a b a b", 0), (2, "x y z " * 40_000, 0), (3, None, 0),
            (4, "", 0), (None, " \n", 0), (5, "a b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target int")
    target = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    got = {(str(r.doc_id), r.n_tokens): r.difference for r in
           cross_entropy_difference(spark, docs, target, size=3).collect()}
    assert got[("3", 0)] == got[("4", 0)] == got[("None", 0)] == 0
    assert got[("5", 2)] < 0 < got[("2", 120_000)]
    assert cross_entropy_difference(spark, docs.limit(0), target).collect() == []
    assert len(cross_entropy_difference(spark, docs, target.limit(0)).collect()) == 7


def test_every_word_counts(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    target = {r.doc_id for r in read_table(spark, SF_SMALL, "labels").collect()
              if r.quality == 1 and r.toxic == 0}
    counts = Counter(w for _, t in rows for w in (t or "").split())
    rare = sorted(w for w, n in counts.items() if n == 1)
    twin = next(t for d, t in rows if d in target and any(w in t.split() for w in rare))
    first = next(w for w in twin.split() if counts[w] == 1)
    rows.append((-1, twin.replace(first, "neverseen")))      # differs in one rare word only
    frame = spark.createDataFrame([*rows, (None, twin)], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    want = sorted((str(d), n, x) for d, n, x in score_all([*rows, (None, twin)], target))
    got = sorted((str(r.doc_id), r.n_tokens, r.difference)
                 for r in cross_entropy_difference(spark, frame, ids).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-5)
    found = {d: x for d, _, x in got}
    assert abs(found["-1"] - found["None"]) > 1e-6


def score_all(rows, target):
    """The formula over dictionaries, with an entry for every word."""
    coded = [(d, ["", *(t or "").split()]) for d, t in rows]
    entries = len({w for _, words in coded for w in words[1:]}) + 2
    models = []
    for chosen in ([c for c in coded if c[0] in target], coded):
        pairs = Counter(p for _, words in chosen for p in zip(words, words[1:], strict=False))
        unigram, context = Counter(), Counter()
        for (h, w), n in pairs.items():
            unigram[w] += n
            context[h] += n
        models.append((pairs, unigram, context, sum(pairs.values()) + entries))
    for d, words in coded:
        loss = [sum(-np.log((pairs[h, w] + SMOOTHING * (unigram[w] + 1) / whole) / (context[h] + SMOOTHING))
                    for h, w in zip(words, words[1:], strict=False)) / max(len(words) - 1, 1)
                for pairs, unigram, context, whole in models]
        yield d, len(words) - 1, loss[0] - loss[1]


def test_given_vocabulary_size_equals_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels").where("quality = 1 AND toxic = 0")
    target = {r.doc_id for r in labels.collect()}
    want = sorted(plain([(r.doc_id, r.text) for r in docs.collect()], target, 1022))
    got = sorted((r.doc_id, r.n_tokens, r.difference)
                 for r in cross_entropy_difference(spark, docs, labels, size=1022).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)


def test_many_target_ids_meet_the_texts_in_a_shuffle(spark, monkeypatch):
    docs = read_table(spark, SF_SMALL, "documents")
    target = read_table(spark, SF_SMALL, "labels").where("quality = 1 AND toxic = 0")
    few = sorted(map(tuple, cross_entropy_difference(spark, docs, target).collect()))
    monkeypatch.setattr("packetflow.llm.scoring.SMALL_IDS", 3)
    many = sorted(map(tuple, cross_entropy_difference(spark, docs, target).collect()))
    assert [r[:2] for r in few] == [r[:2] for r in many]
    assert [r[4] for r in few] == pytest.approx([r[4] for r in many], abs=1e-5)
