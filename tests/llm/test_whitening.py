import math

import numpy as np
import pytest

from packetflow.llm.common import read_table
from packetflow.llm.whitening import op11_whitening, whiten
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>"


def plain(vectors):
    """From exact whole numbers: eigenvalues, vectors, n and sums of the distinct vectors."""
    fit = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[(n * x - s) / n for x, s in zip(row, sums)] for row in fit]
    cov = np.array(centred).T @ np.array(centred) / n
    values, directions = np.linalg.eigh(cov)
    return n, sums, values[::-1], directions[:, ::-1], cov


def check(rows, vectors, apart=1e-6):
    """`rows` of the operator against `vectors`, in the order of their ids."""
    n, sums, values, directions, cov = plain(vectors)
    shown = min(16, len(sums))
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(vectors) * shown
    white = np.zeros((len(vectors), shown))
    for i, v in enumerate(vectors):
        x = [math.floor(64 * c) + 1_000_000 for c in v]
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(1, shown + 1):
            r = by_id[i][k]
            assert (r.n, r.deviation) == (n, dev)
            assert r.explained == pytest.approx(values[k - 1] / np.trace(cov), rel=apart)
            assert r.identity_error < 1e-6
            white[i, k - 1] = r.whitened
    centred = np.array([[(n * (math.floor(64 * c) + 1_000_000) - s) / n for c, s in zip(v, sums)]
                        for v in vectors])
    want = centred @ directions[:, :shown] / np.sqrt(values[:shown])
    signs = np.sign((want * white).sum(axis=0))
    assert np.abs(white * signs - want).max() < 1e-3 * max(np.abs(want).max(), 1)


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], SCHEMA)


def test_query_equals_plain_covariance(spark):
    rows = [r for r in read_table(spark, SF_SMALL, "embeddings").collect()
            if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    ids = {r.vec_id: i for i, r in enumerate(rows)}
    assert len(ids) == len(rows)
    got = [type("R", (), r.asDict() | {"vec_id": ids[r.vec_id]})
           for r in op11_whitening(spark, SF_SMALL).collect()]
    check(got, [r.embedding for r in rows])


def test_ill_conditioned_vectors_are_whitened(spark):
    # Singular values over ten powers of ten: the covariance alone, in doubles, has lost the last.
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 5)) * [1e9, 1e5, 1e3, 30.0, 0.3]
    mixed = base @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    rows = whiten(spark, frame(spark, mixed)).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4, 5}
    assert all(r.identity_error < 1e-4 for r in rows)
    white = np.zeros((600, 5))
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(white.T @ white / 600 - np.eye(5)).max() < 1e-4
    assert sum(r.explained for r in rows if r.vec_id == 0) == pytest.approx(1)


def test_dimensions_without_variance_and_dependent_ones(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-500, 500, (200, 4)) / 64
    vectors = np.column_stack([a, np.full(200, 3.0), a[:, 0], a[:, 1] + a[:, 2]])
    rows = whiten(spark, frame(spark, vectors)).collect()
    first = sorted((r for r in rows if r.vec_id == 0), key=lambda r: r.component)
    assert [r.whitened is None for r in first] == [False] * 4 + [True] * 3
    assert [r.explained for r in first[4:]] == [0.0] * 3
    assert sum(r.explained for r in first) == pytest.approx(1)
    assert first[0].identity_error < 1e-9


def test_copies_count_once_and_bad_rows_not_at_all(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i % 5), float(i * i % 11)]) for i in range(60)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [1.0, -inf, 0.0])]
    repeated = [(3, good[3][1])] * 50 + [(None, good[4][1])]
    docs = spark.createDataFrame(good + bad + repeated, SCHEMA).selectExpr("*", "1 AS x", "'a' AS n")
    rows = whiten(spark, docs).collect()
    assert {r.vec_id for r in rows} == set(range(60)) | {None}
    assert len([r for r in rows if r.vec_id == 3]) == 51 * 3
    only = [r for r in rows if r.vec_id is not None]
    one = {(r.vec_id, r.component): r for r in only}
    check(list(one.values()), [v for _, v in good])
    none = {r.component: r.whitened for r in rows if r.vec_id is None}
    assert none == {k: one[4, k].whitened for k in (1, 2, 3)}


def test_lengths_are_fitted_apart_and_edges(spark):
    rows = [(i, [float(i), float(i * i % 13)]) for i in range(20)]
    rows += [(100 + i, [float(i)]) for i in range(5)] + [(200, []), (201, []), (300, [1.0] * 3)]
    got = whiten(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n, r.component) for r in got if r.vec_id < 20} == {(20, 1), (20, 2)}
    assert {(r.n, r.component, round(r.explained, 12)) for r in got if 100 <= r.vec_id < 105} == {(5, 1, 1.0)}
    assert not [r for r in got if r.vec_id in (200, 201)]
    alone = [r for r in got if r.vec_id == 300]
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == \
        [(1, 0, None, None, None)] * 3
    assert whiten(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_entries(spark):
    got = whiten(spark, frame(spark, [[1e300, 1.0], [-1e300, 2.0], [0.0, 5.0]])).collect()
    assert len(got) == 6 and {r.deviation for r in got if r.vec_id == 0} == {None}
    wide = whiten(spark, frame(spark, [[2.0 ** 31, 1.0], [-2.0 ** 31, 2.0], [0.0, 4.0]])).collect()
    assert all(r.deviation is None for r in wide if r.vec_id == 0)      # 3 * 2^37, squared
    some = whiten(spark, frame(spark, [[2.0 ** 20, 1.0], [-2.0 ** 20, 2.0], [0.0, 4.0]])).collect()
    assert [r.deviation for r in some if r.vec_id == 0][0] == (3 * 2 ** 26) ** 2 + (3 * 64 - 7 * 64) ** 2
