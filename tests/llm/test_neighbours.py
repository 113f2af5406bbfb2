import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetflow.llm import neighbours
from packetflow.llm.common import read_table
from packetflow.llm.neighbours import Tree, chi_square_quantile, nearest, op1_nearest_vectors
from tests.conftest import SF_SMALL


def plain(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in queries:
        score = (x * x[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def result(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / \
        sum(map(len, want.values()))


def test_quantile():
    for p in (0.5, 0.9, 0.99):
        x = chi_square_quantile(p, 2)
        assert x == pytest.approx(-2 * math.log(1 - p))
    draws = np.square(np.random.default_rng(0).standard_normal((200_000, 8))).sum(axis=1)
    assert (draws < chi_square_quantile(0.9, 8)).mean() == pytest.approx(0.9, abs=0.005)


def test_tree_boxes_hold_their_points():
    points = np.random.default_rng(1).standard_normal((1000, 4))
    points[:200] = points[0]
    tree = Tree(points, 16)
    leaf = tree.leaf_of(points)
    assert (tree.distances(points)[np.arange(1000), leaf] == 0).all()
    others = tree.distances(points[:50])
    for q in range(50):
        true = np.square(points - points[q]).sum(axis=1)
        assert (others[q][leaf] <= true + 1e-9).all()


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, SF_SMALL, "embeddings").collect()]
    want = plain(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = result(op1_nearest_vectors(spark, SF_SMALL))
    assert got.keys() == want.keys() and recall(got, want) >= 0.9


def test_many_cells_copies_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 20)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16)) * 3
    x = centres[rng.integers(0, 12, 1500)] + rng.standard_normal((1500, 16)) * 0.3
    x[500:1000] = x[500]                      # a third are one vector
    rows = [(i, x[i].tolist()) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain(rows, range(0, 1500, 20), 20)
    got = result(nearest(spark, frame, F.col("vec_id") % 20 == 0))
    assert recall(got, want) >= 0.9
    assert [i for i, _ in got[600]] == [i for i, _ in want[600]]     # ties: the smallest ids
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and len(found) == 20


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, [], 1),   # alone in its length
            (None, [9.0, 9.0], 1), (10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (20, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int")
    got = result(nearest(spark, frame, F.col("vec_id") % 10 == 0))
    assert got == {0: [(10, 1.0), (1, 0.5), (20, 0.0)], 10: [(0, 1.0), (1, 0.5), (20, 0.0)],
                   20: [(1, 0.5), (0, 0.0), (10, 0.0)]}
    assert result(nearest(spark, frame, F.col("vec_id") == 0, k=1)) == {0: [(10, 1.0)]}
    assert nearest(spark, frame.limit(0), F.lit(True)).collect() == []
    assert nearest(spark, frame.where("vec_id = 0"), F.lit(True)).collect() == []


@pytest.mark.parametrize("length", [1e-6, 1.0, 1e6])
def test_recall_at_any_length_of_vectors(spark, monkeypatch, length):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 16)) * length
    x[7] *= 20                                # one vector far longer than the rest
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain(rows, range(0, 400, 20), 20)
    got = result(nearest(spark, frame, F.col("vec_id") % 20 == 0))
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, found in want.items() for i, s in found}
    assert all(s == exact[q, i] for q, found in got.items() for i, s in found if (q, i) in exact)


def test_lengths_are_searched_apart_and_the_least_of_repeated_ids_counts(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0]), (20, [1.0]), (5, [4.0, 0.0]), (5, [0.5, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(nearest(spark, frame, F.col("vec_id") % 20 == 0))
    assert got == {0: [(1, 2.0), (5, 0.5)], 20: [(2, 3.0)]}


def visited(x, tau, k=20):
    """Share of the cells that queries visit, by the operator's own forest."""
    sh, squared = neighbours.shell_of(x), np.square(x).sum(axis=1)
    shells = [(int(s), int((sh == s).sum()), float(squared[sh == s].max())) for s in np.unique(sh)]
    forest = neighbours.Forest(shells, x, x.shape[1])
    cell, q = forest.cell_of(x), x[::20]
    first = forest.first(q, cell[::20])
    score = np.where(first[:, cell], q @ x.T, -np.inf)
    kth = np.sort(score, axis=1)[:, -k - 1]
    return (forest.open(q, kth, chi_square_quantile(tau, neighbours.PROJECTIONS)) | first).mean()


def test_the_stop_leaves_cells_out_of_clustered_vectors_also_with_an_outlier(monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((50, 32))[rng.integers(0, 50, 4000)] + rng.standard_normal((4000, 32)) * 0.2
    share = visited(x, neighbours.TAU)
    assert share < 0.7
    x[5] *= 20
    assert visited(x, neighbours.TAU) < share + 0.05


def test_shells_hold_vectors_of_nearly_equal_length():
    lengths = np.exp(np.random.default_rng(2).uniform(-600, 600, 2000))
    shells = neighbours.shell_number(np.square(lengths))
    odd = shells == 1 << 20
    assert (odd == ~((np.square(lengths) > 0) & np.isfinite(np.square(lengths)))).all() and odd.any()
    for s in np.unique(shells[~odd]):
        assert np.ptp(np.log(lengths[shells == s])) <= math.log(1.5) / 2 + 1e-9
    assert len(set(neighbours.shell_number(np.array([1 - 1e-7, 1.0, 1 + 1e-7])))) == 1


def test_lengths_without_finite_squares_are_searched_whole(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((60, 4))
    x[20:40] *= 1e-170                       # squares vanish
    x[40:] *= 1e160                          # squares overflow
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(nearest(spark, frame, F.col("vec_id").isin(0, 20), k=5))
    assert got == plain(rows, [0, 20], 5)
