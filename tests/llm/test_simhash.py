import numpy as np
import pytest
import xxhash

from packetflow.llm.common import documents_input, read_table
from packetflow.llm.simhash import (block_anchors, cell_links, fingerprint, near_duplicates,
                                    op8_simhash_near_dedup)
from tests.conftest import SF_SMALL


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    label = dict(enumerate(range(len(rows))))
    changed = True
    while changed:
        changed = False
        for i, (_, x) in enumerate(rows):
            for j, (_, y) in enumerate(rows):
                if (x ^ y).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[label[i]] = min(least.get(label[i], doc), doc)
    return sorted((doc, f"{fp:016x}", least[label[i]]) for i, (doc, fp) in enumerate(rows))


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    want = plain_components([(d, plain_fingerprint(t)) for d, t in docs])
    got = op8_simhash_near_dedup(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_every_point_meets_its_neighbours_at_an_anchor():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 31, 200)
    near = points ^ (1 << rng.integers(0, 31, 200))
    for a, b in ((points, points), (points, near)):
        (rows, x), (others, y) = block_anchors(a), block_anchors(b)
        for i in range(200):
            assert set(x[rows == i]) & set(y[others == i])
    rows, _ = block_anchors(points)
    assert set(np.bincount(rows)) <= {1, 16}


def test_cell_links_follow_chains():
    fps = np.array([0, 0b111, 0b111111, 0b111111111, -1], np.int64)
    moved, least = cell_links(fps, 3)
    assert sorted(zip(moved.tolist(), least.tolist())) == [(0b111, 0), (0b111111, 0),
                                                           (0b111111111, 0)]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a a a a a a", "É x\x1cy é",
                                  "word " * 30_000])
def test_fingerprint_of_odd_texts(text):
    assert fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, "a b c d", 7), (1, "a b c d", 8), (2, None, 1), (3, "", 1), (None, "a b c d", 2),
            (9, "a B c d", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = [(r.doc_id, r.component_id) for r in near_duplicates(spark, docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (2, 2), (3, 2), (None, 1), (9, 1)],
                                          key=str)
    assert near_duplicates(spark, docs.limit(0)).collect() == []


def test_large_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr("packetflow.llm.simhash.CELL_SPLIT", 2)
    test_query_equals_brute_force(spark)


def test_input_ignores_other_columns(spark):
    docs = spark.createDataFrame([(1, "x", "y")], "doc_id int, text string, cell string")
    assert documents_input(docs, "doc_id", "text").columns == ["doc_id", "text"]
