import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetflow.llm.common import read_table
from packetflow.llm.sharding import (Segments, op13_shards, plan_shards, read_shards,
                                     write_shards)
from packetflow.session import run_folder
from tests.conftest import SF_ORACLE, SF_SMALL


def plain_least(sizes, shards):
    """The smallest capacity by dynamic programming over all cuts."""
    n = len(sizes)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    best = [0] + [float("inf")] * n
    for _ in range(shards):
        new = [0] * (n + 1)
        for j in range(1, n + 1):
            new[j] = min(max(best[i], int(ends[j] - ends[i])) for i in range(j))
        best = new
    return best[n]


def groups(spark, sizes):
    rng = np.random.default_rng(len(sizes))
    keys = rng.integers(-2 ** 63, 2 ** 63 - 1, len(sizes)).tolist()
    rows = [(k, int(s), 1) for k, s in zip(keys, sizes)]
    return sorted(rows), spark.createDataFrame(rows, "key long, size long, rows long")


@pytest.mark.parametrize("bins", [4, 1 << 14])
@pytest.mark.parametrize("n, shards", [(1, 5), (7, 5), (40, 7), (90, 4)])
def test_capacity_is_the_smallest(spark, n, shards, bins):
    rng = np.random.default_rng(n)
    rows, df = groups(spark, rng.integers(17, 500, n))
    plan = plan_shards(df, shards, bins)
    sizes = [s for k, s, _ in rows if k not in plan.giants]
    left = shards - len(plan.giants)
    giants = [s for k, s, _ in rows if k in plan.giants]
    assert plan.capacity == max([plain_least(sizes, left), *giants])
    got = defaultdict(int)
    shard_of = dict(df.select("key", plan.shard(F.col("key"))).collect())
    for k, s, _ in rows:
        got[shard_of[k]] += s
    assert [got[i] for i in range(shards)] == [size for size, _ in plan.loads]
    assert max(got.values()) <= plan.capacity
    order = [shard_of[k] for k, _, _ in rows if k not in plan.giants]
    assert order == sorted(order)


@pytest.mark.parametrize("bins", [2, 64])
def test_many_groups_in_few_segments(spark, bins):
    rows, df = groups(spark, np.random.default_rng(3).zipf(1.5, 20_000).clip(1, 3000) + 16)
    plan, exact = plan_shards(df, 40, bins), Segments(*zip(*[(k, k, s, n, 1) for k, s, n in rows]))
    assert not plan.giants
    assert plan.capacity == exact.least(40, False)
    assert [size for size, _ in plan.loads] == np.diff(
        exact.fill(plan.capacity, 40, False), prepend=0).tolist()


def test_a_group_above_the_mean_stands_alone(spark):
    rows, df = groups(spark, [5000] + [17] * 300)
    plan = plan_shards(df, 10, 4)
    assert plan.loads[0] == (5000, 1) and len(plan.giants) == 1
    assert max(s for s, _ in plan.loads[1:]) - min(s for s, _ in plan.loads[1:]) <= 10 * 17


def check(rows, docs):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == sorted(
        (str(d.doc_id), len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode()))
        for d in docs)
    slots, by_crc = defaultdict(list), defaultdict(set)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
        by_crc[r.text_crc32, r["size"]].add(r.shard)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    assert all(len(s) == 1 for s in by_crc.values())


def test_query_places_every_document_once(spark):
    check(op13_shards(spark, SF_SMALL).collect(), read_table(spark, SF_SMALL, "documents").collect())


def test_shards_are_nearly_equal(spark):
    rows = op13_shards(spark, SF_ORACLE).collect()
    check(rows, read_table(spark, SF_ORACLE, "documents").collect())
    sums, by_text = defaultdict(int), defaultdict(int)
    for r in rows:
        sums[r.shard] += r["size"]
        by_text[r.text_crc32] += r["size"]
    mean = sum(sums.values()) / 40
    assert max(sums.values()) <= mean + max(by_text.values())


def test_copies_nulls_and_clashing_names(spark):
    rows = ([(1, "same", "a", 1)] * 400 + [(i, "same", None, i) for i in range(300)]
            + [(None, None, "b", 2), (7, "", "c", 3), (8, "long " * 9000, None, None)]
            + [(i, f"text {i}", "d", i) for i in range(500)])
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, key int")
    docs = docs.withColumn("tags", F.create_map(F.lit("a"), F.col("key")))
    folder = run_folder(spark, "test-shards")
    plan = write_shards(spark, docs, folder, shards=10)
    got = read_shards(spark, folder, docs).collect()
    assert sorted(map(str, (r.document for r in got))) == sorted(map(str, docs.collect()))
    assert len({r.shard for r in got if r.document.text == "same"}) == 1
    assert len({r.shard for r in got if not r.document.text}) == 1
    assert [n for _, n in plan.loads] == [sum(r.shard == i for r in got) for i in range(10)]


def test_empty_table(spark):
    docs = read_table(spark, SF_SMALL, "documents").limit(0)
    folder = run_folder(spark, "test-shards")
    plan = write_shards(spark, docs, folder)
    assert plan.loads == [(0, 0)] * 40
    assert read_shards(spark, folder, docs).collect() == []
