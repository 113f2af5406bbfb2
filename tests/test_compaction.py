"""Merging the batch folders of a file table while it is read and replayed."""

import glob

import pytest
from pyspark.sql import functions as F

from packetflow.sinks import compaction as C
from packetflow.sinks.batch import TableTarget


def rows_of(target, spark):
    return sorted((r.k, r.v) for r in target.read(spark).collect())


def batch(spark, i, note=""):
    return spark.range(i * 10, i * 10 + 10).select(F.col("id").alias("k"), F.lit(f"b{i}{note}").alias("v")) \
        .coalesce(1)


def wanted(n, notes=()):
    return sorted((k, f"b{k // 10}{dict(notes).get(k // 10, '')}") for k in range(n * 10))


def data_files(folder):
    return [f for f in glob.glob(f"{folder.removeprefix('file:')}/**/part-*.parquet", recursive=True)]


def test_many_batches_become_few_files_and_the_last_can_be_replayed(spark, folder):
    target = TableTarget(f"{folder}/t")
    n = 100
    for i in range(n):
        target.write(batch(spark, i), i, "r")
    assert len(data_files(folder)) == n
    during = target.read(spark)                       # has listed the folders before the merge
    assert C.merge_batches(spark, target.path, "r") == n - 2
    assert rows_of(target, spark) == wanted(n)
    assert sorted((r.k, r.v) for r in during.collect()) == wanted(n)
    target.write(batch(spark, n - 1, "!"), n - 1, "r")
    target.write(batch(spark, n - 2, "?"), n - 2, "r")
    assert rows_of(target, spark) == wanted(n, {n - 1: "!", n - 2: "?"}.items())
    with pytest.raises(ValueError):
        target.write(batch(spark, 5), 5, "r")
    assert C.merge_batches(spark, target.path, "r") == 0       # only clears away
    assert len(data_files(folder)) == 3
    assert rows_of(target, spark) == wanted(n, {n - 1: "!", n - 2: "?"}.items())


def test_a_reader_sees_each_row_once_at_every_step(spark, folder, monkeypatch):
    target = TableTarget(f"{folder}/t")
    for i in range(6):
        target.write(batch(spark, i), i, "r")
    seen = []
    for name in ("_commit", "_remove", "_size"):
        step = getattr(C, name)

        def watched(*args, step=step):
            seen.append(rows_of(target, spark))
            out = step(*args)
            seen.append(rows_of(target, spark))
            return out

        monkeypatch.setattr(C, name, watched)
    C.merge_batches(spark, target.path, "r")
    C.merge_batches(spark, target.path, "r")
    assert len(seen) > 10 and all(rows == wanted(6) for rows in seen)


def test_a_merge_that_dies_changes_nothing(spark, folder, monkeypatch):
    target = TableTarget(f"{folder}/t")
    for i in range(5):
        target.write(batch(spark, i), i, "r")

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(C, "_commit", lost)
        with pytest.raises(RuntimeError):
            C.merge_batches(spark, target.path, "r")
    assert rows_of(target, spark) == wanted(5)
    C.merge_batches(spark, target.path, "r")
    assert rows_of(target, spark) == wanted(5)


def test_runs_stay_apart_and_merges_are_merged(spark, folder):
    target = TableTarget(f"{folder}/t")
    target.write(batch(spark, 0, "bounded"), 0, "1")
    target.write(batch(spark, 900), -1, "r")                  # a flush
    for i in range(30):
        target.write(batch(spark, i), i, "r")
        if i % 7 == 6:
            C.merge_batches(spark, target.path, "r")
    state = C.manifest(spark, target.path)
    assert [(m["run_id"], m["first"], m["last"]) for m in state["merged"]] == [("r", 0, 25)]
    want = sorted(wanted(30) + [(k, "b0bounded") for k in range(10)] + [(k, "b900") for k in range(9000, 9010)])
    assert rows_of(target, spark) == want
    assert C.merge_batches(spark, target.path, "1") == 0
    target.write(batch(spark, 0, "again"), 0, "1")
    assert rows_of(target, spark) == sorted([(k, v.replace("bounded", "again")) for k, v in want])


def test_merges_by_themselves(spark, folder):
    target = TableTarget(f"{folder}/t", merge_every=5)
    for i in range(23):
        target.write(batch(spark, i), i, "r")
    assert rows_of(target, spark) == wanted(23)
    assert len(data_files(folder)) < 15
    assert C.merge_batches(spark, target.path, "nobody") == 0
