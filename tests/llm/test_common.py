import pytest
from pyspark.sql import functions as F

from packetflow.llm import common
from packetflow.llm.common import join_counted
from packetflow.llm.components import components
from tests.llm.test_simhash import test_query_equals_brute_force as simhash_equals_brute_force


@pytest.mark.parametrize("hot_rows", [0, 3, 256])
def test_join_counted_is_a_join(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    rows = spark.createDataFrame([(k, w, i) for i, (k, w) in enumerate(
        [(1, 1)] * 9 + [(1, 2)] * 3 + [(2, 1)] * 4 + [(3, 3), (None, 1), (1, None)])], "k long, w long, i int")
    table = (rows.where("k is null OR k < 3").groupBy("k", "w")
             .agg(F.min("i").alias("least"), F.count("*").alias("many")))
    got = join_counted(rows, table, ["k", "w"], "many", rows.count())
    want = rows.join(table.drop("many"), ["k", "w"])
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert join_counted(rows.limit(0), table.limit(0), ["k", "w"], "many", 0).collect() == []


@pytest.mark.parametrize("hot_rows", [0, 256])
def test_components_with_hubs(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    star = [(7, i) for i in range(8, 700)]                       # one hub
    chain = [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2001), (2001, 2000), (5, 5)]
    links = spark.createDataFrame(star + chain + star[:50], "a long, b long")
    got = {r.node: r.least for r in components(spark, links).collect()}
    assert got == {i: 7 for i in range(8, 700)} | {i: 1000 for i in range(1001, 1041)} | {2001: 2000}


def test_simhash_where_every_key_is_hot(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 0)
    simhash_equals_brute_force(spark)
