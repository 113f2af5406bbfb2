"""What the operators of this subpackage share: tables, shared folders, parameters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.session import run_folder, ship_package

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: its lineage is cut, and lost executors lose nothing."""
    folder = run_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task holds the Python objects of few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def documents_input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, whatever other columns `docs` has."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text (UTF-8); null ids count as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8"))


def labelled_sample(labels: DataFrame, label: str, held_out, rows: int) -> DataFrame:
    """At most `rows` labelled ids that may be learned from, each once: (doc_id, y).

    The choice goes by a hash of the id, so that it is the same in every run
    and independent of the table's order. An id with both labels has label 0.
    """
    usable = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
              .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
              .where(~held_out).groupBy("doc_id").agg(F.min("y").alias("y")))
    order = F.xxhash64(F.col("doc_id"), F.lit(f"{label}-sample"))
    return usable.orderBy(order, "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, y): one text for each id of `sample`, the least of those that repeat it.

    So the learner's rows are as many as the sample's, however often an id
    occurs; within a task only the least is kept before the shuffle.
    """
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


HOT_ROWS = 256             # a key with fewer rows is never hot
HOT_SHARE = 1 << 15        # nor one with a lesser part of all rows than this


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """`rows` joined with `table` on `keys`, where a key with very many rows doesn't meet in one task.

    `table` has one row a key, and in its column `count` how many of the `total`
    rows have that key. Keys with over a 2^15th of all rows, of which there can
    be 2^15 at most, are broadcast; the others are shuffled. `count` is dropped;
    null keys join nothing. `table`'s rows should be small, since they are sent.
    """
    least = max(HOT_ROWS, total // HOT_SHARE)
    hot = F.broadcast(table.where(F.col(count) > least).drop(count))
    cold = table.where(F.col(count) <= least).drop(count)
    dealt = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(dealt)


NULL_IDS = 1 << 62         # keys of rows without an id are from here up


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id, or for rows without one a hash of the text: a key that keeps such rows apart."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return F.coalesce(F.col(f"`{id_col}`").cast("long"),
                      F.xxhash64(text).bitwiseAND(F.lit(NULL_IDS - 1)).bitwiseOR(F.lit(NULL_IDS)))


__all__ = ["DOCUMENT_COLUMNS", "crc32_of_id", "documents_input", "join_counted", "labelled_sample",
           "labelled_texts", "pieces", "read_table", "row_key", "run_folder", "ship_package", "written"]
