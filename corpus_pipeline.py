"""A corpus through five stages; each is written as Parquet and reread as the next one's input.

Every stage takes (spark, docs, sf_dir), works on all of `docs`, and returns
the columns of documents; the last returns each document's place in the token
files. Null texts are empty ones and stay like other short texts; an empty
table stays empty; other columns of the input are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm import toxicity
from packetflow.llm.common import DOCUMENT_COLUMNS, labelled_sample, read_table, row_key, written
from packetflow.llm.decontaminate import find_leaks
from packetflow.llm.mixing import mix, word_count
from packetflow.llm.simhash import near_duplicates
from packetflow.llm.tokens import encoded


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the operator's threshold stay."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    sample = labelled_sample(read_table(spark, sf_dir, "labels"), "toxic", toxicity.held_out(),
                             toxicity.SAMPLE_ROWS)
    return toxicity.drop_toxic(spark, docs, toxicity.fit(spark, docs.select("doc_id", "text"), sample))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each SimHash component: the one with the least id.

    Rows that repeat both id and text are one document, and rows that share an
    id but not the text stay or go together. Rows without an id are documents of
    their own, one for each text; they stay only where their component has no id.
    """
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("key", row_key())
    found = near_duplicates(spark, docs, id_col="key")
    least = (found.where(F.col("doc_id") == F.col("component_id"))
             .select(F.col("doc_id").alias("kept")).distinct())
    stay = docs.join(least, docs["key"] == least["kept"], "left_semi")
    return stay.dropDuplicates(["key", "text"]).select(*DOCUMENT_COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay; rows of one id, or of one text without an id,
    stay or go together."""
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("key", row_key())
    found = find_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"), id_col="key")
    leaks = written(spark, found.select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    return docs.join(leaks, docs["key"] == leaks["leak"], "left_anti").select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it (not at all, once or twice).

    Of rows that are equal in id, source and size, each is taken as often as
    the one that is taken most.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    takes = (mix(spark, docs).groupBy("doc_id", "source", "size")
             .agg(F.max("copies").alias("copies")).where("copies > 0")
             .select(F.col("doc_id").alias("d"), F.col("source").alias("s"),
                     F.col("size").alias("n"), "copies"))
    sized = docs.withColumn("size", word_count(F.col("text")))
    taken = sized.join(takes, sized["doc_id"].eqNullSafe(takes["d"])
                       & sized["source"].eqNullSafe(takes["s"]) & (sized["size"] == takes["n"]))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))) \
        .select(*DOCUMENT_COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the token files."""
    return encoded(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

# SimHash, the learned scores and the tokenizer have no SQL form; tests/llm/test_pipeline.py
# holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
