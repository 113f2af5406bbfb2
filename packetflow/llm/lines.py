"""Line dedup: lines whose normalised form occurs in many documents stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import read_table

MIN_CHARS = 20             # code points of a key that counts
MIN_DOCUMENTS = 3          # documents that hold it
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped) of every row of `docs`.

    Keys of at least `min_chars` code points found in at least `min_documents`
    distinct ids lose their lines everywhere but in the largest id holding them.
    Rows of one id count as one document, and each keeps or drops the same
    keys; null ids count as one document that is larger than no other. A null
    text is one empty line, as is an empty one. An empty table gives no rows.

    Only hashes (128 bits) of lines are shuffled. A row holds a key once
    however often it is repeated there, and the count per key is added up
    before the shuffle, so a line found in a third of all documents is no
    larger than another. Back at the documents, only their dropped keys arrive.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))

    key = line_key(F.col("line"))
    lines = rows.select("doc_id", F.explode(F.array_distinct(F.split("text", "\n", -1))).alias("line"))
    hashes = lines.select("doc_id", key.alias("key")).where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        F.coalesce("doc_id", F.lit(-2 ** 63)).alias("doc"))
    held = hashes.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    counted = held.groupBy("h1", "h2").agg(F.count("one").alias("n"), F.max("doc").alias("keeper"))
    common = counted.where(F.col("n") >= min_documents).select("h1", "h2", "keeper")
    dropped = (held.join(common, ["h1", "h2"]).where("doc <> keeper")
               .groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))

    found = rows.withColumn("doc", F.coalesce("doc_id", F.lit(-2 ** 63))).join(dropped, "doc", "left")
    all_lines = F.split("text", "\n", -1)

    def stays(line: Column) -> Column:
        k = line_key(line)
        hashed = F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))
        return (F.length(k) < min_chars) | ~F.array_contains(F.col("gone"), hashed)

    kept = F.when(F.col("gone").isNull(), all_lines).otherwise(F.filter(all_lines, stays))
    return (found.select("doc_id", F.size(all_lines).cast("long").alias("n_lines"),
                         kept.alias("kept"))
            .select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
                    F.array_join("kept", "\n").alias("kept_text")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and checksum of what is left, of every document."""
    found = dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped",
                        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
