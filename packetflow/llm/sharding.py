"""Shards of nearly equal bytes: a minimax contiguous partition of groups of equal texts.

Groups of equal texts are atomic and stand in the order of a 64-bit hash of the
text. The smallest capacity is searched for by halving: a capacity is feasible
if filling shard after shard, group by group, takes no more shards than there
are. The cuts are those of the smallest feasible one.

The driver never holds the groups. It sees segments, ranges of hashes with
their bytes, and fills shards twice: with segments that can't be cut, which
ends no later than the truth, and with segments that can be cut anywhere, which
ends no earlier. Segments that a true cut may lie in are split further, by one
job over the groups, until those are single groups; then both agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetflow.llm.common import read_table, run_folder, ship_package, written

SHARDS = 40
ROW_BYTES = 16             # of a row besides its text
BINS = 1 << 14             # segments at first, a power of two
SMALL_FILES = 100_000      # files of all shards whose names are broadcast
SPLIT = 64                 # parts of a segment that is split


@dataclass
class Plan:
    """Which hashes make up which shard: `giants` by themselves, then ranges that end before `cuts`."""

    giants: list[int]
    cuts: list[int]
    capacity: int
    loads: list[tuple[int, int]]       # bytes and rows of each shard

    def shard(self, key: Column) -> Column:
        """The shard of a row by the hash of its text."""
        cuts = F.array(*map(F.lit, self.cuts)).cast("array<bigint>")
        place = F.size(F.filter(cuts, lambda c: c <= key)) + F.lit(len(self.giants))
        if not self.giants:
            return place
        alone = F.array_position(F.array(*map(F.lit, self.giants)).cast("array<bigint>"), key)
        return F.when(alone > 0, alone - 1).otherwise(place).cast("int")


class Segments:
    """Ranges of hashes, in order, with their bytes, rows and groups."""

    def __init__(self, low, high, size, rows, groups):
        order = np.argsort(low)
        self.low, self.high, self.size, self.rows, self.groups = (
            np.asarray(x, np.int64)[order] for x in (low, high, size, rows, groups))
        self.ends = np.concatenate(([0], np.cumsum(self.size)))
        self.single = self.groups == 1
        self.total = int(self.ends[-1])

    def fill(self, capacity: int, shards: int, fluid: bool) -> list[int]:
        """How many bytes lie before each cut, filling shard after shard."""
        at, cuts = 0, []
        for _ in range(shards):
            j = int(np.searchsorted(self.ends, at + capacity, "right")) - 1
            inside = fluid and j < len(self.size) and not self.single[j]
            at = at + capacity if inside else max(at, int(self.ends[j]))
            cuts.append(min(at, self.total))
        return cuts

    def least(self, shards: int, fluid: bool) -> int:
        """The smallest capacity with which `shards` shards hold everything."""
        low, high = max(-(-self.total // shards), 1), max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, fluid)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, shards: int) -> np.ndarray:
        """Segments of several groups that a cut may lie in, at any capacity that may be the smallest."""
        first = self.fill(self.least(shards, True), shards, False)
        last = self.fill(self.least(shards, False), shards, True)
        reached = np.zeros(len(self.size) + 1, np.int64)
        np.add.at(reached, np.maximum(np.searchsorted(self.ends, first, "right") - 1, 0), 1)
        np.add.at(reached, np.minimum(np.searchsorted(self.ends, last, "left"), len(self.size)), -1)
        return (np.cumsum(reached)[:-1] > 0) & ~self.single


def _parts(groups: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """The ranges (low, high) split into SPLIT parts each: (low, high, size, rows, groups)."""
    width = [-(-(int(h) - int(a) + 1) // SPLIT) for a, h in zip(low, high)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size, rows = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            at = np.searchsorted(low, key, "right") - 1
            mine = (at >= 0) & (key <= high[at])
            key, size, rows, at = key[mine], size[mine], rows[mine], at[mine]
            span = np.array(width, np.uint64)[at]
            part = ((key - low[at]).view(np.uint64) // span).astype(np.int64)
            code, inverse = np.unique(at * SPLIT + part, return_inverse=True)
            sums = [np.zeros(len(code), np.int64) for _ in range(3)]
            for total, values in zip(sums, (size, rows, np.ones(len(key), np.int64))):
                np.add.at(total, inverse, values)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (code, *sums)],
                                             names=["code", "size", "rows", "groups"])

    found = groups.mapInArrow(run, "code long, size long, rows long, groups long")
    return found.groupBy("code").agg(*(F.sum(c).alias(c) for c in ("size", "rows", "groups")))


def _split(groups: DataFrame, low: np.ndarray, high: np.ndarray) -> list[tuple]:
    out = []
    for code, size, rows, n in _parts(groups, low, high).collect():
        a, h = int(low[code // SPLIT]), int(high[code // SPLIT])
        width = -(-(h - a + 1) // SPLIT)
        start = a + code % SPLIT * width
        out.append((start, min(start + width - 1, h), size, rows, n))
    return out


def plan_shards(groups: DataFrame, shards: int = SHARDS, bins: int = BINS) -> Plan:
    """The cuts for `groups` (key, size, rows), a row a group.

    Groups above the mean of what remains besides them get a shard each, since
    no capacity below their size is feasible and the other shards would be
    filled up to it; they come first in the order. The driver sees at most
    `shards` groups, `bins` segments and, a round, SPLIT parts of those that a
    cut may lie in, which are about shards x shards however many groups there are.
    """
    top = groups.orderBy(F.desc("size"), "key").limit(shards).collect()
    giants, rest = [], groups.agg(F.sum("size")).first()[0] or 0
    for g in top:
        if len(giants) == shards - 1 or g["size"] * (shards - len(giants)) <= rest:
            break
        giants.append(g)
        rest -= g["size"]
    others = groups.where(~F.col("key").isin([g["key"] for g in giants])) if giants else groups
    left = shards - len(giants)

    step = (1 << 64) // bins
    low = np.array([-(1 << 63) + i * step for i in range(bins)], np.int64)
    found = others.groupBy(F.shiftright("key", step.bit_length() - 1).alias("bin")).agg(
        F.sum("size"), F.sum("rows"), F.count("*")).collect()
    segments = Segments(*(zip(*[(int(low[r[0] + bins // 2]), int(low[r[0] + bins // 2]) + step - 1,
                                 *r[1:]) for r in found]) if found else [[]] * 5))
    while True:
        unsure = segments.unsure(left)
        if not unsure.any():
            break
        parts = _split(others, segments.low[unsure], segments.high[unsure])
        old = [x[~unsure].tolist() for x in (segments.low, segments.high, segments.size,
                                             segments.rows, segments.groups)]
        segments = Segments(*([*a, *b] for a, b in zip(old, zip(*parts))))

    capacity = segments.least(left, False)
    ends = segments.fill(capacity, left, False)
    at = np.searchsorted(segments.ends, ends)
    rows = np.concatenate(([0], np.cumsum(segments.rows)))[at]
    # A shard that nothing is left for begins after all hashes.
    cuts = [int(segments.low[i]) if i < len(segments.low) else None for i in at[:-1]]
    loads = [(g["size"], g["rows"]) for g in giants] + list(zip(
        np.diff(ends, prepend=0).tolist(), np.diff(rows, prepend=0).tolist()))
    return Plan([g["key"] for g in giants], [c for c in cuts if c is not None],
                max([capacity, *(g["size"] for g in giants)]), loads)


def text_bytes(text: Column) -> Column:
    """Bytes of the text and its row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, *, text_col: str = "text",
                 shards: int = SHARDS) -> Plan:
    """Write `docs` into `folder`, in folders shard=0, shard=1, and so on; returns the plan.

    Each row goes in whole, as the struct `document`, so any columns may be
    there. Null texts are empty ones. Rows of equal texts share a shard (as do
    different texts of one 64-bit hash), whatever else they hold. Fewer groups
    than shards leave shards empty, an empty table leaves all of them so.

    A shard is written by as many tasks as its share of all bytes or rows asks
    for; rows go to one of them by a hash of their other columns and of the
    input partition they come from, so that copies are spread. `spark.sql.shuffle.partitions` is the
    number of tasks aimed at.
    """
    ship_package(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes
             if c != text_col and not kind.startswith(("map", "array", "struct", "variant"))]
    rows = docs.select(F.struct("*").alias("document"), F.xxhash64(text).alias("key"),
                       text_bytes(text).alias("size"),
                       F.xxhash64(*plain, F.spark_partition_id()).alias("spread"))
    groups = written(spark, rows.groupBy("key").agg(
        F.sum("size").alias("size"), F.count("*").alias("rows")), "shard-groups")
    plan = plan_shards(groups, shards)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    all_bytes, all_rows = (max(sum(x), 1) for x in zip(*plan.loads))
    share = [max(1, -(-tasks * size // all_bytes), -(-tasks * n // all_rows)) for size, n in plan.loads]
    first = np.concatenate(([0], np.cumsum(share)))
    # Which task takes a row: the first of its shard, and so many on.
    table = F.array(*(F.struct(F.lit(int(a)).alias("first"), F.lit(int(n)).alias("n"))
                      for a, n in zip(first, share)))
    of = F.element_at(table, F.col("shard") + 1)
    dealt = (rows.select("document", "spread", plan.shard(F.col("key")).cast("int").alias("shard"))
             .withColumn("task", (of["first"] + F.pmod("spread", of["n"].cast("long"))).cast("int")))
    (dealt.repartitionById(int(first[-1]), F.col("task")).select("document", "shard")
     .write.partitionBy("shard").parquet(folder))
    return plan


def read_shards(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """(document, shard, slot) of the written rows; `like` has the columns of the documents.

    A slot is the row's place in its shard: its place in its file, after the
    shard's earlier files. Files are numbered by name.
    """
    schema = like.select(F.struct("*").alias("document")).schema
    stored = spark.read.schema(schema.add("shard", T.IntegerType())).parquet(folder).select(
        "document", "shard", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"))
    files = stored.groupBy("shard", "file").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("shard", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if len(stored.inputFiles()) <= SMALL_FILES:      # else the rows are shuffled to their files' numbers
        files = F.broadcast(files)
    return (stored.join(files, ["shard", "file"])
            .select("document", "shard", (F.col("before") + F.col("row")).alias("slot")))


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot, size and checksum of every document, read back from the shards written."""
    docs = read_table(spark, sf_dir, "documents")
    folder = run_folder(spark, "shards")
    write_shards(spark, docs, folder)
    text = F.coalesce(F.col("document.text"), F.lit(""))
    return read_shards(spark, folder, docs).select(
        F.col("document.doc_id").alias("doc_id"), text_bytes(text).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
