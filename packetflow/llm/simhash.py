"""SimHash near-duplicates, found through the anchor points of a covering code.

Fingerprints within 3 bits differ in at most one bit on one of two disjoint
blocks of 31 bits. On a block, the codewords of the Hamming code of length 31
are the anchors: the code is perfect, so every point is within 1 of exactly
one anchor (covering radius R = 1). A fingerprint is replicated to every
anchor within R + 1 = 2 of its block (1 or 16 anchors). Of two fingerprints
that differ in at most one bit there, the nearest anchor of the one is within
2 of the other, so both meet at it, and are compared there over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import documents_input, join_counted, pieces, read_table, ship_package, written
from packetflow.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = (0, 31)           # first bit of each block
BLOCK_BITS = 31
CELL_SPLIT = 2048          # larger cells are split by 16-bit bands


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the shingle hashes of one text, as a signed 64-bit integer."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_digest
    joined = b" ".join(parts)
    if len(parts) < words:
        hashes = digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in
                           zip(starts[:len(parts) - words + 1].tolist(),
                               ends[words - 1:].tolist(), strict=True)])
    raw = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 65536):
        ones += np.unpackbits(raw[at:at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(raw))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def _fingerprint_batches(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fps = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64())], schema=schema)
    return run


def block_anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and anchor of each anchor within 2 of each 31-bit point."""
    syndrome = np.zeros(len(points), np.int64)
    for bit in range(BLOCK_BITS):
        syndrome ^= ((points >> bit) & 1) * (bit + 1)
    rows, anchors = [np.flatnonzero(syndrome == 0)], [points[syndrome == 0]]
    off = np.flatnonzero(syndrome)
    s, p = syndrome[off], points[off]
    rows.append(off)
    anchors.append(p ^ (1 << (s - 1)))
    for first in range(1, BLOCK_BITS + 1):
        second = s ^ first              # flipping both bits cancels the syndrome
        ok = second > first
        rows.append(off[ok])
        anchors.append(p[ok] ^ (1 << (first - 1)) ^ (1 << (second[ok] - 1)))
    return np.concatenate(rows), np.concatenate(anchors)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("cell", pa.int64()), ("fp", pa.int64())])
    mask = (1 << BLOCK_BITS) - 1
    for batch in pieces(batches, 20_000):
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for number, start in enumerate(BLOCKS):
            points = ((fps.view(np.uint64) >> np.uint64(start)) & np.uint64(mask)).astype(np.int64)
            rows, anchors = block_anchors(points)
            yield pa.RecordBatch.from_arrays(
                [pa.array((number << BLOCK_BITS) | anchors), pa.array(fps[rows])], schema=schema)


def cell_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links: each fingerprint of a cell with the least one it is linked to, directly or not."""
    fps = np.unique(fps)
    points = fps.view(np.uint64)
    label = np.arange(len(fps))
    changed = True
    while changed:
        changed = False
        for at in range(0, len(fps), 512):
            near = np.bitwise_count(points[at:at + 512, None] ^ points[None, :]) <= max_bits
            low = np.where(near, label[None, :], len(fps)).min(axis=1)
            if (low < label[at:at + 512]).any():
                label[at:at + 512] = low
                changed = True
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _link_batches(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("fps")
            flat = cells.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(cells.value_lengths().to_numpy(zero_copy_only=False))
            starts = ends - cells.value_lengths().to_numpy(zero_copy_only=False)
            size = ends - starts
            two = starts[size == 2]
            x, y = flat[two], flat[two + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits
            a, b = [x[near]], [y[near]]
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
                moved, least = cell_links(flat[s:e], max_bits)
                a.append(moved)
                b.append(least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema)
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fps.fp` as all pairs within `max_bits` do."""
    if max_bits > 3:
        raise ValueError("two blocks of covering radius 1 serve at most 3 differing bits")
    cells = fps.select("fp").mapInArrow(_anchor_batches, "cell long, fp long")
    # A cell too large for one task is split by four 16-bit bands: fingerprints
    # within 3 bits agree on one of them.
    hot = (cells.groupBy("cell").agg(F.count("*").alias("n"))
           .where(F.col("n") > CELL_SPLIT).select("cell", F.lit(True).alias("hot")))
    bands = F.array(*(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
                      + F.lit(i * 65536 + 1) for i in range(4)))
    split = (cells.join(hot, "cell", "left")
             .select("cell", "fp", F.explode(F.when(F.col("hot"), bands).otherwise(
                 F.array(F.lit(0).cast("long")))).alias("band")))
    members = (split.groupBy("cell", "band").agg(F.collect_list("fp").alias("fps"))
               .where(F.size("fps") > 1).select("fps"))
    return members.mapInArrow(_link_batches(max_bits), "a long, b long").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id",
                    text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp long, component_id) of every row of `docs`.

    A null text counts as the empty one; texts without words have fingerprint
    zero and are linked like any other. Repeated rows each get their row. Null
    ids get the component of their fingerprint; an empty table gives no rows.
    Only distinct fingerprints are replicated and compared, so a group of
    copies costs one row, and every cell gives star links, not all pairs. The
    components of frequent fingerprints are broadcast to their rows.
    """
    ship_package(spark)
    prints = written(spark, documents_input(docs, id_col, text_col).mapInArrow(
        _fingerprint_batches(words), "doc_id long, fp long"), "simhash")
    distinct = written(spark, prints.groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "simhash-fps")
    least = components(spark, fingerprint_links(distinct, max_bits))
    classes = written(spark, distinct.join(least, distinct["fp"] == least["node"], "left")
                      .select("fp", "rep", "copies", F.coalesce("least", "fp").alias("least")),
                      "simhash-classes")
    ids = classes.groupBy("least").agg(F.min("rep").alias("component_id"), F.count("*").alias("kinds"))
    members = written(spark, join_counted(classes.select("fp", "copies", "least"), ids, ["least"], "kinds",
                                          classes.count())
                      .select("fp", "copies", "component_id"), "simhash-components")
    return join_counted(prints, members, ["fp"], "copies", prints.count()).select(
        "doc_id", "fp", "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, at most 3 bits)."""
    found = near_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
