"""Suffix-array dedup: remove bytes covered by long strings that occur elsewhere too.

A string of 200 bytes is a window. Windows that are equal contain the same
64-byte grams, so they have the same least gram hash (minimizer): runs of
neighbouring windows with one minimizer are dealt by it, some 1.5 % as many as
there are bytes. A run that occurs twice as a whole needs no closer look. Only
where different runs share a minimizer (the edges of matches) are their texts
fetched, one for each different run, and the suffixes at their windows sorted
deep-shallow: a multikey sort, eight bytes a character, down to a shallow
depth, then a blind trie for each group that still shares its prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm import common
from packetflow.llm.common import documents_input, join_counted, pieces, read_table, ship_package, written

LENGTH = 200               # bytes of a window
GRAM = 64                  # bytes whose hashes choose the minimizer
SHALLOW = 32               # depth of the multikey sort
HOT_RUNS = 4_096           # different runs of one minimizer that are sorted in one task
CHUNK_BYTES = 1 << 20      # run texts sorted at a time; some fifty bytes are held for each
PARTS = 32                 # tasks that the copies of a frequent text are dealt to
COMPARED = 4_096           # windows that are compared at a time

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        with np.errstate(over="ignore"):
            held = np.multiply.accumulate(held)
        _POWERS[base] = held
    return held[:n]


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of every gram of the bytes."""
    n = len(raw)
    with np.errstate(over="ignore"):
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
            (raw.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, n), dtype=np.uint64)))
        h = (prefix[gram:] - prefix[:-gram]) * _powers(_INVERSE, n - gram + 1)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of every `width` neighbours, by doubling."""
    pick = np.minimum if least else np.maximum
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def runs_of(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(minimizer, first window, last window, whether its gram occurs twice there) of every run."""
    if len(raw) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, bool))
    width = length - gram + 1
    h = gram_hashes(raw, gram)
    least = _sliding(h, width, True)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((first[1:], [len(least)])) - 1
    # The grams that are some window's minimizer; those of one run follow each other.
    edge = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(h == _sliding(np.concatenate((edge, least, edge)), width, False))
    low, high = np.searchsorted(at, first), np.searchsorted(at, last + width)
    own = np.concatenate(([0], np.cumsum(np.concatenate((
        [0], (h[at][1:] == h[at][:-1]) & (np.diff(at) <= width)))))) if len(at) else np.zeros(1)
    # Repeats counted strictly inside the run's own stretch of grams.
    repeats = own[np.maximum(high, low + 1)] - own[np.minimum(low + 1, len(own) - 1)]
    return least[first], first, last, repeats > 0


def _run_batches(length: int, gram: int):
    schema = pa.schema([("v", pa.int64()), ("r", pa.int64()), ("doc_id", pa.int64()), ("t", pa.int64()),
                        ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("own", pa.int8())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in pieces(batches, 256):
            parts, rows = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                v, a, b, own = runs_of(np.frombuffer(data, np.uint8), length, gram)
                if len(v):
                    r = np.array([digest(data[s:e + length]) for s, e in
                                  zip(a.tolist(), b.tolist(), strict=True)], np.uint64)
                    parts.append((v.view(np.int64), r.view(np.int64), a, b, own.astype(np.int8),
                                  np.full(len(v), len(data))))
                    rows.append(np.full(len(v), row))
            if parts:
                v, r, a, b, own, n = map(np.concatenate, zip(*parts, strict=True))
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v), pa.array(r), batch.column("doc_id").take(at),
                     batch.column("t").take(at), pa.array(n), pa.array(a), pa.array(b), pa.array(own)],
                    schema=schema)
    return run


class BlindTrie:
    """Strings of one length by their branching places only; each insertion compares two strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int = 0          # a leaf (number of a string), or [depth, children]
        self.equal = [0] * len(strings)    # the first string equal to each
        for i in range(1, len(strings)):
            self.equal[i] = self._insert(i)

    def _insert(self, new: int) -> int:
        s, node = self.strings[new], self.root
        while isinstance(node, list):      # blindly: only the branching bytes are looked at
            node = node[1].get(s[node[0]]) if s[node[0]] in node[1] else next(iter(node[1].values()))
        other = self.strings[node]
        if s == other:
            return node
        differ = int.from_bytes(s) ^ int.from_bytes(other)
        depth = len(s) - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = new
        else:
            fresh = [depth, {other[depth]: node, s[depth]: new}]
            if above is None:
                self.root = fresh
            else:
                above[1][s[above[0]]] = fresh
        return new


def repeated_windows(buffer: np.ndarray, starts: np.ndarray, length: int = LENGTH,
                     shallow: int = SHALLOW) -> np.ndarray:
    """Which of the windows at `starts` are equal to another one of them, by deep-shallow sorting."""
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    padded = np.concatenate((buffer, np.zeros(8, np.uint8)))
    word = np.zeros(len(buffer), np.uint64)
    for i in range(8):
        word <<= np.uint64(8)
        word |= padded[i:len(buffer) + i]
    # Shallow: each level splits every group by its next character of eight bytes.
    alive, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for depth in range(0, min(shallow, length // 8 * 8), 8):
        key = word[starts[alive] + depth]
        order = np.lexsort((key, group))
        alive, group, key = alive[order], group[order], key[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
        group = np.cumsum(new) - 1
        kept = np.bincount(group)[group] > 1
        alive, group = alive[kept], group[kept]
        if not len(alive):
            return out
    # Deep: groups that are equal throughout are tries of one leaf, and need no trie.
    group = np.unique(group, return_inverse=True)[1]
    heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    same = np.ones(len(alive), bool)
    offsets = np.arange(length)
    for at in range(0, len(alive), COMPARED):
        part = slice(at, at + COMPARED)
        same[part] = (buffer[starts[alive[part]][:, None] + offsets]
                      == buffer[starts[alive[heads[group[part]]]][:, None] + offsets]).all(axis=1)
    whole = np.logical_and.reduceat(same, heads)
    sizes = np.diff(np.concatenate((heads, [len(alive)])))
    out[alive[whole[group]]] = True
    data = buffer.tobytes()
    for g in np.flatnonzero(~whole & (sizes > 2)).tolist():
        members = alive[heads[g]:heads[g] + sizes[g]]
        equal = np.array(BlindTrie([data[s:s + length] for s in starts[members].tolist()]).equal)
        out[members] = np.bincount(equal, minlength=len(equal))[equal] > 1
    return out


def _ranges(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of true marks."""
    edges = np.diff(np.concatenate(([0], marks.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


FOUND = pa.schema([("v", pa.int64()), ("r", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])


def _sort_chunk(rows: dict[tuple[int, int], bytes], length: int) -> pa.RecordBatch:
    """The repeated windows (stretches, counted from the run's first) among the runs of some minimizers."""
    keys, texts = list(rows), list(rows.values())
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    first = np.cumsum(counts) - counts
    starts = np.arange(counts.sum()) - np.repeat(first, counts) + np.repeat(begin, counts)
    marks = repeated_windows(np.frombuffer(b"".join(texts), np.uint8), starts, length)
    v, r, low, high = [], [], [], []
    for k, (at, n) in enumerate(zip(first.tolist(), counts.tolist(), strict=True)):
        if marks[at:at + n].any():
            for x, y in zip(*_ranges(marks[at:at + n]), strict=True):
                v.append(keys[k][0])
                r.append(keys[k][1])
                low.append(x)
                high.append(y)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (v, r, low, high)], schema=FOUND)


def _sort_batches(length: int):
    """Rows come ordered by minimizer; all runs of one are in one chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, int], bytes] = {}
        held, last = 0, None
        for batch in batches:
            for v, r, z in zip(*(batch.column(c).to_pylist() for c in ("v", "r", "run")), strict=True):
                if v != last and held > CHUNK_BYTES:
                    yield _sort_chunk(rows, length)
                    rows, held = {}, 0
                if (v, r) not in rows:
                    rows[v, r] = zstandard.decompress(z)
                    held += len(rows[v, r])
                last = v
        if rows:
            yield _sort_chunk(rows, length)
    return run


def _cut_batches(length: int):
    schema = pa.schema([("v", pa.int64()), ("r", pa.int64()), ("hot", pa.bool_()), ("run", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches, 256):
            out = []
            for z, runs in zip(batch.column("z").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data = zstandard.decompress(z)
                out += [(x["v"], x["r"], x["hot"], pack(data[x["a"]:x["b"] + length])) for x in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def _window_batches(length: int):
    """Every window of a hot minimizer's runs, as 128 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            out = []
            for v, r, z in zip(*(batch.column(c).to_pylist() for c in ("v", "r", "run")), strict=True):
                data = zstandard.decompress(z)
                out += [(v, r, i, xxhash.xxh3_128_digest(data[i:i + length]))
                        for i in range(len(data) - length + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in
                 enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["v", "r", "low", "w"])
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed UTF-8: what is shuffled of them is half as large."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in pieces(batches, 256):
        data = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("t"), pa.array([len(d) for d in data], pa.int64()),
             pa.array([pack(d) for d in data], pa.binary())], names=["doc_id", "t", "n", "z"])


def _remove_batches(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            out = []
            for doc, z, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "z", "gone")),
                                    strict=True):
                data, kept, at, spans = zstandard.decompress(z), [], 0, 0
                end = -1
                for x in sorted((g["low"], g["high"] + length) for g in gone or ()):
                    if x[0] > end:
                        spans += 1
                        kept.append(data[max(at, 0):x[0]])
                    end = at = max(end, x[1])
                kept = b"".join([*kept, data[at:]])
                out.append((doc, len(data), len(data) - len(kept), spans, kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of `docs`.

    `kept` is what is left of the text's UTF-8 bytes. Null texts are empty;
    texts under `length` bytes stay whole; repeated rows are documents like any
    other, so each is removed whole if it is long enough; null ids are kept;
    an empty table gives no rows. Texts are known by hash and length, so rows
    of one id don't mix.

    Equal runs are counted before the shuffle, and only one text of each is
    ever fetched. What is found out about a passage in very many documents is
    broadcast to its runs, and copies of one text are dealt to PARTS tasks. A
    minimizer with very many different runs is not sorted in one task: its
    windows are dealt singly, by their own 128-bit hashes.
    """
    ship_package(spark)
    rows = documents_input(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    runs = written(spark, rows.mapInArrow(
        _run_batches(length, gram),
        "v long, r long, doc_id long, t long, n long, a long, b long, own byte"), "runs")

    per_v = (runs.groupBy("v").agg(F.count("*").alias("many"), F.min("r").alias("r1"),
                                   F.max("r").alias("r2"), F.max("own").alias("within"))
             .where("many > 1 OR within > 0")
             .select("v", "many", ((F.col("r1") != F.col("r2")) | (F.col("within") > 0)).alias("mixed")))
    shared = written(spark, join_counted(runs, per_v, ["v"], "many", runs.count()), "shared-runs")
    kinds = written(spark, shared.groupBy("v", "r").agg(
        F.count("*").alias("copies"), F.max("mixed").alias("mixed"),
        F.min(F.struct("doc_id", "t", "n", "a", "b")).alias("one")), "run-kinds")

    # The text of one run of each kind, where kinds share a minimizer.
    hot = (kinds.where("mixed").groupBy("v").agg(F.count("*").alias("kinds"))
           .where(F.col("kinds") > HOT_RUNS).select("v", F.lit(True).alias("is_hot")))
    wanted = (kinds.where("mixed").join(hot, "v", "left")
              .select(F.col("one.doc_id").alias("d"), F.col("one.t").alias("t"), F.col("one.n").alias("n"),
                      F.struct("v", "r", F.coalesce("is_hot", F.lit(False)).alias("hot"),
                               F.col("one.a").alias("a"), F.col("one.b").alias("b")).alias("run"))
              .groupBy("d", "t", "n").agg(F.collect_list("run").alias("runs")))
    texts = rows.mapInArrow(_packed, "doc_id long, t long, n long, z binary")
    cut = written(spark, texts.join(wanted, (texts["t"] == wanted["t"]) & (texts["n"] == wanted["n"])
                                    & texts["doc_id"].eqNullSafe(wanted["d"])).select("z", "runs")
                  .mapInArrow(_cut_batches(length), "v long, r long, hot boolean, run binary"), "run-texts")
    sort = (cut.where("NOT hot").select("v", "r", "run").repartition("v").sortWithinPartitions("v")
            .mapInArrow(_sort_batches(length), "v long, r long, low long, high long"))
    windows = (cut.where("hot").select("v", "r", "run").dropDuplicates(["v", "r"])
               .mapInArrow(_window_batches(length), "v long, r long, low long, w binary"))
    again = windows.groupBy("w").agg(F.count("*").alias("times")).where("times > 1").select("w")
    dealt = windows.join(again, "w").select("v", "r", "low", F.col("low").alias("high"))
    # Runs that occur more than once are repeated as a whole; the others where the sorting says so.
    whole = kinds.where("copies > 1").select(
        "v", "r", F.lit(0).cast("long").alias("low"), (F.col("one.b") - F.col("one.a")).alias("high"), "copies")
    once = kinds.where("copies = 1 AND mixed").select("v", "r")
    partly = (sort.unionByName(dealt).join(once, ["v", "r"], "left_semi")
              .withColumn("copies", F.lit(1).cast("long")))
    stretches = (join_counted(shared, whole.unionByName(partly), ["v", "r"], "copies", shared.count())
                 .select("t", "n", (F.col("a") + F.col("low")).alias("low"),
                         (F.col("a") + F.col("high")).alias("high")).distinct())
    gone = stretches.groupBy("t", "n").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    # Frequent texts are dealt by input partition too, and their stretches copied to each part.
    counts = rows.groupBy("t").agg(F.count("*").alias("same"))
    many = F.broadcast(written(spark, counts.where(
        F.col("same") > max(common.HOT_ROWS, rows.count() // common.HOT_SHARE)).select(
        "t", F.lit(PARTS - 1).alias("parts")), "frequent-texts"))
    split = F.coalesce("parts", F.lit(0))
    texts = (texts.join(many, "t", "left")
             .withColumn("part", F.pmod(F.spark_partition_id(), split + 1)).drop("parts"))
    gone = (gone.join(many, "t", "left")
            .withColumn("part", F.explode(F.sequence(F.lit(0), split))).drop("parts"))
    return texts.join(gone, ["t", "n", "part"], "left").select("doc_id", "z", "gone").mapInArrow(
        _remove_batches(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes, removed stretches and checksum of what is left, of every document."""
    found = remove_repeats(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))
