"""LM scoring by cross-entropy difference (target loss against background loss, per token).

The vocabulary is every word of the corpus, shared by both models. Bigrams are
counted over every document; those of the target documents also make the target
model. Both are smoothed in the same way, so a document's score compares like
with like.

1. Words go by 62-bit hashes. Their counts are written as one table: the
   vocabulary.
2. The HOT_WORDS most frequent ones and the text's edge have the bigrams among
   them, and their own counts, in dense tables that every task gets. That is
   for speed and against skew alone: all other bigrams are counted too.
3. Every other bigram has a word that is not hot. It goes to that word's
   partition (the second word's, if neither is hot), with its place in the
   documents: there all uses of the word meet, so its counts, its bigrams'
   counts and the losses are known without a join.
4. The losses are summed by document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import documents_input, pieces, read_table, ship_package, written

HOT_WORDS = 1022           # words in the dense tables; there 0 is the text's edge, 1 any other word
SMOOTHING = 50.0           # weight of the unigram model in a bigram context
HELD_WORDS = 400_000       # distinct words that a task counts before it passes them on
CHUNK = 2048               # texts whose bigrams are passed on together
SMALL_IDS = 1 << 20        # target ids that are broadcast to the texts, at most
COLD, AFTER = 65535, 2048  # kinds of a bigram's other word: not hot; hot, and the second of the two

_LOW = 1 << 62             # hashes are from here up
_OTHER = _LOW              # of all words outside a given vocabulary


class _Hashes(dict):
    """62-bit hashes of words; all words outside `chosen`, if it is given, have the same one."""

    def __init__(self, chosen: list[str] | None):
        self.chosen = None if chosen is None else frozenset(chosen)

    def __missing__(self, word: str) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        if self.chosen is not None and word not in self.chosen:
            found = _OTHER
        else:
            code = blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            found = int.from_bytes(code, "little") >> 2 | _LOW
        self[word] = found
        return found

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts on end, and how many each text has."""
        rows = []
        for text in texts:
            words = (text or "").split()
            rows.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        return np.concatenate([*rows, np.zeros(0, np.int64)]), np.array([len(r) for r in rows], np.int64)


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The `size` most frequent words of all texts; ties go to the smaller word."""
    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                               pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        held: Counter = Counter()
        for batch in pieces(batches, 256):
            for text in batch.column("text").to_pylist():
                held.update((text or "").split())
            if len(held) > HELD_WORDS:
                yield counts()
                held = Counter()
        yield counts()

    counts = docs.select("text").mapInArrow(batches_of, "word string, n long")
    top = (counts.groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.col("n").desc(), "word").limit(size))
    return [r.word for r in top.collect()]


def _word_batches(chosen: list[str] | None):
    """Words and their counts, summed over some texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> pa.RecordBatch:
            words, at = np.unique(np.concatenate([*(w for w, _ in held), np.zeros(0, np.int64)]),
                                  return_inverse=True)
            n = np.bincount(at, np.concatenate([*(c for _, c in held), np.zeros(0)]), len(words))
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))],
                                              names=["word", "n"])

        hashes, held = _Hashes(chosen), []
        for batch in pieces(batches, CHUNK):
            held.append(np.unique(hashes.of(batch.column("text").to_pylist())[0], return_counts=True))
            if sum(len(w) for w, _ in held) > 4 * HELD_WORDS:
                yield counts()
                held = []
        yield counts()
    return run


def _ids(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Places in the dense tables; `hot` is sorted."""
    if not len(hot):
        return np.ones(len(words), np.int64)
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return np.where(hot[at] == words, at + 2, 1)


def _before(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The value before each token; 0, the edge, before a text's first."""
    before = np.concatenate(([0], values[:-1])) if len(values) else values
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    return before


def _count_batches(chosen: list[str] | None, hot: np.ndarray):
    """The dense tables: bigrams of hot words, the edge and, as number 1, all other words."""
    size = len(hot) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(chosen)
        target, all_ = np.zeros(size * size, np.int64), np.zeros(size * size, np.int64)
        for batch in pieces(batches, CHUNK):
            words, lengths = hashes.of(batch.column("text").to_pylist())
            flags = np.array(batch.column("target").to_pylist(), bool)
            ids = _ids(words, hot)
            keys = _before(ids, lengths) * size + ids
            all_ += np.bincount(keys, minlength=size * size)
            target += np.bincount(keys[np.repeat(flags, lengths)], minlength=size * size)
        at = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(target[at]), pa.array(all_[at])], names=["pair", "target", "n"])
    return run


def losses(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """-ln p(word | context) of a whole dense table, bigrams interpolated with add-one unigrams."""
    unigram = counts.sum(axis=0) + 1.0
    unigram /= unigram.sum()
    total = counts.sum(axis=1, keepdims=True)
    return -np.log((counts + smoothing * unigram) / (total + smoothing)).astype(np.float32)


class Model(NamedTuple):
    """What is known of a model in every task: its size, and the hot words' part."""

    entries: float         # tokens and vocabulary entries: what an add-one unigram is divided by
    unigram: np.ndarray    # of each place in the dense tables
    context: np.ndarray    # ln(uses as a context + SMOOTHING)
    joint: np.ndarray      # -ln(uses + SMOOTHING * unigram) of each bigram, by context and word


def model_of(counts: np.ndarray, entries: int) -> Model:
    whole = counts.sum() + entries
    unigram = (counts.sum(axis=0) + 1) / whole
    return Model(whole, unigram, np.log(counts.sum(axis=1) + SMOOTHING),
                 -np.log(counts + SMOOTHING * unigram).astype(np.float32))


_USES = "chunk long, part int, words binary, sizes binary, kinds binary, others binary, uses binary, " \
        "doc_id array<long>, n array<long>, sums array<double>"
_SUMS = "chunk long, texts binary, losses binary, doc_id array<long>, n array<long>, sums array<double>"
_FOUND = "doc_id long, n_tokens long, target_loss double, background_loss double"

_LONGS, _DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
_USES_SCHEMA = pa.schema([("chunk", pa.int64()), ("part", pa.int32())]
                         + [(c, pa.binary()) for c in ("words", "sizes", "kinds", "others", "uses")]
                         + [("doc_id", _LONGS), ("n", _LONGS), ("sums", _DOUBLES)])
_SUMS_SCHEMA = pa.schema([("chunk", pa.int64()), ("texts", pa.binary()), ("losses", pa.binary()),
                          ("doc_id", _LONGS), ("n", _LONGS), ("sums", _DOUBLES)])
_FOUND_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                           ("target_loss", pa.float64()), ("background_loss", pa.float64())])


def _use_batches(sent, chosen: list[str] | None, parts: int):
    """Each chunk's bigrams, by the partition of the word that is not hot.

    The words of a partition are in `words`, each with `sizes` uses. A use has
    the kind of the bigram's other word (its place in the dense tables, that
    plus AFTER, or COLD with its hash in `others`), and in `uses` the text's
    number in the chunk, whether the word is the text's last, and whether the
    text is a target document. One row of each chunk has the documents, with the
    sums of the losses known from the dense tables.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, models = sent.value
        hashes = _Hashes(chosen)
        first = TaskContext.get().partitionId() << 24
        for chunk, batch in enumerate(pieces(batches, CHUNK), first):
            words, lengths = hashes.of(batch.column("text").to_pylist())
            flags = np.array(batch.column("target").to_pylist(), np.int64)
            text = np.repeat(np.arange(len(lengths)), lengths)
            last = np.zeros(len(words), np.int64)
            last[(np.cumsum(lengths) - 1)[lengths > 0]] = 1
            ids = _ids(words, hot)
            context, before = _before(ids, lengths), _before(words, lengths)
            here, both = context != 1, (context != 1) & (ids != 1)
            sums = np.array([np.bincount(text[here], m.context[context[here]], len(lengths))
                             + np.bincount(text[both], m.joint[context[both], ids[both]], len(lengths))
                             for m in models])
            at = np.flatnonzero(~both)
            key = np.where(ids[at] == 1, words[at], before[at])
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            kind = np.where(ids[at] != 1, AFTER + ids[at], np.where(context[at] == 1, COLD, context[at]))
            use = (text[at] * 4 + last[at] * 2 + flags[text[at]]).astype(np.uint16)
            other, kind = before[at], kind.astype(np.uint16)
            begins = np.flatnonzero(np.diff(key, prepend=0))
            sizes = np.diff(begins, append=len(key)).astype(np.int32)
            part = (key - _LOW >> 31) * parts >> 31
            ends = np.searchsorted(part, np.arange(parts + 1))
            word_ends = np.searchsorted(part[begins], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                a, b, u, v = ends[p], ends[p + 1], word_ends[p], word_ends[p + 1]
                mine = p == chunk % parts
                if a == b and not mine:
                    continue
                cold = other[a:b][kind[a:b] == COLD]
                rows.append((chunk, p, key[begins[u:v]].tobytes(), sizes[u:v].tobytes(),
                             kind[a:b].tobytes(), cold.tobytes(), use[a:b].tobytes(),
                             batch.column("doc_id").to_pylist() if mine else None,
                             lengths.tolist() if mine else None, sums.ravel().tolist() if mine else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_USES_SCHEMA)],
                schema=_USES_SCHEMA)
    return run


def _joined(column: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _loss_batches(sent):
    """Losses of the bigrams in a partition, summed by document. All uses of its words are there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, models = sent.value
        held = pa.Table.from_batches(batches, _USES_SCHEMA)
        if not held.num_rows:
            return
        raw = {c: held.column(c).to_pylist() for c in held.column_names}
        key = np.repeat(_joined(raw["words"], np.int64), _joined(raw["sizes"], np.int32))
        kind, use = _joined(raw["kinds"], np.uint16), _joined(raw["uses"], np.uint16)
        other = kind.astype(np.int64)
        other[kind == COLD] = _joined(raw["others"], np.int64)
        slot = np.repeat(np.arange(held.num_rows) * CHUNK, [len(x) // 2 for x in raw["uses"]]) + (use >> 2)
        order = np.lexsort((other, key))
        key, other, kind, use, slot = key[order], other[order], kind[order], use[order], slot[order]
        new = np.diff(key, prepend=0) != 0
        word = np.cumsum(new) - 1
        pair = np.cumsum(new | (np.diff(other, prepend=0) != 0)) - 1
        after = (kind >= AFTER) & (kind != COLD)
        passes = ~after & (use & 2 == 0)                # the word is the next token's context
        sums = []
        for model, weight in zip(models, ((use & 1).astype(float), np.ones(len(use))), strict=True):
            joint = np.bincount(pair, weight)[pair] if len(pair) else weight
            own = (np.bincount(word, weight * ~after) + 1) / model.entries
            context = np.log(np.bincount(word, weight * passes) + SMOOTHING)
            unigram = own[word]
            unigram[after] = model.unigram[kind[after].astype(np.int64) - AFTER]
            loss = np.where(passes, context[word], 0.0) - np.log(joint + SMOOTHING * unigram)
            sums.append(np.bincount(slot, loss, held.num_rows * CHUNK))
        used = np.bincount(slot, minlength=held.num_rows * CHUNK) > 0
        for i, chunk in enumerate(raw["chunk"]):
            a = i * CHUNK
            texts = np.flatnonzero(used[a:a + CHUNK])
            found = np.array([s[a + texts] for s in sums], np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(
                    (chunk, texts.astype(np.uint16).tobytes(), found.tobytes(), raw["doc_id"][i],
                     raw["n"][i], raw["sums"][i]), _SUMS_SCHEMA, strict=True)], schema=_SUMS_SCHEMA)
    return run


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document, from all the sums of its chunk."""
    sums: dict[int, np.ndarray] = {}
    documents: dict[int, tuple[list, list]] = {}
    for batch in pieces(batches):
        for row in batch.to_pylist():
            held = sums.setdefault(row["chunk"], np.zeros((2, CHUNK)))
            texts = np.frombuffer(row["texts"], np.uint16)
            held[:, texts] += np.frombuffer(row["losses"], np.float32).reshape(2, -1)
            if row["doc_id"] is not None:
                documents[row["chunk"]] = row["doc_id"], row["n"]
                held[:, :len(row["n"])] += np.reshape(row["sums"], (2, -1))
    for chunk, (ids, n) in documents.items():
        means = sums[chunk][:, :len(n)] / np.maximum(n, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *map(pa.array, means)],
            schema=_FOUND_SCHEMA)


def _flagged(spark: SparkSession, rows: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, text, target): few target ids go to the texts; else both meet in a shuffle, once."""
    wanted = written(spark, target_ids.select(F.col("doc_id").cast("long").alias("t"))
                     .where("t IS NOT NULL").distinct(), "lm-targets")
    small = wanted.count() <= SMALL_IDS
    found = rows.join(F.broadcast(wanted) if small else wanted, rows["doc_id"] == wanted["t"], "left") \
        .select("doc_id", "text", F.col("t").isNotNull().alias("target"))
    return found if small else written(spark, found, "lm")


def cross_entropy_difference(spark: SparkSession, docs: DataFrame, target_ids: DataFrame, *,
                             id_col: str = "doc_id", text_col: str = "text",
                             size: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) of every row of `docs`.

    `target_ids.doc_id` names the target documents. The difference is target
    minus background loss per token: the lower, the more like the target. Null,
    empty and blank texts have no token and a difference of 0; null ids are
    never target documents; without target documents the target model is
    uniform. An empty table gives no rows.

    Every word has an entry of its own, unless `size` asks for the most
    frequent ones only, with one entry for all others.

    What is shuffled: the documents, if the target ids are more than SMALL_IDS
    (fewer are broadcast, eight bytes each); words with their counts in each task; and each bigram that isn't of hot words alone, about
    ten bytes a use, then its losses, summed by document and partition. Besides
    such ids, only the hot words' dense tables are broadcast. A partition of bigrams is held by its
    task, so `spark.sql.shuffle.partitions` has to grow with the corpus.
    """
    ship_package(spark)
    rows = documents_input(docs, id_col, text_col)
    chosen = None if size is None else vocabulary(rows, size)
    flagged = _flagged(spark, rows, target_ids)
    counts = flagged.select("text").mapInArrow(_word_batches(chosen), "word long, n long")
    words = written(spark, counts.groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    entries = (words.count() if chosen is None else len(chosen)) + 2
    hot = np.sort(np.array([r.word for r in words.orderBy(F.col("n").desc(), "word")
                            .limit(HOT_WORDS).collect()], np.int64))
    n = len(hot) + 2
    dense = (flagged.select("text", "target").mapInArrow(
        _count_batches(chosen, hot), "pair long, target long, n long")
        .groupBy("pair").agg(F.sum("target").alias("target"), F.sum("n").alias("n")).toPandas())
    tables = np.zeros((2, n * n))
    tables[:, dense["pair"]] = dense[["target", "n"]].to_numpy().T
    models = tuple(model_of(t.reshape(n, n), entries) for t in tables)
    sent = spark.sparkContext.broadcast((hot, models))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (flagged.mapInArrow(_use_batches(sent, chosen, parts), _USES)
             .repartitionById(parts, F.col("part"))
             .mapInArrow(_loss_batches(sent), _SUMS)
             .repartition(parts, "chunk")
             .mapInArrow(_sum_batches, _FOUND))
    return found.withColumn("difference", F.col("target_loss") - F.col("background_loss"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; the target are those labelled good and not toxic."""
    target = read_table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return cross_entropy_difference(spark, read_table(spark, sf_dir, "documents"), target)
