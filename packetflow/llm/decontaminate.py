"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

1. Every document becomes a row of term numbers. The terms are the words of
   the benchmark; all other words share number 0 (they can match no item).
2. Texts are cut into steps of 16 words; two steps on end are a passage, so
   passages overlap by half. The terms' frequencies are counted over the steps
   of all documents.
3. A distributed randomised SVD of the TF-IDF passage matrix A: each task adds
   up its part of A'(A G) for a random G, the sums meet in one small matrix,
   whose orthonormal basis spans the latent space (one subspace iteration).
   The items' own passages are rows of A too, weighted up to the mass of the
   documents' passages, so that their rare words shape the space.
4. Items and passages are projected; a passage is a candidate for the items
   whose cosine in the latent space reaches a bound.
5. A candidate counts as found if the longest common subsequence of the item's
   words with the text around the passage covers enough of the item (within a
   stretch not much longer than it), and enough of the item's answer: its last
   words, taken alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import documents_input, pieces, read_table, ship_package, written

RANK = 64                  # dimensions of the latent space
STEP = 16                  # words of a step; a passage has two
MIN_COSINE = 0.7           # of a candidate, in the latent space
MIN_MASS = 0.6             # of a candidate's component along the item, by the item's own length
MIN_WEIGHT = 0.5           # of a candidate's summed term weights, by the item's own
MIN_COVERED = 0.75         # share of the item's words in common order
MAX_STRETCH = 1.5          # length of the matched text by that of the item
ANSWER_WORDS = 8           # the item's last words count as its answer
MIN_ANSWER = 0.5           # share of them in common order
MAX_ITEM_WORDS = 200_000   # of a block of items, which is broadcast
SEED = 7

# ASCII characters other than letters and digits separate words.
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits, as UTF-8."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


class Benchmark(NamedTuple):
    """Items as term numbers (from 1), by the place of each term in `terms`."""

    terms: dict[bytes, int]
    item_ids: list[int | None]
    items: list[np.ndarray]


def load_benchmark(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                   block_words: int = MAX_ITEM_WORDS) -> Iterator[Benchmark]:
    """The benchmark in blocks of at most so many words (or of one item); items without words are left out."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    block, size = Benchmark({}, [], []), 0
    for row in rows.orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        words = words_of(row.text)
        if not words:
            continue
        if block.items and size + len(words) > block_words:
            yield block
            block, size = Benchmark({}, [], []), 0
        size += len(words)
        block.item_ids.append(row.item_id)
        block.items.append(np.array([block.terms.setdefault(w, len(block.terms) + 1) for w in words],
                                    np.int32))
    if block.items:
        yield block


def _encode_batches(sent):
    schema = pa.schema([("doc_id", pa.int64()), ("terms", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.terms.get
        for batch in pieces(batches, 256):
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                rows.append(np.fromiter(map(get, words, repeat(0)), np.int32,
                                        len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())],
                                             schema=schema)
    return run


def encode(spark: SparkSession, docs: DataFrame, sent) -> DataFrame:
    """(doc_id, terms): each document's words as int32 term numbers, in a written table."""
    rows = docs.mapInArrow(_encode_batches(sent), "doc_id long, terms binary")
    return written(spark, rows, "decontaminate")


class Steps(NamedTuple):
    """The benchmark's terms in some texts, by step; an empty step follows each text's last one."""

    terms: np.ndarray      # one entry for each word that is a term
    step: np.ndarray       # its step, ascending
    first: np.ndarray      # the first step of each text, and the number of all steps at the end
    texts: list[np.ndarray]


def steps_of(texts: list[np.ndarray]) -> Steps:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(-(-lengths // STEP) + 1)))
    flat = np.concatenate([*texts, np.zeros(0, np.int32)])
    begins = np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = np.repeat(first[:-1], lengths) + (np.arange(len(flat)) - begins) // STEP
    held = np.flatnonzero(flat)
    return Steps(flat[held], step[held], first, texts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Steps]]:
    for batch in pieces(batches, 64):
        raw = batch.column("terms").to_pylist()
        yield batch, steps_of([np.frombuffer(r, np.int32) for r in raw])


def passage_vectors(steps: Steps, weighted: np.ndarray) -> np.ndarray:
    """Sum of the term vectors of each step and the one after it."""
    out = np.zeros((int(steps.first[-1]), weighted.shape[1]), weighted.dtype)
    if len(steps.terms):
        first = np.flatnonzero(np.diff(steps.step, prepend=-1))
        out[steps.step[first]] = np.add.reduceat(weighted[steps.terms], first, axis=0)
        out[:-1] += out[1:]
    return out


def passage_weights(steps: Steps, weight: np.ndarray) -> np.ndarray:
    """Summed weight of the terms of each step and the one after it."""
    out = np.bincount(steps.step, weight[steps.terms], minlength=int(steps.first[-1]))
    out[:-1] += out[1:]
    return out


def _frequency_batches(size: int):
    """Steps that hold each term; term 0 stands for the number of steps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for _, steps in _chunks(batches):
            found[0] += steps.first[-1] - len(steps.texts)
            keys = np.sort(steps.step * size + steps.terms)
            found += np.bincount(keys[np.diff(keys, prepend=-1) > 0] % size, minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["term", "n"])
    return run


def idf_of(encoded: DataFrame, size: int) -> np.ndarray:
    """log((steps + 1) / (steps with the term + 1)), squared; 0 for words outside the benchmark.

    Squared, since the latent space keeps all of the common words' directions
    but a part of the many rare ones.
    """
    counts = (encoded.select("terms").mapInArrow(_frequency_batches(size), "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    found = np.zeros(size)
    found[counts["term"].to_numpy()] = counts["n"].to_numpy()
    weight = np.log((found[0] + 1) / (found + 1)) ** 2
    weight[0] = 0
    return weight.astype(np.float32)


def sketch_part(steps: Steps, idf: np.ndarray, weighted: np.ndarray, total: np.ndarray) -> float:
    """Add these texts' part of A'(A G) to `total`; returns the squared norm of their part of A."""
    if not len(steps.terms):
        return 0.0
    passages = passage_vectors(steps, weighted)
    passages[1:] += passages[:-1].copy()     # the two passages that a step lies in
    # Two-byte keys are sorted by radix.
    keys = steps.terms.astype(np.uint16) if len(idf) < 65536 else steps.terms
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(steps.terms[order], prepend=-1))
    at = steps.terms[order][first]
    total[at] += np.add.reduceat(passages[steps.step[order]], first, axis=0) * idf[at, None]
    return float(2 * np.square(idf[steps.terms]).sum())


def _sketch_batches(sent):
    """This task's part of A'(A G): one row a term; term 0 has the squared norm of its part of A."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = sent.value
        weighted = idf[:, None] * basis
        total = np.zeros(basis.shape, np.float64)
        for _, steps in _chunks(batches):
            total[0, 0] += sketch_part(steps, idf, weighted, total)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(list(total[at]), pa.list_(pa.float64()))], names=["term", "row"])
    return run


def latent_basis(spark: SparkSession, encoded: DataFrame, idf: np.ndarray, rank: int,
                 items: list[np.ndarray]) -> np.ndarray:
    """Orthonormal basis (terms x rank) of the leading right singular space of the passage matrix."""
    size = len(idf)
    rank = min(rank, size)
    start = np.random.default_rng(SEED).standard_normal((size, rank)).astype(np.float32)
    sent = spark.sparkContext.broadcast((idf, start))
    sums = ", ".join(f"sum(row[{i}])" for i in range(rank))
    rows = (encoded.select("terms").mapInArrow(_sketch_batches(sent), "term long, row array<double>")
            .groupBy("term").agg(F.expr(f"array({sums})").alias("row")).collect())
    sketch = np.zeros((size, rank))
    for row in rows:
        sketch[row.term] = row.row
    return finished_basis(sketch, idf, start, items)


def finished_basis(sketch: np.ndarray, idf: np.ndarray, start: np.ndarray,
                   items: list[np.ndarray]) -> np.ndarray:
    mass, sketch[0] = sketch[0, 0], 0
    own = np.zeros_like(sketch)
    own_mass = sketch_part(steps_of(items), idf, idf[:, None] * start, own)
    # Both parts count alike; the items' rows are few, so each has a weight.
    whole = sketch / max(mass, 1.0) + own / max(own_mass, 1.0)
    basis, _ = np.linalg.qr(whole)
    return basis.astype(np.float32)


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[int, int] = {}
    for i, term in enumerate(item.tolist()):
        places[term] = places.get(term, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for term in text.tolist():
        hit = places.get(term)
        if hit:
            u = row & hit
            row = (row + u | row - u) & full
    return len(item) - row.bit_count()


def covered(item: np.ndarray, text: np.ndarray, min_covered: float = MIN_COVERED,
            min_answer: float = MIN_ANSWER) -> tuple[float, float]:
    """Shares of the item's words, and of its answer's, in common order with the text.

    The text is searched in overlapping stretches of MAX_STRETCH item lengths,
    the last of which ends with the text. The best stretch counts, so that
    common words far apart don't add up: of those that reach both bounds, if
    there are any, else of all.
    """
    n = len(item)
    length = max(int(MAX_STRETCH * n), n + 4)
    answer = item[-ANSWER_WORDS:]
    best = (False, 0.0, 0.0)
    last = max(len(text) - length, 0)
    for at in (*range(0, last, max(length // 6, 1)), last):
        part = text[at:at + length]
        share = common_subsequence(item, part) / n
        if share >= min_covered or share > best[1]:
            own = common_subsequence(answer, part) / len(answer)
            best = max(best, (share >= min_covered and own >= min_answer, share, own))
    return best[1:]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _search_batches(sent, min_cosine: float, min_covered: float, min_answer: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item", pa.int32()), ("cosine", pa.float64()),
                        ("covered", pa.float64()), ("answer", pa.float64())])

    def verified(items, texts, pairs, held) -> Iterator[tuple]:
        """Candidates (text, item, word) -> cosine, one stretch of neighbouring passages at a time."""
        best: dict[tuple[int, int], tuple] = {}
        done: dict[tuple[int, int], int] = {}
        for (text, item, word), cosine in sorted(pairs.items()):
            words, n = texts[text], len(items[item])
            span = int(MAX_STRETCH * n)
            low, high = max(word - span, 0), word + 2 * STEP + span
            if done.get((text, item), -1) >= high:
                continue            # the stretch before has looked this far
            high += 4 * STEP
            done[text, item] = high
            part = words[low:high]
            # Words in common at all bound those in common order.
            held[part] = True
            common = held[items[item]].mean()
            held[part] = False
            if common < min_covered:
                continue
            share, answer = covered(items[item], part, min_covered, min_answer)
            if share >= min_covered and answer >= min_answer and \
                    share > best.get((text, item), (0, 0))[1]:
                best[text, item] = (cosine, share, answer)
        for (text, item), found in best.items():
            yield text, item, *found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, idf, basis = sent.value
        weighted = idf[:, None] * basis
        # An item is searched for by each of its own passages, whatever its length.
        own = steps_of(items)
        queries = passage_vectors(own, weighted)
        owner = np.searchsorted(own.first, np.arange(len(queries)), side="right") - 1
        # Of each item, the passages that hold most of its weight are searched for.
        mass = passage_weights(own, idf)
        heaviest = np.maximum.reduceat(mass, own.first[:-1]) if len(mass) else mass
        used = mass > np.maximum(0.6 * heaviest[owner], 1e-9)
        queries, owner = queries[used], owner[used]
        length = np.linalg.norm(queries, axis=1)
        queries = _unit(queries).T.copy()
        held = np.zeros(len(idf), bool)
        least = MIN_WEIGHT * mass[used].min() if used.any() else np.inf
        for batch, steps in _chunks(batches):
            live = passage_weights(steps, idf) >= least
            near_live = live.copy()
            near_live[1:] |= live[:-1]
            kept = near_live[steps.step]
            rows = np.flatnonzero(live)
            vectors = passage_vectors(steps._replace(
                terms=steps.terms[kept], step=steps.step[kept]), weighted)[rows]
            needed = min_cosine * np.linalg.norm(vectors, axis=1) + 1e-12
            pairs: dict[tuple[int, int, int], float] = {}
            for at in range(0, len(vectors), 4096):
                near = vectors[at:at + 4096] @ queries
                window, query = np.nonzero(
                    (near >= needed[at:at + 4096, None]) & (near >= MIN_MASS * length))
                passage = rows[window + at]
                text = np.searchsorted(steps.first, passage, side="right") - 1
                word = (passage - steps.first[text]) * STEP
                for key, cosine in zip(zip(text.tolist(), owner[query].tolist(), word.tolist()),
                                       (near[window, query] / needed[window + at]).tolist(),
                                       strict=True):
                    pairs[key] = max(pairs.get(key, 0.0), cosine * min_cosine)
            docs = batch.column("doc_id").to_pylist()
            out = [(docs[t], *rest) for t, *rest in verified(items, steps.texts, pairs, held)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *,
               id_col: str = "doc_id", text_col: str = "text", rank: int = RANK,
               min_cosine: float = MIN_COSINE, min_covered: float = MIN_COVERED,
               min_answer: float = MIN_ANSWER, block_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """(doc_id, item_id, cosine, covered, answer): the items found in each row of `docs`.

    Null and empty texts hold no item, items without words are found nowhere;
    rows of one id are looked at one by one and each gives its own rows; null
    ids stay null. An empty table or benchmark gives no rows. The items are
    gone through in blocks of `block_words`, each with a latent space and a
    search of its own. Only a block and matrices of (its terms x rank) are
    broadcast; texts are never shuffled. Terms are counted in, the latent space
    is fitted on, and passages are searched in all documents.
    """
    ship_package(spark)
    rows = documents_input(docs, id_col, text_col)
    found = [_find_block(spark, rows, bench, rank, min_cosine, min_covered, min_answer)
             for bench in load_benchmark(benchmark, block_words=block_words)]
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, "
                                         "covered double, answer double")
    return reduce(DataFrame.unionAll, found)


def _find_block(spark: SparkSession, rows: DataFrame, bench: Benchmark, rank: int, min_cosine: float,
                min_covered: float, min_answer: float) -> DataFrame:
    sc = spark.sparkContext
    encoded = encode(spark, rows, sc.broadcast(bench))
    size = len(bench.terms) + 1
    idf = idf_of(encoded, size)
    basis = latent_basis(spark, encoded, idf, rank, bench.items)
    search = _search_batches(sc.broadcast((bench.items, idf, basis)), min_cosine, min_covered,
                             min_answer)
    found = encoded.mapInArrow(
        search, "doc_id long, item int, cosine double, covered double, answer double")
    ids = F.lit(bench.item_ids) if None not in bench.item_ids else \
        F.array(*(F.lit(i).cast("long") for i in bench.item_ids))
    return found.select("doc_id", F.get(ids, F.col("item")).cast("long").alias("item_id"), "cosine", "covered",
                        "answer")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold, word for word or paraphrased."""
    return find_leaks(spark, read_table(spark, sf_dir, "documents"),
                      read_table(spark, sf_dir, "benchmark"))
