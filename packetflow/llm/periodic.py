"""Periodic runs of words: seeds on diagonals, extended once for each lag.

A run is a maximal stretch of words in which words `q` apart are identical, q
being its smallest period, of at least max(MIN_WORDS, 3q) words. Compared with
itself q words later it matches over length - q words, so over 16 at least, and
over 2q at least. For the lags in (B, 2B] an index of B-grams therefore has, in
every run, a seed at one of its anchors (every (B + 3)th word): the pair of an
anchor and an occurrence of the same B-gram q words further. Seeds are extended
along their diagonal; a table holds for each lag how far it is covered, so that
further seeds there are passed over.

Words of one document only are compared, in the task that reads it; nothing is
shuffled. Seeds come from 64-bit hashes of grams, but extension compares the
words themselves, so a collision costs time and changes nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from packetflow.llm.common import documents_input, read_table, ship_package

MIN_WORDS = 24             # least length of a run
MIN_PERIODS = 3            # and least length in periods
SHORT = 8                  # lags up to here share one index, of SHORT-grams
CHUNK_BYTES = 1 << 21      # texts that a task looks at together
PAIRS = 1 << 20            # seeds that are held at once

OUT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("period", T.LongType())]))),
    T.StructField("collapsed", T.StringType()),
])

# Of a document's id and number of words: the tail that repeats, as (start, period), or None.
Arrange = Callable[[int | None, int], tuple[int, int] | None]


def _words(texts: list[bytes]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of all texts, one after another, and the number in each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.flatnonzero(white & ~np.concatenate(([True], white[:-1])))   # the blank after a word
    letters = np.cumsum(~white)[last]
    offsets = np.concatenate(([0], letters)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(last), pa.py_buffer(offsets),
                                             pa.py_buffer(data[~white]))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(last, ends), prepend=0)


def _grams(ids: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the `length` words from each position; shorter at the end."""
    rng = np.random.default_rng(length)
    out = np.zeros(len(ids) - length + 1, np.uint64)
    for j, factor in enumerate(rng.integers(1, 1 << 62, length, dtype=np.uint64) * 2 + 1):
        out += _mixed(ids[j:len(ids) - length + 1 + j].astype(np.uint64)) * factor
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _repeated(places: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose name occurs again, with the names' ranks, in the order of (name, place)."""
    order = np.argsort(names, kind="stable")
    sorted_ = names[order]
    new = np.concatenate(([True], sorted_[1:] != sorted_[:-1])) if len(names) else np.zeros(0, bool)
    rank = np.cumsum(new) - 1
    often = np.bincount(rank, minlength=1)[rank] > 1 if len(rank) else new
    return places[order][often], rank[often]


def _doubled(places: np.ndarray, ranks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """From the repeated `length`-grams, in order of place, to those twice as long."""
    order = np.argsort(places)
    places, ranks = places[order], ranks[order]
    at = np.searchsorted(places, places + length)
    at[at == len(places)] = 0
    both = places[at] == places + length
    first, second = ranks[both], ranks[at[both]]
    return _repeated(places[both], first * np.int64(ranks.max(initial=0) + 1) + second)


class _Runs:
    """The runs of a sequence of numbers in which separators occur only once."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.found: list[tuple[int, int, int]] = []       # start, end, period
        self.spans: set[tuple[int, int]] = set()
        self.cover: tuple[np.ndarray, ...] | None = None

    def extend(self, at: int, lag: int) -> tuple[int, int]:
        """The longest stretch around `at` over which words equal those `lag` further."""
        ids, size = self.ids, len(self.ids)
        end, step = at, 32
        while end < size - lag:
            stop = min(end + step, size - lag)
            differ = np.flatnonzero(ids[end:stop] != ids[end + lag:stop + lag])
            if len(differ):
                end += int(differ[0])
                break
            end, step = stop, step * 2
        start, step = at, 32
        while start > 0:
            stop = max(start - step, 0)
            differ = np.flatnonzero(ids[stop:start] != ids[stop + lag:start + lag])
            if len(differ):
                start = stop + int(differ[-1]) + 1
                break
            start, step = stop, step * 2
        return start, end

    def diagonal(self, lag: int, anchors: np.ndarray) -> None:
        """Extend the seeds at `anchors`, in rising order, passing over what is covered."""
        anchors, i = anchors.tolist(), 0
        while i < len(anchors):
            start, end = self.extend(anchors[i], lag)
            if end + lag - start >= max(MIN_WORDS, MIN_PERIODS * lag):
                span = (start, end + lag)
                # The same stretch with a smaller period is found before: that period divides this lag.
                if span not in self.spans:
                    self.spans.add(span)
                    self.found.append((*span, lag))
            i = bisect_left(anchors, max(end, anchors[i] + 1), i + 1)

    def seeds(self, places: np.ndarray, ranks: np.ndarray, low: int, high: int, length: int,
              apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(anchor, lag) of equal `length`-grams, the lag in (low, high], some at a time.

        `places` and `ranks` are in the order of (rank, place).
        """
        width = np.int64(len(self.ids) + 2 * high + 2)
        keys = ranks * width + places
        anchors = np.flatnonzero(places % apart == 0)
        first = np.searchsorted(keys, keys[anchors] + low + 1)
        count = np.searchsorted(keys, keys[anchors] + high + 1) - first
        anchors, first, count = anchors[count > 0], first[count > 0], count[count > 0]
        done = np.concatenate(([0], np.cumsum(count)))
        for block in range(int(done[-1]) // PAIRS + 1):
            mine = slice(*np.searchsorted(done[1:], [block * PAIRS, (block + 1) * PAIRS], "right"))
            n = count[mine]
            at = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            anchor = np.repeat(places[anchors[mine]], n)
            yield self.worth(anchor, places[at] - anchor, length)

    def worth(self, anchor: np.ndarray, lag: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Without the seeds within short-period runs that can't lead to a run.

        A gram of `length` words with a period of a third of it at most lies in
        one run of that period. Its occurrences in the same run are multiples
        of the period apart and give that run again. For those in another run,
        the diagonal ends where either run ends, before it is long enough,
        unless the two runs start, or end, just that lag apart.
        """
        if self.cover is None or not len(anchor):
            return anchor, lag
        starts, ends, periods = self.cover
        short = (periods <= length // 3) & (ends - starts >= length)   # no two of them share a gram
        starts, ends = starts[short], ends[short]
        if not len(starts):
            return anchor, lag

        def run_of(at):
            i = np.searchsorted(starts, at, "right") - 1
            return np.where((i >= 0) & (ends[i] >= at + length), i, -1)

        a, b = run_of(anchor), run_of(anchor + lag)
        keep = (a < 0) | (b < 0) | ((a != b) & ((starts[b] - starts[a] == lag)
                                                | (ends[b] - ends[a] == lag)))
        return anchor[keep], lag[keep]

    def search(self, longest: int) -> None:
        """Find all runs; no document has over `longest` words."""
        if longest < MIN_WORDS or len(self.ids) < SHORT:
            return
        places, ranks = _repeated(np.arange(len(self.ids) - SHORT + 1), _grams(self.ids, SHORT))
        low, high, length = 0, SHORT, SHORT
        while len(places) and MIN_PERIODS * (low + 1) <= longest:
            lags: dict[int, list[np.ndarray]] = {}
            for anchor, lag in self.seeds(places, ranks, low, high, length,
                                          SHORT + 1 if low == 0 else low + 3):
                order = np.lexsort((anchor, lag))
                lag, anchor = lag[order], anchor[order]
                for of, part in zip(*_split(lag, anchor)):
                    lags.setdefault(int(of), []).append(part)
            for of in sorted(lags):
                self.diagonal(of, np.unique(np.concatenate(lags[of])))
            if self.found:
                runs = np.array(sorted(self.found), np.int64)
                self.cover = runs[:, 0], runs[:, 1], runs[:, 2]
            low, high = high, 2 * high
            if low > length:
                places, ranks = _doubled(places, ranks, length)
                length *= 2


def _split(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of sorted keys: each once, and its values."""
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
    return keys[new], np.split(values, new[1:]) if len(keys) else []


def _tails(doc_ids: list, counts: np.ndarray, arrange: Arrange) -> np.ndarray:
    """For each word place of the arranged documents, which word stands there."""
    source = np.arange(counts.sum())
    begin = np.cumsum(counts) - counts
    for doc, n, at in zip(doc_ids, counts.tolist(), begin.tolist()):
        tail = arrange(doc, n)
        if tail is not None:
            start, period = tail
            source[at + start:at + n] = at + start + np.arange(n - start) % period
    return source


def runs_of(doc_ids: list, texts: list[bytes], arrange: Arrange | None = None) -> Iterator[tuple]:
    """(doc_id, n_words, runs by start and period, collapsed text) of each text."""
    words, counts = _words(texts)
    if arrange is not None:
        words = words.take(pa.array(_tails(doc_ids, counts, arrange)))
    begin = np.cumsum(counts) - counts
    total, docs = len(words), len(texts)
    coded = words.dictionary_encode()
    # A separator of its own follows each document.
    ids = np.empty(total + docs, np.int64)
    shift = np.repeat(np.arange(docs), counts)
    ids[np.arange(total) + shift] = coded.indices.to_numpy(zero_copy_only=False)
    ids[begin + counts + np.arange(docs)] = len(coded.dictionary) + np.arange(docs)
    found = _Runs(ids)
    found.search(int(counts.max(initial=0)))

    gone = np.zeros(total + 1, np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(docs)]
    starts = begin + np.arange(docs)
    for start, end, period in sorted(found.found, key=lambda r: (r[0], r[2])):
        doc = int(np.searchsorted(starts, start, "right")) - 1
        runs[doc].append((start - int(starts[doc]), end - start, period))
        gone[start - doc + period] += 1
        gone[end - doc] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    ends = np.concatenate(([0], np.cumsum(kept)))[np.concatenate((begin, [total]))]
    lists = pa.LargeListArray.from_arrays(pa.array(ends), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
    for doc in range(docs):
        yield doc_ids[doc], int(counts[doc]), runs[doc], collapsed[doc]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, some CHUNK_BYTES at a time; a longer text alone."""
    ids, texts, held = [], [], 0
    column = batch.column(1).cast(pa.binary())
    for i, doc in enumerate(batch.column(0).to_pylist()):
        text = column[i].as_py() or b""
        if held and held + len(text) > CHUNK_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(doc)
        texts.append(text)
        held += len(text) + 1
    if ids:
        yield ids, texts


def periodic_runs(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text", arrange: Arrange | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of `docs`.

    `runs` has each run's start, length and period in words, by start and
    period. `collapsed` is the text's words, joined by one blank, without those
    that a run holds after its first `period` words. `arrange` may say of a
    document that its words repeat from some place on; it is then taken so.

    A null, empty or blank text has no words and no runs. A null id stays null.
    Rows are looked at one by one, so rows that repeat an id or a text each get
    their own answer. Other columns are left behind, whatever their names. An
    empty table gives no rows. A text is never split: a task holds some twenty
    numbers a word of its longest one. Time is of the order of n log n words
    however the words repeat, since lags in (B, 2B] take one index and
    occurrences of a gram that are closer than a third of its length are in
    one run, which is extended once.
    """
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for ids, texts in _chunks(batch):
                rows = list(runs_of(ids, texts, arrange))
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r[2]]
                              for r in rows], RUNS),
                    pa.array([r[3] for r in rows], pa.large_string()).cast(pa.string())],
                    names=OUT.fieldNames())

    return documents_input(docs, id_col, text_col).mapInArrow(run, OUT)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The query's rule: every tenth document by crc32 repeats from some word on.

    A null id has no decimal form, so its words stay.
    """
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


DIGEST = T.StructType([
    *(T.StructField(c, T.LongType()) for c in (
        "doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli")),
    T.StructField("runs_sha256", T.StringType(), False),
    T.StructField("collapsed_sha256", T.StringType(), False),
])


def digests(found: DataFrame) -> DataFrame:
    """One row for each of `periodic_runs`: its strongest run, and checksums."""
    def run(batches):
        for batch in batches:
            out = []
            texts = batch.column(3).cast(pa.binary())
            for i in range(batch.num_rows):
                runs = [(r["start"], r["length"], r["period"]) for r in batch.column(2)[i].as_py()]
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                best = None
                for s, n, q in runs:      # by start, then period: only a greater exponent replaces
                    if best is None or n * best[2] > best[1] * q:
                        best = s, n, q
                out.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), len(runs),
                            *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                            hashlib.sha256(lines.encode()).hexdigest(),
                            hashlib.sha256(texts[i].as_py()).hexdigest()))
            columns = zip(*out) if out else [[]] * len(DIGEST)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if f.name.endswith("sha256") else pa.int64())
                 for c, f in zip(columns, DIGEST)], names=DIGEST.fieldNames())

    return found.mapInArrow(run, DIGEST)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, strongest run and checksums of every document's words, tails repeated."""
    found = periodic_runs(spark, read_table(spark, sf_dir, "documents"), arrange=repeated_tail)
    return digests(found)
