"""Token ids in wavelet-matrix shards: one compressed container for each run of documents.

A shard holds the ids of consecutive documents (ascending doc_id) as succinct
bit-planes with rank and select, so that single tokens, counts and occurrences
are read from it without decoding the rest. Shards are rows of a Parquet table
that Spark writes and commits: a lost executor or a repeated task leaves no
torn file, and any store that Spark reaches can hold them.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.llm.common import (documents_input, pieces, read_table, run_folder, ship_package)

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 18       # a shard is closed once it holds as many ids
CHUNK_CHARS = 1 << 22        # texts whose units are numbered together
SPLIT_BYTES = 1 << 20        # texts that are split together
CACHE_PIECES = 120_000       # of a generation of tokenised units that a Python worker keeps

SHARD_SCHEMA = ("part int, seq int, part_start long, doc_ids array<long>, doc_tokens array<long>, "
                "wavelet binary")
_HEADER = struct.Struct("<4sBxxxQ")
_MAGIC = b"WMX2"
_BLOCK = 512                 # bits between two rank samples
_RANK = np.dtype("<u4")      # of a rank sample: a text of 2 GB, Arrow's limit, has fewer ids


class WaveletMatrix:
    """Bit-planes of a sequence, most significant first, each stably sorted by the plane above.

    The file form is a header, the rank samples of every plane (the set bits
    before every 512th bit, and in all) and the planes. Reading it copies
    nothing: an access or a rank touches one sample and at most 64 bytes of
    each plane.
    """

    def __init__(self, planes: list[np.ndarray], ranks: list[np.ndarray], length: int):
        self.planes, self.ranks, self.length = planes, ranks, length      # packed, little bit order
        self.zeros = [length - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.ascontiguousarray(ids)
        bits = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        planes, ranks = [], []
        for bit in range(bits - 1, -1, -1):
            one = ids & ids.dtype.type(1 << bit) != 0
            ones = np.flatnonzero(one)
            planes.append(np.packbits(one, bitorder="little"))
            ranks.append(np.searchsorted(ones, cls._sampled(len(ids))).astype(_RANK))
            ids = np.concatenate((ids.take(np.flatnonzero(~one)), ids.take(ones)))
        return cls(planes, ranks, len(ids))

    @staticmethod
    def _sampled(length: int) -> np.ndarray:
        """The positions before which set bits are counted: each block's start, and the end."""
        return np.append(np.arange(0, length, _BLOCK), length)

    def to_bytes(self) -> bytes:
        return b"".join([_HEADER.pack(_MAGIC, len(self.planes), self.length),
                         *(r.tobytes() for r in self.ranks), *(p.tobytes() for p in self.planes)])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, bits, length = _HEADER.unpack_from(data)
        step, samples = (length + 7) // 8, -(-length // _BLOCK) + 1
        start = _HEADER.size + bits * samples * _RANK.itemsize
        if magic != _MAGIC or len(data) != start + bits * step:
            raise ValueError("not a wavelet matrix")
        ranks = np.frombuffer(data, _RANK, bits * samples, _HEADER.size).reshape(bits, samples)
        planes = np.frombuffer(data, np.uint8, bits * step, start).reshape(bits, step)
        return cls(list(planes), list(ranks), length)

    def decode(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane up."""
        values = np.zeros(self.length, np.uint32 if len(self.planes) > 16 else np.uint16)
        one_ = values.dtype.type(1)
        for depth, plane in enumerate(reversed(self.planes)):
            one = np.unpackbits(plane, count=self.length, bitorder="little").view(bool)
            ones = np.flatnonzero(one)
            zeros = self.length - len(ones)
            above = np.empty_like(values)
            above[np.flatnonzero(~one)] = values[:zeros]
            above[ones] = values[zeros:] | (one_ << values.dtype.type(depth))
            values = above
        return values

    def _rank1(self, level: int, at: int) -> int:
        """Set bits of a plane before position `at`."""
        block = at // _BLOCK
        start, whole = block * _BLOCK // 8, at // 8
        count = int(self.ranks[level][block])
        count += int(np.bitwise_count(self.planes[level][start:whole]).sum())
        if at % 8:
            count += (int(self.planes[level][whole]) & ((1 << at % 8) - 1)).bit_count()
        return count

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Position of the nth (from 0) bit of that value in a plane."""
        low, high = 0, self.length
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > nth:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        value = 0
        for level, plane in enumerate(self.planes):
            one = int(plane[at // 8]) >> (at % 8) & 1
            value = value << 1 | one
            ones = self._rank1(level, at)
            at = self.zeros[level] + ones if one else at - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of `value` before `end` lie below the last plane."""
        low, high = 0, end
        for level in range(len(self.planes)):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if value >> (len(self.planes) - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id before a position (rank)."""
        if value < 0 or value >> len(self.planes):
            return 0
        low, high = self._range(value, self.length if end is None else end)
        return high - low

    def find(self, value: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of an id (select); -1 if there is none."""
        if not 0 <= nth < self.count(value):
            return -1
        at = self._range(value, self.length)[0] + nth
        for level in range(len(self.planes) - 1, -1, -1):
            if value >> (len(self.planes) - 1 - level) & 1:
                at = self._select(level, 1, at - self.zeros[level])
            else:
                at = self._select(level, 0, at)
        return at


# What may follow a word in a piece: ASCII signs other than apostrophe and <.
_SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
# Texts with other letters, special tokens or separator controls are not simplified.
_ODD = re.compile(r"[\x1c-\x1f\u0250-\U0010ffff]|<\|")
_RARE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


def _is_odd(text: str) -> bool:
    """Whether `_ODD` is found in a text; most texts are Latin-1, where searching for bytes tells."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ODD.search(text) is not None
    return any(x in text for x in _RARE)


class PieceEncoder:
    """Ids of texts, from the tokenizers library, each distinct piece encoded once.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its pieces between white space in turn. A word of letters
    followed by signs (without apostrophe, digits or <) is split there by the
    tokenizer as well, and it ignores letter case; such pieces are put together
    from their parts. Its normalizer and splitter leave a word of lower-case
    letters below U+0250 as it is (such letters are composed already), so these
    words go to the library's model at once, in its byte alphabet; all else
    goes through the whole tokenizer. `tests/llm` holds this against whole-text
    encoding.

    Such parts and pieces, units for short, are remembered in two generations:
    a full one replaces the older, and a unit found in the older moves to the
    newer.
    """

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.wide = self.tokenizer.get_vocab_size() > 65536
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = np.zeros((256, 2), np.uint8)      # of bytes from 0x80: their letter, in UTF-8
        for c in map(chr, range(0x80, 0x250)):
            for byte, letter in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True):
                self.alphabet[byte] = list(letter.encode())
        self.raw = [i.to_bytes(self.dtype.itemsize, "little")
                    for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _in_alphabet(self, words: list[str]) -> list[str]:
        """Words in the model's byte alphabet, all of them mapped together."""
        joined = " ".join(words)
        if joined.isascii():
            return words
        raw = np.frombuffer(joined.encode(), np.uint8)
        high = np.flatnonzero(raw >= 0x80)
        mapped = np.empty(len(raw) + len(high), np.uint8)
        size = (raw >= 0x80).astype(np.int64) + 1
        at = np.cumsum(size) - size
        mapped[at] = raw
        mapped[at[high]], mapped[at[high] + 1] = self.alphabet[raw[high]].T
        return mapped.tobytes().decode().split(" ")

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Words of lower-case letters below U+0250, by the tokenizer's model."""
        raw, tokenize = self.raw, self.model.tokenize
        return [b"".join([raw[t.id] for t in tokenize(word)]) for word in self._in_alphabet(words)]

    def _known(self, units: list[str]) -> list[bytes]:
        """The ids of each word, run of signs or other piece; new ones are learned."""
        if len(self.cache) > CACHE_PIECES:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        ids = list(map(cache.get, units))
        words, others = {}, {}
        for i in [i for i, found in enumerate(ids) if found is None]:
            unit = units[i]
            found = older.get(unit)
            if found is not None:
                ids[i] = cache[unit] = found
            elif unit.islower() and unit.isalpha() and (unit.isascii() or not _ODD.search(unit)):
                words[i] = unit
            else:
                others[i] = unit
        for new, encode in ((words, self._encode_words), (others, self._encode)):
            for (i, unit), found in zip(new.items(), encode(list(new.values())), strict=True):
                ids[i] = cache[unit] = found
        return ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Ordinary texts are split, and their units numbered, all together:
        only the distinct ones are looked up one by one."""
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        plain, data = [], []
        for i, text in enumerate(texts):
            if text and _is_odd(text):
                units = text.replace("\n", " ").split(" ")
                out[i] = np.frombuffer(b"".join(self._known(units)), self.dtype)
            elif text:
                text = text.lower()
                if not text.isascii():                # white space beyond ASCII
                    text = text.replace("\x85", " ").replace("\xa0", " ")
                plain.append(i)
                data.append(text.encode())
        group = np.cumsum([len(d) for d in data], dtype=np.int64) // SPLIT_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(data)] if data else []
        split = [(s, *_split(data[s:e])) for s, e in pairwise(bounds)]
        split = [x for x in split if len(x[1])]           # texts of white space alone have no ids
        if not split:
            return out
        coded = pa.chunked_array([units for _, units, _ in split]).dictionary_encode()
        raw = self._known(coded.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, raw), np.int32, len(raw)) // np.int32(self.dtype.itemsize)
        begin, flat = np.cumsum(size, dtype=np.int32) - size, np.frombuffer(b"".join(raw), self.dtype)
        for (first, _, counts), numbers in zip(split, coded.chunks, strict=True):
            at = numbers.indices.to_numpy()
            each = size[at]
            ends = np.cumsum(each, dtype=np.int32)
            place = np.repeat(begin[at] - (ends - each), each)
            place += np.arange(len(place), dtype=np.int32)
            ids = flat[place]
            last = np.concatenate(([0], ends))[np.cumsum(counts)].tolist()
            for i, s, e in zip(plain[first:], [0, *last], last, strict=False):
                out[i] = ids[s:e]
        return out


# Kinds of bytes: white space, signs, letters (a to z, and U+00C0 to U+024F in UTF-8), others.
_WHITE, _SIGN, _LETTER = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[32, *range(9, 14)]] = _WHITE
_KIND[list(_SIGNS.encode())] = _SIGN
_KIND[ord("a"):ord("z") + 1] = _KIND[0x80:0xC2] = _KIND[0xC3:0xCA] = _LETTER


def _split(texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
    """The units of all texts, one after another, and the number in each.

    A piece between ASCII white space that is letters followed by signs is two
    units; any other is one.
    """
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    kind = np.frombuffer(bytearray(joined).translate(_KIND.tobytes()), np.uint8)
    product = np.flatnonzero(raw[:-1] == 0xC3)
    kind[product[(raw[product + 1] == 0x97) | (raw[product + 1] == 0xB7)]] = 0       # no letters
    marks = np.flatnonzero(kind != _LETTER)
    is_white, is_sign = kind[marks] == _WHITE, kind[marks] == _SIGN
    blanks = marks.take(np.flatnonzero(is_white))
    ending = np.flatnonzero(np.diff(blanks, prepend=-1) > 1)      # blanks that end a piece
    # Runs of signs that end a piece, with letters alone before them in it.
    together = (np.diff(marks) == 1) & is_sign[1:] & is_sign[:-1]
    first = np.flatnonzero(is_sign & ~np.concatenate(([False], together)))
    final = np.flatnonzero(is_sign & ~np.concatenate((together, [False])))
    gap = marks[first] - np.where(first, marks[first - 1], -1)
    splits = (kind[marks[final] + 1] == _WHITE) & (gap > 1) & (is_white[first - 1] | (first == 0))
    first = first[splits]
    # Where units end in the bytes that are not white.
    closes = np.zeros(len(raw) - len(blanks) + 1, bool)
    closes[blanks[ending] - ending] = True
    closes[marks[first] - np.cumsum(is_white)[first]] = True
    last = np.flatnonzero(closes)
    units = pa.StringArray.from_buffers(
        len(last), pa.py_buffer(np.concatenate(([0], last)).astype(np.int32)),
        pa.py_buffer(raw.take(np.flatnonzero(kind != _WHITE))))
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    stops -= np.searchsorted(blanks, stops)
    return units, np.diff(np.searchsorted(last, stops, side="right"), prepend=0)


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts, some CHUNK_CHARS at a time."""
    docs, texts, held = [], [], 0
    for batch in pieces(batches, 64):
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            docs.append(doc)
            texts.append(text)
            held += len(text or "")
            if held >= CHUNK_CHARS:
                yield docs, texts
                docs, texts, held = [], [], 0
    if docs:
        yield docs, texts


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(name: str) -> PieceEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = PieceEncoder(name)
    return _ENCODERS[name]


def _shard_batches(tokenizer: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype)
        seq, start, held, ids, docs, counts = 0, 0, 0, [], [], []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "part_start": pa.array([start], pa.int64()),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "doc_tokens": pa.array([counts], pa.list_(pa.int64())),
                "wavelet": pa.array([WaveletMatrix.build(np.concatenate(ids)).to_bytes()],
                                    pa.binary())})

        for ids_, texts in _by_size(batches):
            for doc, found in zip(ids_, encoder.encode(texts), strict=True):
                ids += [found, end]
                docs.append(doc)
                counts.append(len(found) + 1)
                held += counts[-1]
                if held >= shard_tokens:
                    yield shard()
                    seq, start, held, ids, docs, counts = seq + 1, start + held, 0, [], [], []
        if docs:
            yield shard()
        pa.default_memory_pool().release_unused()         # the worker stays, beside other stages
    return run


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, *, id_col: str = "doc_id",
                 text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every whole text and write the shards, in ascending doc_id order, to `folder`.

    One range shuffle of the texts; encoding and packing follow in the same
    task. Null texts count as empty (the end id alone), null ids come first,
    rows of one id follow each other by text, and an empty table gives no shard.
    """
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (documents_input(docs, id_col, text_col)
               .repartitionByRange(parts, F.col("doc_id"))
               .sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(_shard_batches(tokenizer, end_id, shard_tokens), SHARD_SCHEMA)
     .write.option("compression", "zstd").parquet(folder))


def _document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            ids = WaveletMatrix.from_bytes(one.column("wavelet")[0].as_py()).decode()
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            counts = one.column("doc_tokens").flatten()
            ends = np.cumsum(counts.to_numpy(zero_copy_only=False))
            starts = ends - counts.to_numpy(zero_copy_only=False)
            first = one.column("part_start")[0].as_py()
            crcs = [zlib.crc32(raw[4 * s:4 * e])
                    for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(ends), one.column("part")[0].as_py(), np.int32)),
                "part_at": pa.array(starts + first), "doc_id": one.column("doc_ids").flatten(),
                "n_tokens": counts, "ids_crc32": pa.array(crcs, pa.int64())})


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards.

    The ids before a document are those of the parts before its own, and those
    before it in its part. There is one row a part to sum over and to broadcast:
    as many as the shuffle has partitions, however large the corpus.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    sums = shards.groupBy("part").agg(F.sum(F.expr(
        "aggregate(doc_tokens, 0L, (a, x) -> a + x)")).alias("n"))
    ordered = sums.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts"))
    bases = ordered.select(F.explode(F.expr(
        "transform(parts, (p, i) -> struct(p.part AS part, "
        "aggregate(slice(parts, 1, i), 0L, (a, x) -> a + x.n) AS base))")).alias("p")).select("p.*")
    found = shards.select("part", "part_start", "doc_ids", "doc_tokens", "wavelet").mapInArrow(
        _document_batches, "part int, part_at long, doc_id long, n_tokens long, ids_crc32 long")
    return (found.join(F.broadcast(bases), "part")
            .select("doc_id", (F.col("base") + F.col("part_at")).alias("start"), "n_tokens",
                    "ids_crc32"))


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(part, seq, n): how often an id occurs in each shard, from rank queries alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [WaveletMatrix.from_bytes(b).count(token)
                 for b in batch.column("wavelet").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("seq"), pa.array(n, pa.int64())],
                names=["part", "seq", "n"])

    ship_package(spark)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(folder)
    return shards.select("part", "seq", "wavelet").mapInArrow(run, "part int, seq int, n long")


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the documents' ids to new shards in the shared folder and read them back."""
    folder = run_folder(spark, "wavelet")
    write_shards(spark, docs, folder)
    return read_documents(spark, folder)


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the shards."""
    return encoded(spark, read_table(spark, sf_dir, "documents"))
