import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm.common import read_table, run_folder
from packetflow.llm.tokens import (PieceEncoder, WaveletMatrix, _by_size, _split, occurrences,
                                   op3_token_ids, read_documents, write_shards)
from tests.conftest import SF_SMALL

TEXTS = [None, "", " ", "\n\n", "Hello, world!! it's 3<|endoftext|>x", "a b c\x1cd",
         "É́ ǅ İstanbul ΣΑΣ", "don't CAN'T x'LL", "%%% &&& a*** <b> a<b", "ñ" * 50, "word " * 20_000,
         "tab\tand\rret\x0b\x0c", "日本語 テキスト", "é ́x"]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder()


def plain_ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_text_encoding(spark, encoder):
    texts = TEXTS + [r.text for r in read_table(spark, SF_SMALL, "documents").collect()]
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert found.tolist() == plain_ids(encoder, text), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30) | st.text("aB '!.<|>\n\t3é", max_size=20))
def test_any_text(text):
    encoder = test_any_text.__dict__.setdefault("encoder", PieceEncoder())
    assert encoder.encode([text])[0].tolist() == plain_ids(encoder, text)


def test_every_latin_letter_alone_and_within_words(encoder):
    for at in range(0x21, 0x250):
        c = chr(at)
        for text in (c, f"na{c}ta", f"{c}on,", f"x {c}{c} {c}é!", f"e{c}́"):
            assert encoder.encode([text])[0].tolist() == plain_ids(encoder, text), (hex(at), text)


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr("packetflow.llm.tokens.CACHE_PIECES", 3)
    small = PieceEncoder()
    for text in ("a b c d e", "f a g h", "a!! b!! c d"):
        assert small.encode([text, text])[1].tolist() == plain_ids(small, text)


def test_texts_split_in_groups(monkeypatch, encoder):
    texts = [t for text in TEXTS for t in (text, "it's a*** b c!?", "\n", "x×y ÷ ñandú, é")]
    for size in (1, 8, 100):
        monkeypatch.setattr("packetflow.llm.tokens.SPLIT_BYTES", size)
        found = PieceEncoder().encode(texts)
        assert [f.tolist() for f in found] == [plain_ids(encoder, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aé×!.'3 \n", max_size=12), min_size=1, max_size=5))
def test_split_equals_a_pattern(texts):
    """A piece is one unit, but letters followed by signs are two."""
    want = []
    for text in texts:
        parts = [re.fullmatch(r"([aé]+)([!.]+)", piece) for piece in text.split()]
        want.append([u for piece, m in zip(text.split(), parts, strict=True)
                     for u in (m.groups() if m else [piece])])
    units, counts = _split([t.encode() for t in texts])
    assert units.to_pylist() == [u for found in want for u in found]
    assert counts.tolist() == [len(found) for found in want]


def test_a_unit_is_looked_up_once_in_some_megabytes(monkeypatch):
    text = " ".join("abcdefgh"[i % 8] * (i // 8 + 1) for i in range(800))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(90)), "text": [text] * 90})
    assert 3 << 20 < 90 * len(text) < 4 << 20
    encoder, looked_up = PieceEncoder(), []
    known = encoder._known
    monkeypatch.setattr(encoder, "_known", lambda units: looked_up.extend(units) or known(units))
    found = [ids for _, texts in _by_size(iter([batch])) for ids in encoder.encode(texts)]
    assert len(looked_up) == len(set(looked_up)) == 800
    assert {f.tobytes() for f in found} == {np.array(plain_ids(encoder, text), encoder.dtype).tobytes()}
    assert len(found) == 90


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000) | st.integers(0, 3), max_size=1500))
def test_wavelet_matrix(ids):
    array = np.array(ids, np.uint32)
    m = WaveletMatrix.from_bytes(WaveletMatrix.build(array).to_bytes())
    assert m.decode().tolist() == ids
    for at in range(0, len(ids), 97):
        assert m.access(at) == ids[at]
        assert m.count(ids[at], at) == ids[:at].count(ids[at])
        assert m.find(ids[at], ids[:at].count(ids[at])) == at
    assert m.count(70_001) == ids.count(70_001) and m.find(1, len(ids)) == -1


def test_query_equals_plain_encoding(spark, encoder):
    rows = sorted((r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect())
    want, start = [], 0
    for doc, text in rows:
        ids = plain_ids(encoder, text) + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = op3_token_ids(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows_shards_and_counts(spark, encoder):
    rows = [(i if i else None, t, i) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    folder = run_folder(spark, "wavelet-test")
    write_shards(spark, docs, folder, shard_tokens=10)
    found = sorted(read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 4, 5, 5, *range(6, len(TEXTS))]
    ends = np.cumsum([r.n_tokens for r in found])
    assert [r.start for r in found] == [0, *ends[:-1]]
    total = sum(r.n for r in occurrences(spark, folder, 1).collect())
    assert total == len(found) + sum(plain_ids(encoder, t).count(1) for _, t, _ in rows)
    empty = run_folder(spark, "wavelet-test")
    write_shards(spark, docs.limit(0), empty)
    assert read_documents(spark, empty).collect() == []
