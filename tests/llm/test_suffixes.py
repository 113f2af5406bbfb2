import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm import common, suffixes
from packetflow.llm.common import read_table
from packetflow.llm.suffixes import BlindTrie, op2_suffix_dedup, remove_repeats, repeated_windows, runs_of
from tests.conftest import SF_ORACLE


def plain(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                   for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_ORACLE, "documents").collect()]
    got = sorted(map(tuple, op2_suffix_dedup(spark, SF_ORACLE).collect()), key=str)
    assert got == plain(rows, 200)


WORDS = st.lists(st.sampled_from(["ab", "abab", "x", "éa", "abcabcabc", "q" * 13, "\n"]), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS.map("".join), min_size=1, max_size=4))
def test_runs_cover_all_windows_and_repeats_within(texts):
    for raw in (np.frombuffer(t.encode(), np.uint8) for t in texts):
        v, a, b, own = runs_of(raw, 12, 5)
        windows = [raw[i:i + 12].tobytes() for i in range(len(raw) - 11)]
        assert [i for x, y in zip(a, b, strict=True) for i in range(x, y + 1)] == list(range(len(windows)))
        by_window = {}
        for x, low, high, twice in zip(v.tolist(), a, b, own, strict=True):
            inside = windows[low:high + 1]
            assert twice or len(set(inside)) == len(inside)
            for w in inside:
                assert by_window.setdefault(w, x) == x


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=9, max_size=9), min_size=1, max_size=30))
def test_deep_shallow_and_trie(strings):
    data = [s.encode() for s in strings]
    trie = BlindTrie(data)
    assert [data[i] for i in trie.equal] == data and all(e <= i for i, e in enumerate(trie.equal))
    buffer = np.frombuffer(b"".join(data), np.uint8)
    starts = np.arange(0, 9 * len(data), 9)
    for shallow in (0, 8):
        marks = repeated_windows(buffer, starts, 9, shallow)
        assert marks.tolist() == [data.count(d) > 1 for d in data]


def edge_texts():
    rng = np.random.default_rng(6)
    text = "".join(rng.choice(list("abcdefgh é"), 900))
    return [text, text[100:500] + "Z" * 90, "other " + text[300:], "ab" * 150, "ab" * 20, "q" * 41, None,
            "", text[:39], text[:40], text[860:], "w " * 3000 + text[450:495], text]


def test_odd_rows(spark):
    texts = edge_texts()
    rows = [(i if i != 2 else None, t, b"") for i, t in enumerate(texts)] + [(0, texts[0], b""), (0, "x", b"")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept binary")
    want = plain([r[:2] for r in rows], 40)
    assert result(remove_repeats(spark, docs, length=40, gram=12)) == want
    assert remove_repeats(spark, docs.limit(0)).collect() == []


def test_hot_minimizers_are_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_RUNS", 1)
    rows = [(i, t) for i, t in enumerate(edge_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(remove_repeats(spark, docs, length=40, gram=12)) == plain(rows, 40)


def test_where_every_passage_and_text_is_hot(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 0)
    texts = edge_texts() + [edge_texts()[0]] * 40
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert result(remove_repeats(spark, docs, length=40, gram=12)) == plain(rows, 40)
