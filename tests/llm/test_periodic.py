import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.llm.common import read_table
from packetflow.llm.periodic import op12_periodic_runs, periodic_runs, runs_of
from tests.conftest import SF_SMALL


def plain_runs(words):
    """Every lag over the whole text, each maximal stretch; a smaller period of it rules it out."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and (i, j + q) not in seen:
                assert not any(all(words[k] == words[k + p] for k in range(i, j + q - p))
                               for p in range(1, q))
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(texts):
    got = list(runs_of(list(range(len(texts))), [t.encode() for t in texts]))
    for (doc, n, runs, collapsed), text in zip(got, texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        want = plain_runs(words)
        assert (n, runs) == (len(words), want)
        assert collapsed.as_py() == plain_collapsed(words, want)


REPEATED = [
    "a " * 400,
    "a b " * 100 + "c " + "a b " * 100,
    " ".join(f"w{i % 17}" for i in range(200)),
    # a block of runs that are themselves periodic
    ("x " * 30 + "y " * 40 + "z ") * 5,
    ("x " * 30 + "y " * 40 + "x " * 20 + "y " * 30) * 4 + "x " * 25,
    # every 2-gram of the block occurs twice in it: no seed has its nearest occurrence at the period
    ("x1 x2 x3 x4 x5 x6 x7 x8 x9 " * 2 + "y1 y2 y3 y4 y5 y6 y7 y8 y9 " * 2
     + "x1 x2 x3 x4 x5 x6 x7 x8 x9 " * 3 + "y1 y2 y3 y4 y5 y6 y7 y8 y9 " * 3) * 3,
    "a b c d e f g h " * 3,
    "a b c d e f g h " * 3 + "a",
    "a b c d e f g " * 3 + "a b",
    "a b c d e f g " * 3 + "a b c",
    "", " \t\n", "one", "      " * 30,
]


def test_repeated_texts():
    check(REPEATED)
    for text in REPEATED:
        check([text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=30),
                          st.integers(1, 9)), max_size=6))
def test_runs_equal_brute_force(parts):
    check([" ".join(w for block, times in parts for w in block * times)])


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
@pytest.mark.parametrize("seed", range(6))
def test_planted_runs_equal_brute_force(letters, seed):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(4):
        words = []
        for _ in range(rng.integers(1, 6)):
            block = [f"w{x}" for x in rng.integers(0, letters, rng.integers(1, 70))]
            words += (block * 9)[:int(len(block) * rng.uniform(0.5, 6))]
        texts.append(" ".join(words))
    check(texts)


def test_long_periodic_texts_take_time_in_proportion():
    for text in ("a " * 1_000_000, ("a " * 99 + "b ") * 10_000,
                 ("a b " * 999 + "c ") * 500, " ".join(map(str, range(300_000))) + " "):
        (_, n, runs, collapsed), = runs_of([1], [(text * 1).encode()])
        assert n == len(text.split())
        if text.startswith("a a"):
            assert max(r[1] / r[2] for r in runs) >= 99


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF_SMALL).collect()}
    docs = read_table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs) == len({d.doc_id for d in docs})
    some = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words)
        some += bool(runs)
        r = got[d.doc_id]
        assert r.n_runs == len(runs)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, m, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, q, 1000 * m // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert some > 5


def test_nulls_repeats_and_other_columns(spark):
    text = "a b c " * 20
    rows = [(1, text, "x"), (1, text, "x"), (None, text, None), (2, None, "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
           for r in periodic_runs(spark, docs).collect()]
    run = [(0, 60, 3)]
    assert sorted(got, key=str) == sorted([(1, 60, run, "a b c"), (1, 60, run, "a b c"),
                                           (None, 60, run, "a b c"), (2, 0, [], ""),
                                           (3, 0, [], "")], key=str)
    assert periodic_runs(spark, docs.limit(0)).collect() == []
