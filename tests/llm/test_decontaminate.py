import random
import re

import numpy as np
import pytest

from packetflow.llm.common import read_table
from packetflow.llm.decontaminate import (common_subsequence, covered, find_leaks, latent_basis,
                                          load_benchmark, op10_decontaminate, words_of)
from tests.conftest import SF_SMALL


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def plain_leaks(docs, items):
    """Every item against every place of every document, without the candidate search."""
    terms, out = {}, set()
    code = lambda t: np.array([terms.setdefault(w, len(terms) + 1) for w in words_of(t)], np.int32)
    coded = [(i, code(t)) for i, t in items]
    for doc, text in docs:
        words = code(text)
        here = set(words.tolist())
        for i, item in coded:
            if sum(w in here for w in item.tolist()) >= 0.75 * len(item):
                share, answer = covered(item, words)
                if share >= 0.75 and answer >= 0.5:
                    out.add((doc, i))
    return out


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_found(item, words):
    """Whether a stretch of 1.5 item lengths, at any word, holds the item and its answer."""
    n, here = len(item), set(words)
    if sum(w in here for w in item) < 0.75 * n:
        return False
    length, answer = max(int(1.5 * n), n + 4), item[-8:]
    for at in range(max(len(words) - length, 0) + 1):
        part = words[at:at + length]
        if sum(w in part for w in item) >= 0.75 * n and plain_subsequence(item, part) >= 0.75 * n \
                and plain_subsequence(answer, part) >= 0.5 * len(answer):
            return True
    return False


def test_query_equals_every_stretch_of_every_text(spark, tables):
    docs, items = tables
    words = {d: plain_words(t) for d, t in docs}
    want = {(d, i) for i, t in items for d in words if plain_found(plain_words(t), words[d])}
    got = {(r.doc_id, r.item_id) for r in op10_decontaminate(spark, SF_SMALL).collect()}
    assert got == want and len(want) >= 3


def test_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(1, 6, rng.integers(1, 40)), rng.integers(0, 6, rng.integers(0, 90))
        assert common_subsequence(a, b) == plain_subsequence(a.tolist(), b.tolist())


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    return docs, items


def test_query_equals_brute_force(spark, tables):
    got = {(r.doc_id, r.item_id) for r in op10_decontaminate(spark, SF_SMALL).collect()}
    assert got == plain_leaks(*tables) and len(got) >= 3


def test_paraphrases_are_found_and_clean_texts_are_not(spark, tables):
    docs, items = tables
    rng = random.Random(4)
    leaked = {d for d, _ in plain_leaks(docs, items)}
    clean = [t for d, t in docs if d not in leaked and len(t.split()) > 20]
    rows = []
    for at, (item, text) in enumerate(items):
        words = text.split()
        for _ in range(max(1, len(words) // 10)):            # one word in ten is another one
            words[rng.randrange(len(words) - 8)] = "changed"
        around = clean[at].split()
        cut = rng.randrange(len(around) + 1)
        rows.append((item, " ".join(around[:cut] + words + around[cut:])))
    rows += [(1000 + i, t) for i, t in enumerate(clean[40:])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in
             find_leaks(spark, frame, read_table(spark, SF_SMALL, "benchmark")).collect()}
    assert {(i, i) for i, _ in items} <= found
    assert not [d for d, _ in found if d >= 1000]


def test_odd_rows(spark):
    item = "Which of these seven named rivers runs north past the old stone mill? The Aldermere does."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item)], "item_id long, text string")
    rows = [(1, None, 0), (2, "", 0), (None, f"x {item.upper()} y", 0), (3, item, 0), (3, item, 0),
            (4, "the of " * 30_000 + item + " the of" * 30_000, 0), (5, item.split("?")[0] * 3, 0),
            (6, "nothing in common", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms int")
    found = sorted((str(r.doc_id), r.item_id) for r in find_leaks(spark, docs, bench).collect())
    # The item is there twice, so each finding is. Row 5 lacks the answer's last three words of eight.
    assert found == [("3", 1)] * 4 + [("4", 1)] * 2 + [("5", 1)] * 2 + [("None", 1)] * 2
    assert find_leaks(spark, docs.limit(0), bench).collect() == []
    assert find_leaks(spark, docs, bench.where("item_id > 1")).collect() == []


def test_stretches_reach_the_end():
    rng = np.random.default_rng(5)
    for n in (9, 24, 40, 61):
        item = np.arange(1, n + 1)
        for before in range(2 * n):
            text = np.concatenate((rng.integers(1000, 2000, before), item))
            assert covered(item, text) == (1.0, 1.0)


def test_answer_of_any_stretch_that_covers_enough():
    item = np.arange(1, 41)
    cut = np.concatenate((item[:35], np.full(60, 99)))             # 35 of 40 words, 3 of the answer's 8
    other = np.concatenate((item[:12], np.full(8, 99), item[20:]))  # 32 of 40, and all of the answer
    assert covered(item, np.concatenate((cut, other))) == (0.8, 1.0)


def test_items_at_document_ends(spark, tables):
    docs, items = tables
    leaked = {d for d, _ in plain_leaks(docs, items)}
    clean = [t.split() for d, t in docs if d not in leaked and len(t.split()) > 150]
    rows = [(item * 100 + k, " ".join([*clean[(at + k) % len(clean)][:60 + 7 * k], text]))
            for at, (item, text) in enumerate(items) for k in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in
             find_leaks(spark, frame, read_table(spark, SF_SMALL, "benchmark")).collect()}
    words = {d: words_of(t) for d, t in rows}
    want = {(d, i) for d in words for i, t in items if words[d][-len(words_of(t)):] == words_of(t)}
    assert want <= found and len(want) >= 12 * len(items)


def test_benchmark_in_blocks(spark, tables):
    docs, items = tables
    bench = read_table(spark, SF_SMALL, "benchmark")
    frame = spark.createDataFrame([(i, t) for i, t in items] + [(1000 + i, t) for i, t in docs[:20]],
                                  "doc_id long, text string")
    blocks = list(load_benchmark(bench, block_words=400))
    assert len(blocks) > 2 and all(sum(map(len, b.items)) <= 400 for b in blocks)
    assert sorted(i for b in blocks for i in b.item_ids) == sorted(i for i, _ in items)
    found = {(r.doc_id, r.item_id) for r in find_leaks(spark, frame, bench, block_words=400).collect()}
    assert {(i, i) for i, _ in items} <= found


def test_benchmark_of_more_than_a_block(spark):
    item = "Which of these seven named rivers runs north past the old stone mill? The Aldermere does."
    bench = spark.createDataFrame([(1, item), (2, " ".join(f"w{i}" for i in range(200_001)))],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(7, f"x {item}")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(spark, docs, bench).collect()] == [(7, 1)]


def test_latent_space_is_fitted_on_all_rows(spark, monkeypatch):
    fitted = []

    def seen(spark, encoded, *rest):
        fitted.append(encoded.count())
        return latent_basis(spark, encoded, *rest)

    monkeypatch.setattr("packetflow.llm.decontaminate.latent_basis", seen)
    item = "Which of these seven named rivers runs north past the old stone mill? The Aldermere does."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.range(20_500).selectExpr(
        "if(id % 3 = 0, null, id) AS doc_id", f"if(id = 7, 'x {item}', concat('the mill of ', id)) AS text")
    assert [(r.doc_id, r.item_id) for r in find_leaks(spark, docs, bench).collect()] == [(7, 1)]
    assert fitted == [20_500]
