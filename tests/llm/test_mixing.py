import math
import re
from collections import defaultdict

import pytest
import regex
import xxhash

from packetflow.llm.common import read_table
from packetflow.llm.mixing import SHARE, WEIGHTS, mix, op9_mix_sources
from tests.conftest import SF_ORACLE


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = SHARE * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def by_source(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.source].append(r)
    return out


def check(rows, docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r["size"]) for r in rows) == sorted(
        (str(d.doc_id), words(d.text)) for d in docs)
    groups = by_source(rows)
    want = plain_targets({s: sum(r["size"] for r in g) for s, g in groups.items()})
    for source, g in groups.items():
        size = sum(r["size"] for r in g)
        assert {r.source_size for r in g} == {size}
        assert [r.target for r in g] == pytest.approx([want[source]] * len(g))
        assert abs(sum(r.taken for r in g) - want[source]) <= max(r["size"] for r in g) / 2 + 1
        assert all(r.taken in {int(want[source] // size) * r["size"] if size else 0,
                               int(want[source] // size + 1) * r["size"] if size else 0} for r in g)
        assert all(r.taken <= 2 * r["size"] for r in g)


@pytest.mark.parametrize("bins", [4096, 3])
def test_targets_and_budgets(spark, bins):
    docs = read_table(spark, SF_ORACLE, "documents")
    first = mix(spark, docs, bins=bins).collect()
    check(first, docs.collect())
    assert sorted(map(tuple, first)) == sorted(map(tuple, mix(spark, docs, bins=bins).collect()))


def plain_copies(docs):
    """(doc_id, size, copies): every source sorted as a whole by its exponential keys."""
    sources, out = defaultdict(list), []
    for d in docs:
        text = d.text or ""
        h = 42 if d.doc_id is None else xxhash.xxh64_intdigest(d.doc_id.to_bytes(8, "little", signed=True), 42)
        h = h if d.text is None else xxhash.xxh64_intdigest(text.encode(), h)
        h = xxhash.xxh64_intdigest((42).to_bytes(4, "little"), h)
        u = ((h & (1 << 53) - 1) + 0.5) / (1 << 53)
        plain = len(regex.sub(r"[^\p{L} \t\n\x0b\f\r]+", "", text))
        weight = max((plain / max(len(text), 1)) ** 2, 0.05)
        sources[d.source].append((-math.log(u) / weight, d.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    want = plain_targets({s: sum(n for *_, n in rows) for s, rows in sources.items()})
    for source, rows in sources.items():
        total = sum(n for *_, n in rows)
        epochs = int(want[source] // total) if total else 0
        budget, end = want[source] - epochs * total, 0
        for _, doc, n in sorted(rows):
            end += n
            out.append((doc, n, epochs + (end - n / 2 <= budget)))
    return sorted(out)


def test_documents_chosen_equal_a_plain_sort(spark):
    docs = read_table(spark, SF_ORACLE, "documents")
    for bins in (4096, 3):
        got = sorted((r.doc_id, r["size"], r.copies) for r in mix(spark, docs, bins=bins).collect())
        want = plain_copies(docs.collect())
        assert [(d, n, c * n) for d, n, c in got] == [(d, n, c * n) for d, n, c in want]


def test_query_columns(spark):
    assert op9_mix_sources(spark, SF_ORACLE).dtypes[:5] == [
        ("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"),
        ("target", "double"), ("taken", "bigint")]


def test_better_texts_are_taken_more_often(spark):
    rows = [(i, "word " * 10 if i % 2 else "%%% " * 10, s) for i in range(3000) for s in ("a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mix(spark, docs, share=0.3).where("source = 'a' AND copies = 1").collect()
    good = sum(r.doc_id % 2 for r in taken)
    assert good > 0.7 * len(taken)


def test_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, "", None, 2), (None, "x y", None, 3), (3, "one two", "é", 4),
            (3, "one two", "é", 5), (4, "w " * 100_000, "z", 6), (5, "t\x1cu \x0b v", "Z", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    check(mix(spark, docs).collect(), docs.collect())
    assert mix(spark, docs.limit(0)).collect() == []
    none = mix(spark, docs.where("doc_id = 1")).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in none] == [(0, 0, 0.0, 0)]
