import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from packetflow.llm import toxicity
from packetflow.llm.common import DOCUMENT_COLUMNS, read_table, written
from packetflow.llm.tokens import PieceEncoder
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import plain_leaks
from tests.llm.test_mixing import plain_targets
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(spark, stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return [[r.asDict() for r in frame.collect()] for frame in out]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_toxicity(spark, stages):
    model = toxicity.fitted(spark, SF_SMALL)
    scores = toxicity.scores_of([r["text"] for r in stages[0]], model.dense(), model.bias)
    assert ids(stages[1]) == sorted(
        r["doc_id"] for r, s in zip(stages[0], scores, strict=True) if s < 0.7)


def test_near_dedup(stages):
    rows = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in stages[1]])
    assert ids(stages[2]) == sorted({c for _, _, c in rows})


def test_decontaminate(spark, stages):
    items = [(r.item_id, r.text) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    leaks = {d for d, _ in plain_leaks([(r["doc_id"], r["text"]) for r in stages[2]], items)}
    assert ids(stages[3]) == sorted(r["doc_id"] for r in stages[2] if r["doc_id"] not in leaks)


def test_mix(stages):
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in stages[3]}
    source = {r["doc_id"]: r["source"] for r in stages[3]}
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for doc, n in words.items():
        sizes[source[doc]] += n
        largest[source[doc]] = max(largest[source[doc]], n)
    for r in stages[4]:
        taken[r["source"]] += words[r["doc_id"]]
    for s, target in plain_targets(sizes).items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1
    assert max(Counter(ids(stages[4])).values()) <= 2
    assert all(tuple(r) == DOCUMENT_COLUMNS for rows in stages[1:5] for r in rows)


def test_token_ids(stages):
    encoder, start = PieceEncoder(), 0
    want = []
    for r in sorted(stages[4], key=lambda r: r["doc_id"]):
        found = encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.append((start, r["doc_id"], len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
        start += len(found)
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in stages[5]) == want


def test_run_gives_the_last_stage(spark, stages):
    got = [r.asDict() for r in corpus_pipeline.run(spark, SF_SMALL).collect()]
    assert sorted(map(str, got)) == sorted(map(str, stages[5]))


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two three four", "en", "a", 1),
            (3, "one two three four", "en", "a", 1), (None, "alone in the world it is", "en", "b", 1),
            (4, "w " * 60_000, None, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long").selectExpr("*", "1 AS size", "2 AS copies")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF_SMALL), "odd")
        kept.append(sorted(str(r.doc_id) for r in docs.select("doc_id").collect()))
    assert kept[0] == ["1", "2", "3", "3", "4", "None"]
    assert kept[1] == kept[2] == ["1", "3", "4", "None"]
    assert set(kept[3]) <= set(kept[2]) and kept[4] == kept[3]


def test_empty(spark):
    docs = read_table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF_SMALL), "empty")
        assert docs.collect() == []


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """Copies and leaks among them go one by one; clean ones stay."""
    item = next(r.text for r in read_table(spark, SF_SMALL, "benchmark").collect() if len(r.text.split()) > 30)
    with_id = "The ferry left at nine and nobody on the pier had thought to bring the blue umbrella along"
    alone = "Seven lamps burned behind the bakery window while the old clock kept its own idea of time"
    clean = [f"{w} " + " ".join(f"{w}{i}" for i in range(30)) for w in ("oak", "fern", "moss")]
    rows = [(5, with_id), (None, with_id), (None, with_id), (None, alone), (None, alone), (None, item),
            *((None, c) for c in clean)]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    one_each = written(spark, stages["near_dedup"](spark, docs, SF_SMALL), "null-ids")
    assert Counter((r.doc_id, r.text) for r in one_each.collect()) == Counter(
        [(5, with_id), (None, alone), (None, item), *((None, c) for c in clean)])
    kept = stages["decontaminate"](spark, docs, SF_SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(r for r in rows if r[1] != item)


def test_an_id_that_repeats_is_one_labelled_row(spark):
    from packetflow.llm.common import labelled_sample, labelled_texts
    from pyspark.sql import functions as F
    docs = spark.range(50_000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(
        F.lit("text "), F.col("id").cast("string")).alias("text")).union(
        spark.createDataFrame([(4, None), (None, "x")], "doc_id long, text string"))
    labels = spark.createDataFrame([(3, 1), (3, 0), (3, 1), (4, 1), (9, 0), (None, 1), (4, None)],
                                   "doc_id long, toxic int")
    sample = labelled_sample(labels, "toxic", F.lit(False), 10)
    assert sorted(map(tuple, sample.collect())) == [(3, 0), (4, 1), (9, 0)]
    assert sorted(map(tuple, labelled_texts(docs, sample).collect())) == [(3, "text 0", 0), (4, "", 1)]
