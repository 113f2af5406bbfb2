import hashlib
import re
from collections import defaultdict

import duckdb

from packetflow.llm.common import read_table
from packetflow.llm.lines import ORACLE_SQL, dedup_lines, op6_line_dedup
from tests.conftest import SF_ORACLE

EDGE = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), EDGE.sub("", line))


def plain(rows, chars=20, documents=3):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= chars:
                holders[key_of(line)].add(-2 ** 63 if doc is None else doc)
    out = []
    for doc, text in rows:
        kept = [x for x in (text or "").split("\n")
                if len(holders[key_of(x)]) < documents
                or max(holders[key_of(x)]) == (-2 ** 63 if doc is None else doc)]
        out.append((doc, (text or "").count("\n") + 1, "\n".join(kept)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.n_lines, r.kept_text) for r in frame.collect()), key=str)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_ORACLE}/documents.parquet'")
    want = sorted(con.sql(ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in op6_line_dedup(spark, SF_ORACLE).collect())
    assert got == want and sum(r[2] for r in got) > 0


def test_texts_equal_brute_force(spark):
    docs = read_table(spark, SF_ORACLE, "documents")
    assert result(dedup_lines(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    long = "A shared line that is long enough"
    rows = [(1, long, 1), (2, f" \t{long.upper()}\x0b\nx", 2), (3, f"{long}\n{long}\n\n", 3),
            (3, long, 4), (None, f"own\n{long}", 5), (4, None, 6), (5, "", 7),
            (6, "\xa0" + long, 8), (7, "É" * 20, 9), (8, "é" * 20, 9), (9, "É" * 20, 9),
            (10, "É" * 20 + "\n" + "z\n" * 50_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    assert result(dedup_lines(docs)) == plain([r[:2] for r in rows])
    got = {r.doc_id: r for r in dedup_lines(docs.where("doc_id IN (4, 5)")).collect()}
    assert [(got[i].n_lines, got[i].n_dropped, got[i].kept_text) for i in (4, 5)] == [(1, 0, "")] * 2
    assert dedup_lines(docs.limit(0)).collect() == []
    assert hashlib.sha256(b"").hexdigest()
