import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, prose
from tests.oracle import compare, connect
from tickloom.llm import filter_audit as A
from tickloom.llm.queries import ORACLE_SQL, op12_filter_audit

DOCUMENTS = "doc_id long, text string, lang string, `part` string, mask string, n string, digest string"
LABELS = "doc_id long, quality int, toxic int, `good` string, part string"

WORDS = " ".join(f"w{k}" for k in range(210))
ROWS = [
    (1, WORDS, "en"), (2, WORDS, "en"), (3, WORDS, None), (3, WORDS, ""), (None, WORDS, "en"), (4, None, "en"), (5, "", "fr"),
    (6, WORDS + " #", "en"), (7, "a " * 300, "fr"), (8, WORDS.upper(), "fr"), (9, "é" * 50 + " A B", None), (10, LONG, "de"),
    (10, LONG, "de"), (11, LONG + "$", "de"), (12, prose(1, 300, 5), "de"), (1, WORDS, "en"), (0, "x | y", "en"), (13, "x | y", "en"),
]
MARKS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (4, None, 1), (6, 1, 1), (7, 1, 0), (None, 1, 1), (10, 0, 1), (12, 1, 0), (99, 1, 1)]


def slow_mask(row, rows):
    doc_id, text, _ = row
    text = text or ""
    words = text.encode().split()
    fails = [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
    ]
    return fails


def slow_audit(rows, marks):
    out = []
    good = {d for d, q, _ in marks if q == 1 and d is not None}
    toxic = {d for d, _, t in marks if t == 1 and d is not None}
    masks = [slow_mask(r, rows) for r in rows]
    parts = [r[2] or "" for r in rows]
    for part in set(parts):
        mine = [k for k in range(len(rows)) if parts[k] == part]
        total = Counter()
        lines = []
        for order in itertools.permutations(range(5)):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if masks[k][f]]
                earlier = [k for k in mine if k not in left and masks[k][f]]
                left = [k for k in left if not masks[k][f]]
                total[f] += len(gone)
                lone = [k for k in mine if masks[k][f] and sum(masks[k]) == 1]
                losses = [sum(rows[k][0] in s for k in gone) for s in (good, toxic)]
                lines.append((f, ("".join("ABCDE"[k] for k in order), step, len(left), len(gone), len(earlier), len(lone), *losses)))
        out += [(part, *line, total[f]) for f, line in lines]
    return sorted(out)


def tables(spark, folder, rows=ROWS, marks=MARKS):
    spark.createDataFrame([(*r, "p", "m", "n", "d") for r in rows], DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*m, "g", "p") for m in marks], LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_orders_are_counted_over_the_lattice():
    for n in range(1, 7):
        edges = A.orders_through(n)
        counted = Counter()
        for order in itertools.permutations(range(n)):
            state = 0
            for f in order:
                counted[state, f] += 1
                state |= 1 << f
        assert edges == counted
        assert all(w == math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) for (s, _), w in edges.items())


def test_query_equals_brute_force_and_its_sql(spark, tmp_path):
    sf = tables(spark, tmp_path)
    got = op12_filter_audit(spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == slow_audit(ROWS, MARKS)
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet/*.parquet')")
    compare(got, con, ORACLE_SQL["op12_filter_audit"])


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    marks = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(tuple(r) for r in op12_filter_audit(spark, sf).collect()) == slow_audit(rows, marks)
    compare(op12_filter_audit(spark, sf), connect(sf), ORACLE_SQL["op12_filter_audit"])


def test_no_documents_and_no_labels(spark, tmp_path):
    assert op12_filter_audit(spark, tables(spark, tmp_path / "none", [], MARKS)).collect() == []
    got = op12_filter_audit(spark, tables(spark, tmp_path / "unmarked", ROWS, [])).collect()
    assert sorted(map(tuple, got)) == slow_audit(ROWS, [])


def test_a_text_and_a_row_that_make_up_a_third(spark):
    """Copies under many ids, and one row again and again, are counted before they meet."""
    rows = [(k, WORDS, "en") for k in range(200)] + [(7, "x", "en")] * 200 + [(1000 + k, prose(k, 5), "fr") for k in range(200)]
    docs = spark.createDataFrame([(*r, "p", "m", "n", "d") for r in rows], DOCUMENTS).repartition(8)
    counted = {(r.part, r["mask"]): r.n for r in A.document_failures(docs).groupBy("part", "mask").agg(F.sum("n").alias("n")).collect()}
    want = Counter((r[2], sum(1 << k for k, f in enumerate(slow_mask(r, rows)) if f)) for r in rows)
    assert counted == want


def test_very_long_texts_are_taken_in_pieces(monkeypatch):
    text = " ".join(f"{k % 700} \t\n" for k in range(4000)).encode()
    whole = A._words(text)
    monkeypatch.setattr(A, "_PIECE", 100)
    assert A._words(text) == whole == (4000, 700)


def test_edges_take_any_filters_and_weights(spark):
    """Three filters, two weights, null masks, parts and weights."""
    rows = [(None, 1, 2, 0.0), ("a", 0b101, 1, 4.0), ("a", None, 5, 1.0), ("a", 0b001, None, 3.0), ("a", 0b111, 1, None)]
    failed = spark.createDataFrame(rows, "piece string, fails int, n long, words double")
    found = A.edges(failed, 3, "piece", "fails", ("n", "words"))
    assert found.count() == 2 * 12
    row = found.filter("part = 'a' and state = 2 and filter = 0").first()
    assert (row.kept, row.removed, row.redundant, row.unique_fails, row.removed_words) == (5, 1, 1, 0, 7)
    assert A.steps(found, "xyz").filter("part is null").count() == 6 * 3
    assert A.edges(failed.limit(0), 3, "piece", "fails").collect() == []
    with pytest.raises(ValueError):
        A.edges(failed, 0)
    with pytest.raises(ValueError):
        A.steps(found, "abcdefgh")
