import importlib
import re
import sys

import corpus_pipeline
from tests.llm.helpers import documents, prose
from tests.llm.test_filters import normal
from tickloom.llm.quality_rules import fit_rules, judge
from tickloom.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_pass_on_what_they_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    stages, kept = dict(corpus_pipeline.STAGES), {}
    for name in names[:-1]:
        made = stages[name](spark, docs, SF)
        assert made.dtypes == docs.dtypes
        kept[name] = docs = spark.createDataFrame(made.collect(), made.schema)
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in kept.items()}

    source = spark.read.parquet(f"{SF}/documents.parquet")
    judged = judge(source, fit_rules(source, spark.read.parquet(f"{SF}/labels.parquet")), keep=["doc_id"])
    assert ids["quality_rules"] == {r.doc_id for r in judged.filter("quality.kept").collect()}
    assert ids["line_dedup"] == ids["quality_rules"]
    groups = near_duplicates(kept["line_dedup"]).collect()
    assert ids["near_duplicates"] == {r.component_id for r in groups}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = normal(r.text)
        windows |= {tuple(words[k : k + 13]) for k in range(len(words) - 12)}
    clean = set()
    for r in kept["near_duplicates"].collect():
        words = normal(r.text)
        hit = {p for k in range(len(words) - 12) if tuple(words[k : k + 13]) in windows for p in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(words):
            clean.add(r.doc_id)
    assert ids["decontamination"] == clean
    assert all(len(r.text) == r.n_chars for r in kept["line_dedup"].collect())

    run = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in run} == clean and len(run) == len(clean)
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(run) == sorted(again)


def test_stages_take_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, prose(1, 60)), (3, prose(2, 60)), (3, prose(2, 60)), (4, prose(3, 60), None)]
    for docs in (documents(spark, rows, extra=True), documents(spark, rows, extra=True).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, SF)
            assert made.columns == docs.columns, name
            docs = spark.createDataFrame(made.collect(), docs.schema)
        mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert sorted((r.doc_id for r in mixed.collect()), key=str) == (sorted([3, 4, None], key=str) if docs.count() else [])


def test_the_entry_works_without_this_part(monkeypatch):
    import __spark_entry__ as entry

    assert {"pipeline", "op7_simhash"} <= set(entry.queries()) and "pipeline" not in entry.oracle_sql()
    monkeypatch.setitem(sys.modules, "tickloom.llm", None)
    monkeypatch.setitem(sys.modules, "tickloom.llm.queries", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(entry)
        assert "stock_performance" in bare.queries() and not [n for n in bare.queries() if re.match(r"op\d+_|pipeline", n)]
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_headers_of_few_pages_go_and_rare_lines_stay(spark):
    rows = []
    for host, size in (("big", 300), ("small", 40)):
        for i in range(size):
            lines = [f"{host} body {i}", f"{host} more {i}"]
            for share in (0.015, 0.03, 0.09):
                if i < max(3, share * size):
                    lines.insert(0, f"header {share}")
            lines += ["on two pages"] * (i in (5, 6)) + ["on three of many"] * (host == "big" and i in (7, 8, 9))
            rows.append((len(rows), "\n".join(lines), host))
    left = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, documents(spark, rows), SF).collect()}
    rare = {"on two pages", "on three of many"}
    assert left == {i: "\n".join(x for x in t.split("\n") if "header" not in x) for i, t, _ in rows}
    assert rare <= {x for t in left.values() for x in t.split("\n")}
