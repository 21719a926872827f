import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, documents, prose
from tickloom.llm import simhash as S
from tickloom.llm.queries import op7_simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """(doc_id, text) rows to (doc_id, fingerprint, component) by all pairs."""
    prints = [slow_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {g: min((rows[k][0] for k in range(len(rows)) if label[k] == g and rows[k][0] is not None), default=None) for g in set(label)}
    return sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, label, strict=True)), key=str)


def found(df):
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return sorted((tuple(r) for r in df.select("doc_id", hexed, "component_id").collect()), key=str)


def test_fingerprint_is_the_contracts():
    for text in ("", "One", "a b c", "A b C d", prose(1, 300), "é É ß ẞ straße x y z", LONG):
        assert S.fingerprint(text.encode()) == slow_fingerprint(text)
    assert S.fingerprint(None) == 0


def test_native_hash_agrees(spark):
    text = "the quick brown fox é"
    want = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (2**64 - 1)
    assert xxhash.xxh64_intdigest(text.encode(), 42) == want


@pytest.mark.parametrize("budget", [1, 3, 4])
def test_trie_join_finds_every_pair(budget):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**64, 400, dtype=np.uint64)
    near = base[draw.integers(0, 400, 600)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << draw.integers(0, 64, 600, dtype=np.uint64))
    values = np.unique(np.concatenate([base, near, base ^ np.uint64(1 << 40), base ^ np.uint64(0xF)]))
    want = {(int(a), int(b)) for i, a in enumerate(values) for b in values[i + 1 :] if int(a ^ b).bit_count() <= budget}
    got = set()
    for turn in (False, True):
        keys = np.sort(S._rotate(values)) if turn else values
        for i, j in S.trie_links(keys, None, 0, 0, budget // 2, budget):
            a, b = (S._rotate(keys[k]) if turn else keys[k] for k in (i, j))
            got |= {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == want and want


def linked_sets(values):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if int(values[i] ^ values[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    sets = {frozenset(int(values[k].view(np.int64)) for k in range(len(values)) if label[k] == g) for g in set(label)}
    return {g for g in sets if len(g) > 1}


def spark_sets(spark, values, **options):
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    groups = {}
    for r in S.components(S.fingerprint_links(prints, **options)).collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert all(root == min(g) for root, g in groups.items())
    return {frozenset(g) for g in groups.values()}


def flip(draw, values, times):
    for _ in range(times):
        values = values ^ (np.uint64(1) << draw.integers(0, 64, len(values), dtype=np.uint64))
    return values


def test_subtree_pairs_of_spark_find_what_brute_force_finds(spark):
    draw = np.random.default_rng(7)
    chain = [draw.integers(0, 2**64, 60, dtype=np.uint64)]
    for _ in range(4):  # chains reach further than the budget
        chain.append(flip(draw, chain[-1], 2))
    values = np.unique(np.concatenate(chain))
    for depth in (None, 2, 7):
        assert spark_sets(spark, values, depth=depth) == linked_sets(values)


@pytest.mark.parametrize(("depth", "most"), [(None, 24), (6, 12), (18, 16)])
def test_crowded_subtrees_are_taken_further_down(spark, depth, most):
    draw = np.random.default_rng(11)
    centre = draw.integers(0, 2**64, 3, dtype=np.uint64)
    # Balls around three centres, one with the same first half throughout, and values of their own.
    balls = [flip(draw, np.repeat(centre[:1], 60), 7), flip(draw, np.repeat(centre[1:2], 30), 3)]
    balls.append(centre[2] ^ draw.integers(0, 2**32, 60, dtype=np.uint64))
    values = np.unique(np.concatenate([*balls, draw.integers(0, 2**64, 60, dtype=np.uint64)]))
    seen = []
    walker = S._walker

    def watched(at, *rest):
        seen.append(at)
        return walker(at, *rest)

    S._walker = watched
    try:
        assert spark_sets(spark, values, depth=depth, most=most) == linked_sets(values)
    finally:
        S._walker = walker
    assert len(seen) > 1


def test_no_task_holds_more_than_its_share(spark):
    draw = np.random.default_rng(13)
    values = np.unique(flip(draw, np.repeat(draw.integers(0, 2**64, 1, dtype=np.uint64), 300), 12))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    sent, crowded = S._subtree_pairs(prints, 4, 2, 64)
    assert not crowded.isEmpty()
    for depth in (4, 8, 12):
        sent = S._further_down(sent, depth, 2, 4)
        keys = sent.select("turn", "low", "high", F.shiftrightunsigned("key", 64 - depth - 4).alias("own"), "upper")
        assert keys.filter(F.when(F.col("upper"), F.col("high")).otherwise(F.col("low")) != F.col("own")).isEmpty()
        assert keys.filter((F.col("low") > F.col("high")) | (F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) > 2)).isEmpty()


def test_long_chains_become_one_component(spark):
    rows = [(i, i + 1) for i in range(70)] + [(200, 201), (201, 202), (300, 300)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(71), 0), 200: 200, 201: 200, 202: 200}
    assert S.components(spark.createDataFrame([], "a long, b long")).collect() == []


def rows_of_all_kinds():
    text = prose(3, 300)
    words = text.split()
    return [
        (5, text), (2, text), (9, " ".join([*words[:150], "changed", *words[151:]])), (1, prose(4, 250)), (7, None), (3, ""), (8, " \n"),
        (None, text), (None, prose(6, 90)), (11, "One"), (12, "oNE"), (13, LONG), (1, prose(4, 250)),
    ]


def test_near_duplicates_match_brute_force(spark):
    rows = rows_of_all_kinds()
    got = S.near_duplicates(documents(spark, rows, extra=True))
    assert found(got) == slow_components(rows)
    assert {r.n_copies for r in got.filter("doc_id in (3, 7, 8)").collect()} == {3}
    assert S.near_duplicates(documents(spark, rows).limit(0)).collect() == []


def test_query_matches_brute_force_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op7_simhash(spark, sf).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == slow_components(rows)


def test_one_of_each_stays_with_all_columns(spark):
    docs = documents(spark, rows_of_all_kinds(), extra=True)
    kept = S.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 11, 13, None], key=str)
    assert S.keep_one_of_each(docs.limit(0)).collect() == []
