"""WARC archives, token counts and language-model scores."""

import gzip
import hashlib
import io
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, by_id, documents, prose
from tickloom.llm import lm_scoring as M
from tickloom.llm import warc as A
from tickloom.llm.common import new_folder
from tickloom.llm.queries import op4_lm_scoring, op5_token_counts, tokenizer_path
from tickloom.llm.token_counts import TokenCounter, frequent_lengths, token_counts, unassigned_characters

# --- WARC -------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("offset", F.lit("x")).withColumn("salt", F.lit(1))


def page_rows():
    big, other = "<p>é" + "x" * 1200, prose(1, 400)
    return [
        (1, "http://a/ö x\r\nHost: y", big), (2, None, big), (9, "u", big), (9, "u", big), (None, "u", big), (3, "", "short"), (4, "u", "short"),
        (5, "u", None), (6, "u", ""), (7, "u", other), (8, "u", "WARC/1.1\r\n\r\n" + other), (10, "u", LONG), (11, "u", "\r\n\r\n" * 300), (12, "u", "\r\n\r\n" * 300),
        (None, "u", "n" * 1000), (None, "u", "n" * 1000), (13, "u", "é" * 500), (14, "u", "é" * 500), (15, "u", "y" * 999), (16, "u", "y" * 999),
    ]


def expected(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        latest = max(ids, default=None) if len(body) >= 1000 else None
        old = latest is not None and i != latest
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if old else "response", latest if old else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [1, 100, 1500, 1 << 24])
def test_archives_give_back_what_was_written(spark, split):
    rows = page_rows() if split > 1 else [r for r in page_rows() if len(r[2] or "") < 2000][:6]
    got = A.archive_pages(pages(spark, rows), split_bytes=split)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_payloads_and_headers_round_trip(spark):
    folder = new_folder(spark, "warc-test")
    manifest = A.write_warc(A.mark_revisits(pages(spark, page_rows())), folder)
    records = A.read_warc(manifest, 700).collect()
    assert sum(r.n_records for r in manifest.collect()) == len(page_rows())
    html = {i: h for i, _, h in page_rows()}
    own = [r for r in records if r.record_type == "response" and r.page_id is not None]
    assert own and all(r.payload.decode() == (html[r.page_id] or "") and r.payload_digest == r.computed_digest for r in own)
    assert all(r.payload is None and r.refers_to is not None for r in records if r.record_type == "revisit")
    assert {r.record_type for r in records} == {"response", "revisit", "warcinfo"}
    assert next(r for r in records if r.page_id == 1).target_uri == "http://a/%C3%B6%20x%0D%0AHost:%20y"


def test_pages_with_long_urls_are_read_back(spark):
    rows = [(1, "http://a/" + "é" * 20_000, "first"), (2, "u" * 200_000, "x" * 1200), (3, "u", "x" * 1200), (4, "中" * 9_000, "y" * 1200), (5, "中" * 9_000, "y" * 1200)]
    assert sorted(map(tuple, A.archive_pages(pages(spark, rows), split_bytes=700).collect()), key=str) == expected(rows)


def test_no_pages(spark):
    assert A.archive_pages(pages(spark, page_rows()).limit(0)).collect() == []


def record(body, kind="response"):
    return gzip.compress(f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")


def test_ranges_own_what_starts_in_them():
    noise = b"\x1f\x8b\x08not gzip" + gzip.compress(b"no record") + b"\x1f\x8b"
    data = record(b"a" * 50) + noise + record(bytes(range(256)) * 40) + record(b"") + b"\x1f\x8b\x08" + record(b"z")
    whole = [o for o, _ in A.records_in_range(io.BytesIO(data), 0, len(data))]
    assert len(whole) == 4
    for size in (1, 7, 64, len(data)):
        parts = [o for lo in range(0, len(data), size) for o, _ in A.records_in_range(io.BytesIO(data), lo, lo + size)]
        assert parts == whole
    assert list(A.records_in_range(io.BytesIO(data[:-20]), whole[-1], len(data))) == []  # cut off


def test_a_very_long_record_is_read_in_pieces():
    body = np.random.default_rng(1).integers(0, 256, 40 << 20, np.uint8).tobytes()
    data = record(b"first") + record(body) + record(b"last")
    found = list(A.records_in_range(io.BytesIO(data), 0, len(data)))
    assert [len(r) - A.parse_header(r)[1] - 4 for _, r in found] == [5, len(body), 4]
    assert hashlib.sha1(found[1][1][A.parse_header(found[1][1])[1] : -4]).digest() == hashlib.sha1(body).digest()


def test_damaged_archives_are_an_error(spark):
    folder = new_folder(spark, "warc-test")
    manifest = A.write_warc(A.mark_revisits(pages(spark, page_rows())), folder)
    assert A.read_pages(manifest).count() == len(page_rows())
    path = manifest.orderBy(F.desc("n_records")).first()["path"]
    with open(path, "r+b") as file:
        data = file.read()
        at = data.rindex(A.GZIP_MAGIC)
        file.seek(at)
        file.write(bytes(len(data) - at))
    with pytest.raises(A.MissingRecords, match=re.escape(path)):
        A.read_pages(manifest)


# --- token counts -----------------------------------------------------------------------------

TEXTS = [
    None, "", " ", "  \n\n  x", "It's we'll THEY'RE 'd", "naïve café 中文 日本語 한국어 🎉👩‍👩‍👧", "a<|endoftext|>b <|endoftext|>", "<|endoftext", "x" * 3000,
    "՘₏ new \U0001e6c0 letters", "1234567 12,5 ½ ²", "tab\tand nbsp　wide", LONG, "end  ", "\x00\x01\x7f",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_counts_are_the_librarys(spark, tokenizer):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "null id")]
    want = sorted(((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    docs = documents(spark, rows, extra=True)
    for entries in (500_000, 2):
        got = token_counts(docs, tokenizer_path(), "counted", cache_entries=entries)
        assert got.columns == [*docs.columns, "counted"]
        assert sorted(((r.doc_id, r.counted.n_bytes, r.counted.n_tokens) for r in got.collect()), key=str) == want
    assert token_counts(docs.limit(0), tokenizer_path()).collect() == []


def test_query_counts_the_small_tables_as_the_library(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    assert by_id(op5_token_counts(spark, sf), "n_tokens") == want


def test_the_table_holds_lengths_of_whole_pre_tokens(tokenizer):
    frequent = frequent_lengths(tokenizer, tokenizer.get_vocab(), unassigned_characters())
    assert frequent[" the"] == 1 and len(frequent) <= tokenizer.get_vocab_size() and "<|endoftext|>" not in frequent
    counter = TokenCounter(tokenizer, frequent, ["<|endoftext|>"], unassigned_characters(), most=10)
    assert counter.count("zqxj " * 30 + " ".join(f"q{i}zx" for i in range(40))) == len(tokenizer.encode("zqxj " * 30 + " ".join(f"q{i}zx" for i in range(40))).ids)
    assert len(counter.lengths) <= len(frequent) + 10


def test_unassigned_characters_are_tested_once_per_pre_token(tokenizer):
    """Each different pre-token is judged on its first miss; a text that holds one goes to the library whole."""
    tested = []
    counter = TokenCounter(tokenizer, {}, [], unassigned_characters())
    search = counter.lengths.unassigned.search

    class Watched:
        def search(self, text):
            tested.append(text)
            return search(text)

    counter.lengths.unassigned = Watched()
    for text in ["é à \U000105c0 x", "é " * 300 + "\u0378", "à" * 300 + " é", "plain"] * 2:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
    short = [t for t in tested if len(t) <= 256]
    assert len(short) == len(set(short)) and all(not t.isascii() for t in tested)
    assert max(map(len, counter.lengths)) <= 256


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError, match="byte-level"):
        token_counts(documents(spark, [(1, "a")]), tokenizer_path("word_bpe_49k.json"))


# --- language models --------------------------------------------------------------------------


def slow_model(rows, frequent):
    """Brute force: ``loss(text)`` of the class bigram model for target and background, from (text, is_target)."""
    def tokens(text):
        return [*[w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w], M.END]

    everything = [t for text, _ in rows for t in tokens(text)]
    own = {w for w, n in Counter(everything).items() if n >= frequent * len(everything)} | {M.END}

    def class_of(w):
        return w if w in own else M.shape(len(w), w[-1])

    vocabulary = Counter(class_of(w) for w in set(everything))
    models, matched = [], sum(len(tokens(t)) for t, flag in rows if flag) / max(1, len(everything)) or 1.0
    for wanted, scale in ((lambda flag: flag, 1), (lambda flag: True, matched)):
        word, single, pair = Counter(), Counter(), Counter()
        for text, flag in rows:
            if wanted(flag):
                before = M.END
                for w in tokens(text):
                    c = class_of(w)
                    word[w] += scale
                    single[c] += scale
                    pair[before, c] += scale
                    before = c
        models.append((word, single, pair))

    def loss(text, which):
        word, single, pair = models[which]
        total, before = 0.0, M.END
        for w in tokens(text):
            c = class_of(w)
            p = (single[c] + 1) / (sum(single.values()) + len(vocabulary) + 1)
            p = (pair[before, c] + M.TRUST * p) / (single[before] + M.TRUST)
            total -= np.log(p if w in own else p * (word[w] + 1) / (single[c] + vocabulary[c] + 1))
            before = c
        return total / len(tokens(text)), len(tokens(text))

    return loss


@pytest.mark.parametrize(("most_hot", "frequent"), [(1 << 20, 2**-14), (1 << 20, 0.01), (0, 0.01), (7, 0.02)])
def test_losses_match_brute_force(spark, most_hot, frequent):
    """Whichever corrections go to the workers, and however many classes there are."""
    texts = [None, "", "ab cd ab ef", "ab cd", "xyz \x00 é\tü", prose(1, 80), "ab cd ab ef", " \n ", "ab " * 300, "word" * 5000, prose(2, 400, 9)]
    rows = list(enumerate(texts))
    labels = spark.createDataFrame([(2, 1, 0), (3, 1, 0), (3, 1, 1), (5, 1, None), (6, 1, 0), (6, 1, 0), (None, 1, 0), (0, 1, 0), (10, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, [*rows, (None, "ab cd ab ef"), (6, "ab cd ab ef")], extra=True)
    training = M.good_documents(docs, labels)
    assert training.filter("is_target").count() == 5  # 0, 2, 6 twice and 10
    # Two texts that no training row holds, one of them with a shape of its own.
    more = documents(spark, [(100, "ab new nEw ef"), (101, "ab 中中中中 ~~~~~~")], extra=True)
    scored = docs.union(more).withColumns({c: F.lit("extra") for c in ("m1", "m2", "d1", "k1", "n", "_made", "n_tokens")})
    got = M.cross_entropy_difference(scored, training, "scored", most_hot=most_hot, frequent=frequent).collect()
    loss = slow_model([(t, i in (0, 2, 6, 10)) for i, t in [*rows, (None, texts[2]), (6, texts[2])]], frequent)
    assert len(got) == len(texts) + 4 and set(got[0].asDict()) == {*scored.columns, "scored"}
    for r in got:
        target, n = loss(r.text, 0)
        assert r.scored.n_tokens == n
        assert r.scored.target_loss == pytest.approx(target, rel=1e-9)
        assert r.scored.background_loss == pytest.approx(loss(r.text, 1)[0], rel=1e-9)
        assert r.scored.score == pytest.approx(r.scored.target_loss - r.scored.background_loss, abs=1e-12)


def test_no_training_rows(spark):
    docs = documents(spark, [(1, "abc"), (2, LONG), (3, None)])
    none = docs.select("text", F.lit(None).cast("boolean").alias("is_target")).limit(0)
    rows = M.cross_entropy_difference(docs, none).collect()
    assert all(abs(r.lm.target_loss) < 1e-9 and abs(r.lm.score) < 1e-9 for r in rows)
    assert {r.doc_id: r.lm.n_tokens for r in rows} == {1: 2, 2: 40_001, 3: 1}
    assert M.cross_entropy_difference(docs.limit(0), none).collect() == []
    assert M.cross_entropy_difference(docs.limit(0), docs.select("text", F.lit(True).alias("is_target"))).collect() == []
    # Without a target its model is uniform over the classes.
    alone = docs.select("text", F.lit(None).cast("boolean").alias("is_target")).filter("doc_id = 1")
    got = {r.doc_id: r.lm for r in M.cross_entropy_difference(docs, alone).collect()}
    assert got[1].target_loss == pytest.approx(np.log(3)) and got[1].score > 0


def test_the_most_frequent_entries_are_hot(spark):
    found = spark.createDataFrame([(k,) for k in [1] * 50 + [2] * 9 + [40, 41, 1000]], "total long")
    assert [M.hot_limit(found, most) for most in (0, 1, 2, 3, 12, 61, 62, 100)] == [1001, 1000, 1000, 40, 2, 2, 1, 1]
    assert M.hot_limit(found.limit(0)) == 1


def test_what_is_gathered_grows_with_the_input(spark):
    sizes = []
    for sf in ("0.001", "0.01"):
        docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
        sizes.append(M.count_words(docs.select("text", F.lit(True).alias("is_target"))).count())
    assert sizes[1] > 2 * sizes[0]


def test_good_documents_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    rows = op4_lm_scoring(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.median(good) < np.median(bad)
    order = np.argsort(np.argsort(good + bad))
    auc = (order[len(good) :].sum() - len(bad) * (len(bad) - 1) / 2) / (len(good) * len(bad))
    assert auc > 0.8


def test_bigrams_do_not_cross_documents():
    tokens = M.Tokens([b"a bb", b"", b"a"])
    before, after, own = tokens.bigrams(tokens.classes(np.zeros(0, np.int64)))
    a, b = M.shape(1, ord("a")), M.shape(2, ord("b"))
    assert list(zip(before[own], after[own], strict=True)) == [(M.END, a), (a, b), (b, M.END), (M.END, M.END), (M.END, a), (a, M.END)]
    assert tokens.n.tolist() == [3, 1, 2] and tokens.starts.tolist() == [0, 3, 4]


def test_a_worker_holds_a_few_megabytes_of_a_batch():
    """However much text a batch has, its texts and their arrays come and go in slices; copies count once in the scores."""
    texts = [prose(k, 7000) for k in range(500)] + [None, "", prose(1, 7000)]
    ids = pa.array([*range(len(texts) - 1), 1])
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([k % 2 == 0 for k in range(len(texts))]), ids, ids], names=["text", "is_target", "d1", "d2"])
    size = sum(len(t or "") for t in texts)
    assert size > 15 << 20
    classes, hot = M.Classes([], np.zeros(0, np.int64), 1.0), M.Hot(*(np.zeros(0, t) for t in (np.int64, np.int64, float, float)))
    tracemalloc.start()
    try:
        n_tokens = sum(tokens.n.sum() for tokens, _ in M._tokens(iter([batch])))
        counted = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        n_scored = sum(part.column("n_tokens").to_numpy().sum() for part in M.score_batch(batch.drop_columns("is_target"), classes, hot))
        scored = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n_tokens == 501 * 7001 + 2 and n_scored == 500 * 7001 + 2
    assert max(counted, scored) < 120 << 20
