import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import LONG, by_id, documents, prose
from tickloom.llm import common as C
from tickloom.llm import periodic_runs as R
from tickloom.llm.queries import op13_periodic_runs


def slow_runs(words, least=12, repeats=2):
    """Every lag, every diagonal, every smaller period."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            length, stretch = j - i + q, words[i - q : j]
            if j > i and length >= max(least, repeats * q):
                if not any(all(stretch[k] == stretch[k - d] for k in range(d, length)) for d in range(1, q)):
                    out.append((i - q, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return [w for k, w in enumerate(words) if k not in gone]


def some_words(draw):
    n, kind = draw.randrange(140), draw.randrange(5)
    if kind == 0:
        return [draw.randrange(2) for _ in range(n)]
    if kind == 1:
        return [draw.randrange(1000) for _ in range(n)]
    if kind == 2:
        return [0] * n
    words = []
    while len(words) < n:
        block = [draw.randrange(4) for _ in range(draw.randrange(1, 20 if kind == 3 else 9))]
        words += block * draw.randrange(1, 8)
    if kind == 3:
        words[draw.randrange(len(words)) if words else 0 : 0] = [9]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_those_of_brute_force(seed, monkeypatch):
    draw = random.Random(seed)
    if seed % 3 == 0:
        monkeypatch.setattr(R, "_AT_ONCE", 16)
    texts = [some_words(draw) for _ in range(draw.randrange(6))]
    least, repeats = draw.choice([(12, 2), (12, 2), (1, 2), (5, 3)])
    found = R.find_runs(np.array(sum(texts, []), np.int32), np.array([len(t) for t in texts], np.int64), least, repeats)
    assert [[tuple(r) for r in f.tolist()] for f in found] == [slow_runs(t, least, repeats) for t in texts]


def test_hot_words_and_nested_runs_cost_no_more(monkeypatch):
    """Half a million equal words, a run of runs, and the Thue-Morse word; places compared stay within 2n per level."""
    compared = []
    real = np.maximum
    monkeypatch.setattr(R.np, "maximum", lambda a, b: compared.append(np.size(a)) or real(a, b))
    n = 1 << 19
    assert R.find_runs(np.zeros(n, np.int32), np.array([n]))[0].tolist() == [[0, n, 1]]
    assert sum(compared) <= 2 * n * 20 + 3 * n
    k = 20_000
    words = np.zeros(3 * k + 2, np.int32)
    words[[k, 2 * k + 1]] = 1
    assert R.find_runs(words, np.array([len(words)]))[0].tolist() == [
        [0, k, 1], [0, 3 * k + 2, k + 1], [k + 1, k, 1], [2 * k + 2, k, 1],
    ]
    thue_morse = [k.bit_count() % 2 for k in range(2000)]
    assert [tuple(r) for r in R.find_runs(np.array(thue_morse, np.int32), np.array([2000]))[0].tolist()] == slow_runs(thue_morse)


def test_a_bad_base_is_given_up(monkeypatch):
    real = C.WindowHasher.at
    monkeypatch.setattr(C.WindowHasher, "at", lambda self, starts, size: real(self, starts, size) * np.uint64(self.inverse[1] != base))
    base = C._powers(C.WINDOW_BASES[0], 2)[1][1]
    words = [0, 1, 2, 3, 4, 5, 6] * 3 + [8] + [0, 1, 2, 3, 4, 5, 6] * 2
    got = R.find_runs(np.array(words, np.int32), np.array([len(words)]))[0]
    assert [tuple(r) for r in got.tolist()] == slow_runs(words)


ROWS = [
    (1, None), (2, ""), (3, "a"), (4, " \n\t"), (5, "la " * 40), (6, prose(6, 300)), (7, "x " + "one two three " * 9 + "y"),
    (8, "ab c é \x0b" * 12), (9, (prose(9, 30) + " ") * 3 + prose(9, 5)), (9, (prose(9, 30) + " ") * 3 + prose(9, 5)),
    (None, "z z " * 20), (10, LONG), (11, "a " * 30_000), (12, " ".join("ab"[k.bit_count() % 2] for k in range(300))),
]


def test_odd_rows_pass_whole(spark):
    docs = documents(spark, ROWS, extra=True)
    got = R.with_runs(docs, "found")
    assert got.columns == [*(c for c in docs.columns if c != "found"), "found"]
    for row in got.collect():
        words = (row.text or "").encode().split()
        runs = [tuple(r) for r in row.found.runs]
        assert row.found.n_words == len(words)
        assert runs == ([(0, 30_000, 1)] if row.doc_id == 11 else slow_runs(words) if len(words) < 1000 else [])
        assert row.found.collapsed.encode() == (b"a" if row.doc_id == 11 else b" ".join(kept(words, runs)))
    assert R.with_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        R.with_runs(docs, repeats=1)


def slow_query(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    first = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(first or (None,) * 3), 1000 * first[1] // first[2] if first else None,
        sha("".join(f"{s},{l},{p}\n" for s, l, p in runs).encode()), sha(b" ".join(kept(words, runs))),
    )


def test_query_equals_brute_force_with_its_periodic_tails(spark, tmp_path):
    """Ids whose checksum divides by ten and others, short and odd texts among them."""
    tailed = [k for k in range(800) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = [(k, prose(k, 20 + 7 * k % 260)) for k in tailed[:30]] + [(k, prose(k, 60, 6)) for k in tailed[30:36] + [900, 901]]
    rows += [(tailed[36], None), (tailed[37], ""), (tailed[38], "one"), (tailed[0], prose(7, 90)), (None, prose(3, 40) + " q" * 14)]
    rows += [(k, t) for k, t in ROWS if k not in (10, 11)]
    documents(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted((slow_query(*r) for r in rows), key=str)


def test_query_gives_every_document_a_row(spark):
    sf = "/root/testdata/sf0.001"
    source = by_id(spark.read.parquet(f"{sf}/documents.parquet"), "text")
    found = op13_periodic_runs(spark, sf).collect()
    assert sorted(r.doc_id for r in found) == sorted(source)
    for row in found:
        if len((source[row.doc_id] or "").split()) < 250:
            assert tuple(row) == slow_query(row.doc_id, source[row.doc_id])
