import random

import numpy as np
import pytest

from tests.llm.helpers import LONG, documents, prose
from tickloom.llm import common as C
from tickloom.llm.substring_dedup import remove_repeated_windows


def slow(rows, size):
    """(doc_id, n_words, intervals, kept) by comparing windows as text."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, ws in words:
        for k in range(len(ws) - size + 1):
            key = tuple(ws[k : k + size])
            least[key] = min(least.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - size + 1):
            if least[tuple(ws[k : k + size])] < (float("inf") if i is None else i):
                gone |= set(range(k, k + size))
        spans = []
        for p in sorted(gone):
            if spans and spans[-1][1] == p:
                spans[-1][1] = p + 1
            else:
                spans.append([p, p + 1])
        out.append((i, len(ws), len(gone), [tuple(s) for s in spans], b" ".join(w for p, w in enumerate(ws) if p not in gone).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.intervals], r.kept_text) for r in df.collect()), key=str)


def mixed_rows(size):
    draw = random.Random(11)
    passage = [prose(100 + k, 2 * size) for k in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(i, draw.randrange(3 * size))]
        for _ in range(draw.randrange(3)):
            parts += [draw.choice(passage), prose(draw.randrange(10**6), draw.randrange(size))]
        rows.append((i, "\n ".join(parts)))
    rows += [(70, rows[3][1]), (71, rows[3][1]), (72, passage[0]), (72, passage[0]), (None, passage[1]), (None, passage[1])]
    return rows + [(80, None), (81, ""), (82, " \t\n"), (83, LONG), (84, LONG), (85, "a " * 300), (4, "a " * 200), (86, "é   ü x")]


@pytest.mark.parametrize("size", [3, 50])
def test_matches_brute_force(spark, size):
    rows = mixed_rows(size)
    docs = documents(spark, rows, extra=True)
    assert got(remove_repeated_windows(docs, size)) == slow(rows, size)
    assert got(remove_repeated_windows(docs, size, block_bytes=2000)) == slow(rows, size)


def test_a_document_never_removes_from_itself(spark):
    text = "x y z " * 100
    assert got(remove_repeated_windows(documents(spark, [(1, text)]), 50)) == slow([(1, text)], 50)


def test_empty_table(spark):
    assert remove_repeated_windows(documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_word_hashes_depend_on_the_word_alone():
    texts = [b"the cat", b"", b" cat\tthe\n", b"the", b"\xc3\xa9 the"]
    hashes, counts = C.word_hashes(texts)
    assert counts.tolist() == [2, 0, 2, 1, 2]
    both = [tuple(h) for h in hashes.tolist()]
    the, cat = both[0], both[1]
    assert both == [the, cat, cat, the, the, both[5], the] and len({the, cat, both[5]}) == 3
    assert C.word_hashes([])[0].shape == (0, 2) and C.word_hashes([b"", b" "])[1].tolist() == [0, 0]


def test_window_hashes_depend_on_the_words_alone():
    words, counts = C.word_hashes([b"a b c d a b c", b"x a b c"])
    for which in (0, 1):
        hashes = C.window_hashes(words, 3, which)
        assert hashes[0] == hashes[4] == hashes[8] and len(set(hashes.tolist())) == len(hashes) - 2
    assert C.whole_windows(counts, 3).tolist() == [True] * 5 + [False] * 2 + [True] * 2
    assert len(C.window_hashes(words[:2], 3)) == 0


def test_window_hashes_are_polynomials_modulo_the_prime():
    values = np.random.default_rng(1).integers(0, 2**64, 300, dtype=np.uint64)
    hasher, base = C.WindowHasher(values, 1), C.WINDOW_BASES[1]
    slow = [sum(int(v) * pow(base, k, C.PRIME) for k, v in enumerate(values[i : i + 7])) % C.PRIME for i in range(294)]
    assert hasher.every(7).tolist() == slow
    assert hasher.at(np.array([0, 100]), np.array([7, 7])).tolist() == [slow[0], slow[100]]


def thue_morse(size, letters="ab"):
    return "".join(letters[k.bit_count() % 2] for k in range(size))


def test_thue_morse_words_and_windows_differ(spark):
    """Modulo a power of two such words have one hash whatever the base."""
    a, b = thue_morse(1024), thue_morse(1024, "ba")
    assert len({tuple(h) for h in C.word_hashes([a.encode(), b.encode()])[0].tolist()}) == 2
    words = C.word_hashes([" ".join(a).encode(), " ".join(b).encode()])[0]
    assert C.window_hashes(words[:1024], 1024).tolist() != C.window_hashes(words[1024:], 1024).tolist()
    common = " ".join(f"w{k}" for k in range(49))
    rows = [(1, f"{common} {a}"), (2, f"{common} {b}"), (3, f"x {common} {a}")]
    assert got(remove_repeated_windows(documents(spark, rows), 50)) == slow(rows, 50)
