import hashlib
import random
import zlib

import numpy as np
import pytest

from pressroom.llm.runs import SuffixArray, find_runs, runs, runs_query


def by_hand(words):
    """Runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                found.setdefault((s, i + q - s), q)  # the smallest period comes first
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = altered(doc_id, (text or "").encode().split())
    found = by_hand(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def pieces(rng):
    """Words with planted repetitions, some of them cut, nested or side by side."""
    out = []
    for _ in range(rng.randint(1, 6)):
        unit = [rng.randrange(3) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 20]))]
        if rng.random() < 0.3:
            unit = unit * 4 + [rng.randrange(3)]
        out += (unit * 12)[:rng.randint(1, 5 * len(unit) + 30)]
        out += [rng.randrange(40) for _ in range(rng.randint(0, 4))]
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_as_by_hand(seed):
    words = pieces(random.Random(seed))
    assert runs(np.array(words)) == by_hand(words)


def test_one_word_over_and_over():
    assert runs(np.zeros(3000, np.int64)) == [(0, 3000, 1)]
    assert runs(np.arange(100)) == [] and runs(np.zeros(23, np.int64)) == []


def test_suffix_array():
    values = np.random.default_rng(1).integers(0, 3, 400)
    array = SuffixArray(values)
    assert array.sa.tolist() == sorted(range(400), key=lambda i: values[i:].tolist())
    shared = [-1]
    for a, b in zip(array.sa, array.sa[1:]):
        k = 0
        while max(a, b) + k < 400 and values[a + k] == values[b + k]:
            k += 1
        shared.append(k)
    assert array.lcp().tolist() == shared


def test_query_as_by_hand(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = [f"w{w}" for w in pieces(rng)]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    got = {r.doc_id: tuple(r) for r in runs_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: expected(i, text) for i, text in rows}


def test_odd_rows(spark, odd, none):
    rows = odd.collect()
    got = sorted(map(tuple, runs_query(odd).collect()), key=repr)
    short = [r for r in rows if len((r.text or "").split()) < 2000]
    assert set(map(repr, (expected(r.doc_id, r.text) for r in short))) <= set(map(repr, got))
    assert len(got) == len(rows)
    assert runs_query(none).count() == 0 and find_runs(none).count() == 0


def test_a_text_of_several_pieces(spark):
    unit = " ".join(f"word{i}" for i in range(70_000))
    rows = [(1, f"start {unit} {unit} {unit} word0 end"), (2, "ha " * 400_000)]
    got = {r.doc_id: r for r in find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 210_001, 70_000)]
    assert got[1].collapsed == f"start {unit} end"
    assert [tuple(r) for r in got[2].runs] == [(0, 400_000, 1)] and got[2].collapsed == "ha"
