import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import runs

SMALL = "/root/testdata/sf0.001"


def by_force(words, least=12):
    """All runs by trying every period at every place, and the places of the words that stay."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            own = words[i : j + q]
            if len(own) >= max(least, 2 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                found.append((i, len(own), q))
            i = j
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return sorted(found, key=lambda x: (x[0], x[2])), [w for k, w in enumerate(words) if k not in gone]


def some_words(r):
    n = r.randint(1, 70)
    words = [r.randrange(r.choice([1, 2, 3, 30])) for _ in range(n)]
    if r.random() < 0.5:
        a, p = r.randrange(n), r.randint(1, max(1, n // 3))
        for i in range(a, n):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("least", [2, 12])
def test_runs_same_as_by_force(least):
    r = random.Random(1)
    for _ in range(600):
        words = some_words(r)
        assert [tuple(x) for x in runs.runs_in(np.array(words), least).tolist()] == by_force(words, least)[0]


def test_what_is_left_out_of_the_trees_has_no_runs():
    r, found = random.Random(2), 0
    for _ in range(600):
        words = [*some_words(r), *range(100, 100 + r.randint(0, 9)), *some_words(r)]
        part = runs.stretches(np.array(words), np.zeros(len(words), np.int64))
        got, kept = runs._of_document(np.array(words), part)
        want, left = by_force(words)
        found += len(want)
        assert [tuple(x) for x in got.tolist()] == want and [w for w, k in zip(words, kept, strict=True) if k] == left
    assert found > 100


def test_least_of_stretches():
    r = np.random.default_rng(3)
    for n in (1, 15, 16, 17, 300):
        values = r.integers(0, 50, n)
        a, b = np.sort(r.integers(0, n, (2, 200)), axis=0)
        assert runs.Least(values).of(a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b, strict=True)]


def test_documents_of_all_kinds(spark):
    long = " ".join(f"w{i % 40_000}" for i in range(100_000))
    texts = [None, "", " \t\n", "one", "a b " * 3, "a b " * 6, "a b " * 12, "é ü\tö\n" * 5 + "é", "x " * 12, "x " * 11, long, "the same " * 40 + "and " + "again and again " * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[5]), (5, texts[5]), (None, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS collapsed")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.runs(docs.repartition(3)).collect())
    want = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        if text == long:
            found, left = [(0, 100_000, 40_000)], words[:40_000]
        else:
            found, left = by_force(words)
        want.append((doc_id is None, doc_id or 0, len(words), found, b" ".join(left).decode()))
    assert got == sorted(want)
    assert runs.runs(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_registered_query_of_runs(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in runs.op12_periodic_runs(spark, SMALL).collect()}
    assert set(got) == set(docs)
    with_runs = 0
    for doc_id, text in docs.items():
        words = (text or "").encode().split()
        if len(words) > 700:
            continue
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found, left = by_force(words)
        with_runs += bool(found)
        r = got[doc_id]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(left)).hexdigest()
    assert with_runs > 5
