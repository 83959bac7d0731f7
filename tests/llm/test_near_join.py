import random

import numpy as np
import pytest

from ledgerloom.llm import near_join
from ledgerloom.llm.shared import connected


def corpus(seed: int, n: int = 60, words: int = 60):
    """Base texts, near copies with a few words changed, exact copies and unlike texts that share a passage."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choices(vocabulary, k=15))
    out = []
    for _ in range(n):
        text = r.choices(vocabulary, k=words)
        out.append(" ".join(text))
        for _ in range(r.choice([0, 0, 1, 3])):
            near = list(text)
            for _ in range(r.choice([0, 1, 1, 2, 6])):
                near[r.randrange(words)] = r.choice(vocabulary)
            out.append(" ".join(near))
        if r.random() < 0.3:
            out.append(passage + " " + " ".join(r.choices(vocabulary, k=words)))
    return out


def own_shingles(text):
    words = (text or "").lower().split()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, similarity=0.8):
    """(class_id, n_links, n_copies) of each row, in order."""
    found = [own_shingles(t) for _, t in rows]
    sets = sorted({x for x in found if x}, key=sorted)
    links, parent = [0] * len(sets), list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared >= similarity * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    place = {x: k for k, x in enumerate(sets)}
    least = {}
    for (i, _), x in zip(rows, found, strict=True):
        if x and i is not None:
            least[root(place[x])] = min(i, least.get(root(place[x]), i))
    return [(least.get(root(place[x])), links[place[x]], found.count(x)) if x else (i, 0, 1) for (i, _), x in zip(rows, found, strict=True)]


def same(spark, rows, parts=3, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rep", "2 AS key", "3 AS n", "4 AS row", "5 AS tie", "6 AS root").repartition(parts)
    key = lambda x: tuple((v is None, v) for v in x)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in near_join.near_duplicates(docs, **more).collect()), key=key)
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute(rows, **{k: v for k, v in more.items() if k == "similarity"}), strict=True)), key=key)
    assert got == want
    return want


def test_shingles_are_those_of_the_words():
    text = "A b  c\nd E f g"
    assert len(near_join.shingles(text)) == 3
    assert near_join.shingles("a B c d e f g").tolist() == near_join.shingles(text).tolist()
    assert len(near_join.shingles("just four words here")) == 1 and len(near_join.shingles(" \n")) == 0
    long = " ".join(f"x{i % 977}" for i in range(100_000))
    assert len(near_join.shingles(long)) == 977


def test_same_as_brute_force(spark):
    rows = list(enumerate(corpus(1)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "short text"), (1004, "Short  text"), (1005, "word " * 30_000), rows[3], (None, "no id"), (None, rows[0][1])]
    assert any(x[2] > 1 for x in same(spark, rows))


def test_one_doc_id_and_different_texts(spark):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join(reversed(words))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, a + " z"), (None, None), (None, "only here")]
    want = same(spark, rows, 2)
    assert [x[2] for x in want if x[0] == 1] == [2, 1] or [x[2] for x in want if x[0] == 1] == [1, 2]


def test_lower_similarity(spark):
    same(spark, list(enumerate(corpus(6, n=40, words=40))), similarity=0.6)


def test_large_group_of_near_copies(spark, monkeypatch):
    r = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(700):  # far more than a bucket
        text = list(base)
        for _ in range(2):
            text[r.randrange(120)] = f"n{r.randrange(50)}"
        rows.append((i, " ".join(text)))
    same(spark, rows)
    monkeypatch.setattr(near_join, "TILE_SETS", 100)  # and more than some tiles, by sets
    same(spark, rows[:450])
    monkeypatch.setattr(near_join, "TILE_SETS", 2000)
    monkeypatch.setattr(near_join, "TILE_GRAMS", 10_000)  # or by n-grams
    same(spark, rows[:450])


def test_recall_at_the_threshold(spark):
    """300 pairs of sets whose similarity is 0.80 to 0.82, among 4,000 others: at least 0.99 of the links are found."""
    r = random.Random(3)
    rows = []
    for k in range(300):
        text = [f"p{k}w{i}" for i in range(400)]
        near = list(text)
        for at in r.sample(range(10, 390), 200):
            near[at] = f"q{k}w{at}"
            a, b = own_shingles(" ".join(text)), own_shingles(" ".join(near))
            if len(a & b) / len(a | b) < 0.82:
                break
        shared = len(a & b) / len(a | b)
        if shared < 0.8:
            near[at] = text[at]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(near))]
    rows += [(1000 + i, " ".join(f"o{r.randrange(10**6)}" for _ in range(40))) for i in range(4000)]
    got = near_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("doc_id < 600").collect()
    assert np.mean([x.n_links == 1 for x in got]) >= 0.99


def test_empty_table(spark):
    assert near_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_counts():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, r.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    want = [[len(set(a.tolist()) & set(b.tolist())) if i != j else None for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    got = near_join.common(sets)
    assert all(want[i][j] is None or got[i, j] == want[i][j] for i in range(30) for j in range(30))


def test_runs_follow_the_recall():
    assert near_join.runs_for(0.9) < near_join.runs_for(0.99) < near_join.runs_for(0.9999)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 3), (20, 21)] + [(100, k) for k in range(101, 160)] + [(k, k + 1) for k in range(200, 230)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in (1, 2, 3)} == {1} and {got[k] for k in (7, 8, 9)} == {7} and got[21] == 20
    assert {got[k] for k in range(100, 160)} == {100} and {got[k] for k in range(200, 231)} == {200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def between_two_groups(seed: int, copies: int):
    """Sets A and B, alike to each other, in one half each alike to the copies of one group."""
    r = random.Random(seed)
    sets = [r.sample(range(10**9), 800)]  # the first group's base
    a = sets[0][:686] + r.sample(range(10**9), 114)  # 0.75 to the base
    b = a[:0] + a[89:] + r.sample(range(10**9), 89)  # 0.80 to A
    second = b[:0] + b[119:] + r.sample(range(10**9), 119)  # 0.74 to B
    groups = []
    for base in (sets[0], second):
        for _ in range(copies):
            groups.append(base[:-2] + r.sample(range(10**9), 2))
    return [np.sort(near_join.splitmix(np.array(x, np.uint64))) for x in [a, b, *groups]]


def held_together(spark, seeds, copies):
    rows = []
    for k, seed in enumerate(seeds):
        rows += [(k * 10**6 + i, bytearray(near_join.sketch(x).tobytes())) for i, x in enumerate(between_two_groups(seed, copies))]
    edges = near_join.candidate_edges(spark.createDataFrame(rows, "rep long, sketch binary"))
    root = {r.node: r.root for r in connected(edges).collect()}
    pairs = [(k * 10**6, k * 10**6 + 1) for k in range(len(seeds))]
    return sum(a in root and root[a] == root.get(b) for a, b in pairs), len(pairs)


def test_pairs_between_two_groups(spark):
    found, pairs = held_together(spark, range(30), 60)
    assert found == pairs


def test_pairs_between_two_groups_in_buckets_that_spark_splits(spark, monkeypatch):
    monkeypatch.setattr(near_join, "GATHER", 50)
    found, pairs = held_together(spark, range(12), 60)
    assert found == pairs


def templated(share: float, n: int, pairs: int, seed: int):
    """Sets of 200 numbers that share so many of a template, of which the first ones come in pairs at 0.85."""
    r = random.Random(seed)
    base = r.sample(range(10**9), int(200 * share))
    sets = []
    for k in range(n):
        if k < 2 * pairs and k % 2:
            sets.append(sets[-1][:-16] + r.sample(range(10**9), 16))
        else:
            sets.append(base + r.sample(range(10**9), 200 - len(base)))
    return sets


@pytest.mark.parametrize("share", [0.0, 0.75])
def test_a_shared_template_makes_no_groups(spark, share, monkeypatch):
    """Ties are those of links, however many sets share most of a template, at whatever depth of the splits."""
    monkeypatch.setattr(near_join, "GATHER", 700)
    pairs, most = 80, []
    for n in (500, 1200):
        sets = [np.sort(near_join.splitmix(np.array(x, np.uint64))) for x in templated(share, n, pairs, n)]
        rows = [(i, bytearray(near_join.sketch(x).tobytes())) for i, x in enumerate(sets)]
        edges = near_join.candidate_edges(spark.createDataFrame(rows, "rep long, sketch binary").repartition(4))
        groups = {}
        for r in connected(edges).collect():
            groups.setdefault(r.root, set()).add(r.node)
        most.append(max(map(len, groups.values())))
        together = {x: root for root, group in groups.items() for x in group}
        assert sum(together.get(2 * k, -1) == together.get(2 * k + 1, -2) for k in range(pairs)) >= 0.99 * pairs
    assert max(most) <= 4, most


def test_bytes_verify_what_is_alike():
    r = random.Random(5)
    for size in (3, 40, 300, 5000):
        held = {0.4: 0, 0.6: 0, 0.8: 0, 0.9: 0}
        for similarity in held:
            for _ in range(60):
                same = round(2 * size * similarity / (1 + similarity))
                x = r.sample(range(10**12), size)
                y = x[:same] + r.sample(range(10**12), size - same)
                a, b = (near_join.sketch(np.sort(near_join.splitmix(np.array(z, np.uint64))))[None] for z in (x, y))
                held[similarity] += near_join.verified(a, np.zeros(1, int), b, np.zeros(1, int), 0.8).item()
        assert held[0.9] == 60 and (size < 40 or held[0.8] == 60) and (size < 300 or held[0.4] == 0) and (size < 5000 or held[0.6] == 0), (size, held)
