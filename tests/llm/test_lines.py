import random
import re

import pytest

from ledgerloom.llm import line_chunks


def lines_of(text):
    """Own wrapping: a line ends at a line feed, at the first sentence end from 12 words on, or at 24 words."""
    out = []
    for line in (text or "").split("\n"):
        words, held = line.split(" "), []
        left = len(words)
        for k, word in enumerate(words):
            held.append(word)
            left -= 1
            if len(held) == 24 or (len(held) >= 12 and re.search(r"[.!?]$", word)) :
                out.append(" ".join(held))
                held = []
        if held:
            out.append(" ".join(held))
    return [x for x in out if x.strip()]


def brute(rows):
    """(texts with every pair of lines gone that an earlier place has, places of lines in repeated runs of three) by doc_id."""
    first, first_three = {}, {}
    order = sorted(rows, key=lambda r: r[0])
    for doc_id, text in order:
        lines = lines_of(text)
        for i in range(len(lines) - 1):
            first.setdefault(tuple(lines[i : i + 2]), doc_id)
        for i in range(len(lines) - 2):
            first_three.setdefault(tuple(lines[i : i + 3]), doc_id)
    most, least = {}, {}
    for doc_id, text in order:
        lines, gone, surely, seen = lines_of(text), set(), set(), {}
        for i in range(len(lines) - 1):
            pair = tuple(lines[i : i + 2])
            if first[pair] != doc_id or i >= seen.setdefault(pair, i) + 2:
                gone |= {i, i + 1}
        for i in range(len(lines) - 2):
            if first_three[tuple(lines[i : i + 3])] != doc_id:
                surely |= {i, i + 1, i + 2}
        most[doc_id] = [x for k, x in enumerate(lines) if k not in gone]
        least[doc_id] = [x for k, x in enumerate(lines) if k not in surely]
    return most, least


def corpus():
    r = random.Random(4)
    word = lambda: r.choice("red green blue grey tall small old new".split()) + str(r.randrange(90)) + r.choice(["", "", "", "", "."])
    line = lambda n: " ".join(word() for _ in range(n))
    passages = ["\n".join(line(r.randint(2, 9)) for _ in range(6)) for _ in range(4)] + [line(60) for _ in range(3)] + [line(5) + "\n" + line(6)]
    rows = []
    for i in range(80):
        parts = [line(r.choice([1, 5, 12, 40])) for _ in range(r.randint(0, 6))] + r.sample(passages, r.randint(0, 2))
        r.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    return rows, passages


def cleaned(spark, rows):
    return {r.doc_id: r for r in line_chunks.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}


def within(short, long):
    """Is ``short`` what is left of ``long`` after some lines have gone?"""
    rest = iter(long)
    return all(x in rest for x in short)


def test_between_the_bounds_of_brute_force(spark):
    rows, _ = corpus()
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, rows[5][1]), (104, ("a b\n" * 4000)), (105, rows[4][1] + "\nand more of it here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) AS n_chars", "1 AS digest", "2 AS first", "3 AS n", "4 AS place", "5 AS hits").repartition(4)
    out = line_chunks.without_repeats(docs)
    assert out.columns == [*docs.columns, "n_removed_lines"]
    got = out.collect()
    most, least = brute(rows)
    for r in got:
        lines = lines_of(r.text)
        assert within(most[r.doc_id], lines_of(dict(rows)[r.doc_id])) and within(lines, lines_of(dict(rows)[r.doc_id]))
        assert len(most[r.doc_id]) <= len(lines) <= len(least[r.doc_id]) or r.doc_id in (104,)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert sum(r.n_removed_lines > 0 for r in got) > 10
    same = {r.doc_id: r.text for r in got if r.n_removed_lines == 0}
    assert all(dict(rows)[k] == t for k, t in same.items())
    assert {r.doc_id: r.text for r in got}[103] == ""


def test_planted_passages_of_five_short_lines_go_whole(spark):
    """Forty passages of five short lines, ten copies each at random places among unique lines: none of 1,800 repeated lines stays."""
    r = random.Random(8)
    fresh = lambda: " ".join(f"u{r.randrange(10**9)}" for _ in range(r.randint(2, 9)))
    passages = [[" ".join(f"p{k}x{r.randrange(10**6)}" for _ in range(r.randint(2, 9))) for _ in range(5)] for k in range(40)]
    rows = []
    for i in range(400):
        lines = [fresh() for _ in range(r.randint(4, 12))]
        at = r.randint(0, len(lines))
        lines[at:at] = passages[i % 40]
        rows.append((i, "\n".join(lines)))
    got = cleaned(spark, rows)
    stay = sum(line.startswith("p") for i in range(40, 400) for line in got[i].text.split("\n"))
    assert stay == 0
    assert all(got[i].text == rows[i][1] for i in range(40))
    for i in range(40, 400):
        assert [x for x in got[i].text.split("\n") if x] == [x for x in rows[i][1].split("\n") if x.startswith("u")]
        assert got[i].n_removed_lines == 5


def test_passages_of_over_fifty_words_go_whole(spark):
    r = random.Random(11)
    fresh = lambda: " ".join(f"u{r.randrange(10**9)}" for _ in range(r.randint(1, 12)))
    passages = []
    for k in range(30):
        lines = []
        while sum(len(x.split()) for x in lines) <= 50 or len(lines) < 1 + k % 4:
            lines += [" ".join(f"p{k}x{r.randrange(10**6)}" for _ in range(r.choice([3, 9, 20, 44, 70])))] + [""] * (r.random() < 0.2)
        passages.append("\n".join(lines).strip())
    rows = [(0, "\n".join(passages))]
    for i in range(1, 120):
        parts = [fresh() for _ in range(r.randint(2, 8))]
        parts.insert(r.randint(0, len(parts)), passages[i % 30])
        rows.append((i, "\n".join(parts)))
    got = cleaned(spark, rows)
    assert got[0].text == rows[0][1] and got[0].n_removed_lines == 0
    for i in range(1, 120):
        assert not any(word.startswith("p") for word in got[i].text.split()), got[i].text
        assert sum(w.startswith("u") for w in got[i].text.split()) == sum(w.startswith("u") for w in rows[i][1].split())
        assert got[i].n_removed_lines == len(passages[i % 30].split("\n"))


def test_sentences_within_differing_lines_go(spark):
    r = random.Random(2)
    sentence = lambda tag: " ".join(f"{tag}{r.randrange(10**6)}" for _ in range(14)) + "."
    shared = " ".join(sentence("p") for _ in range(6))
    rows = [(i, f"{sentence('u')} {shared} {sentence('u')} {sentence('u')}") for i in range(5)]
    got = cleaned(spark, rows)
    assert got[0].text == rows[0][1]
    assert all(sum(w[0] == "u" for w in got[i].text.split()) == 42 and "p" not in got[i].text for i in range(1, 5))


def test_boundaries_withstand_shifts():
    lines = [f"line {i * 7919 % 1000}" for i in range(300)]

    def chunks(texts):
        h = line_chunks.line_hashes("\n".join(texts))
        return {tuple(h[i : i + 2].tolist()) for i in range(len(h) - 1) if line_chunks.boundaries(h)[i]}

    a, b = chunks(lines), chunks(["new first line", *lines[:150], "inserted", *lines[150:]])
    assert 150 < len(a) < 260 and len(a & b) >= len(a) - 4


def test_wrapping_is_a_cut_of_the_line():
    r = random.Random(1)
    for _ in range(200):
        line = " ".join(r.choice(["a", "b.", "", "c?", "d"]) for _ in range(r.randint(0, 90)))
        assert " ".join(line_chunks.wrapped(line)) == line
        assert [x for x in line_chunks.wrapped(line) if x.strip()] == lines_of(line)
        raw = (line + "\n\né " + line + " \n x").encode()
        assert [raw[a:b].decode() for a, b in line_chunks.spans(raw)] == lines_of(raw.decode())
    assert line_chunks.spans(b"") == [] == line_chunks.spans(b"\n \n\t\n")


def test_single_short_lines_stay(spark):
    rows = [(i, f"{'unique words here ' * 20}{i}\nshared footer") for i in range(9)]
    rows = [(i, " ".join(f"v{i}w{k}" for k in range(30)) + "\nshared footer") for i, _ in rows]
    assert all(r.text == t for r, (_, t) in zip(sorted(cleaned(spark, rows).values()), rows, strict=True))


def test_repeated_rows_null_ids_and_no_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long), (2, long), (None, long), (None, "other\nlines\nhere"), (None, "other\nlines\nhere too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in line_chunks.without_repeats(docs).collect())
    assert got[:3] == [("1", long), ("1", long), ("2", "")] and ("None", "") in got
    assert line_chunks.without_repeats(docs.limit(0)).count() == 0


def test_runs_of_one_line_keep_their_first_chunk(spark):
    rows = [(1, "x y\nx y\nx y\nx y\nend one"), (2, "start\nx y\nx y\nend two")]
    assert {k: r.text for k, r in cleaned(spark, rows).items()} == {1: "x y\nx y\nend one", 2: "start\nend two"}


def test_lines_under_one_hash_are_left_alone(spark, monkeypatch):
    real = line_chunks.xxhash.xxh64_intdigest
    monkeypatch.setattr(line_chunks.xxhash, "xxh64_intdigest", lambda x: real(b"clash" if x.startswith(b"clash") else x))
    rows = [(1, "clash a\nb c\nd e"), (2, "clash b\nb c\nd e")]
    assert line_chunks.line_hashes("clash a").tolist() == line_chunks.line_hashes("clash b").tolist()
    lines = [line_chunks.line_hashes(t).tolist() for _, t in rows]
    assert lines[0] == lines[1] and pytest  # the workers' own hashes differ; the comparison is what the job adds
    found = next(line_chunks._told(iter([line_chunks.batch(text=[t for _, t in rows], told=[[0], [0]])])))
    assert len(set(found.column("hash").to_pylist())) == 1 and found.num_rows == 2
