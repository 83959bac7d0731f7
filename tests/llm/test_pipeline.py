import os
import re

import pytest

from ledgerloom import session
from ledgerloom.llm import language, leaks, line_chunks, near_join, packing, shared
from ledgerloom.llm.shared import landed

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
#: Names that some operator or stage gives to a column of its own, as its source has them between quotes.
_SOURCES = [open(m.__file__, encoding="utf-8").read() for m in (corpus_pipeline.pipeline_stages, language, leaks, line_chunks, near_join, packing, shared)]
_NAMES = {x for s in _SOURCES for x in re.findall(r'"(_?[a-z][a-z0-9_]*)"', s)} - {"doc_id", "text", "lang", "n_chars", "source"}
CLASHING = sorted(_NAMES | {"score", "matches", "lang_pred", "n_removed_lines", "further_column_5", "_own", "_kept", "_tie"})

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "s", None), (9002, "12 34", "en", "s", 5), (None, "A text without an id, in plain words.", "en", "s", 9)], docs.schema)
    docs = docs.union(extra).union(docs.where("doc_id = 3"))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = landed(stage(spark, before, SMALL), "test")
        assert docs.columns == before.columns, name
        assert 0 < docs.count() <= before.count(), name
        rows = {r.doc_id: r.text for r in docs.collect()}
        if name == "language ID":
            assert 9001 not in rows and 9002 not in rows and docs.count() >= before.count() - 4
        if name == "line dedup":
            removed = {r.doc_id for r in line_chunks.without_repeats(before).where("n_removed_lines > 0").collect()}
            assert {k for k, v in rows.items() if {r.doc_id: r.text for r in before.collect()}[k] != v} <= removed
        if name == "n-gram Jaccard join":
            classes = {r.doc_id: r.class_id for r in near_join.near_duplicates(before).collect()}
            assert {k for k in rows if k is not None} == {k for k, c in classes.items() if k is not None and k == c}
            assert docs.where("doc_id = 3").count() == 1
        if name == "benchmark decontamination":
            items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
            texts = [leaks.normal(i.text) for i in items if i.text]
            assert not any(t in leaks.normal(x or "") for x in rows.values() for t in texts)
            assert before.count() > docs.count()
        before = docs
    last = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert last.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_run_and_registry(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"pipeline"} | {f"op{n}_" for n in range(1, 11)} <= {x if x == "pipeline" else x.split("_")[0] + "_" for x in names}
    since = session.landed_so_far(spark)
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert session.landed_so_far(spark) - since <= 3  # the last stage's documents and pieces
    session.remove_landed(spark, since)
    assert session.landed_so_far(spark) == since


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_each_stage_on_hard_tables(spark, at):
    """Empty tables, extra columns with the operators' own names, null ids and texts, and rows that share a doc_id."""
    name, stage = corpus_pipeline.STAGES[at]
    words = " ".join(f"the house of {i} and that water" for i in range(40))
    rows = [(1, words, "en"), (1, words.replace("house", "garden"), "en"), (1, words, "en"), (2, words + " more", "en"), (None, words, "en"), (None, None, None), (3, "", "en"), (4, "der und das haus mit wasser " * 9, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("doc_id", "text", "lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars", *(f"{k} AS {x}" for k, x in enumerate(CLASHING)))
    last = at == len(corpus_pipeline.STAGES) - 1
    got = stage(spark, docs, SMALL)
    kept = got.collect()
    assert kept and (last or got.columns == docs.columns)
    assert stage(spark, docs.limit(0), SMALL).count() == 0
    if name == "n-gram Jaccard join":
        assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", words), ("1", words.replace("house", "garden")), ("None", None), ("3", ""), ("4", rows[-1][1])])
    if last:
        assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in kept}) == len(kept) == len(rows)
    else:  # the caller's columns stay the caller's
        assert all(r[x] == k for r in kept for k, x in enumerate(CLASHING))


def test_line_dedup_leaves_columns_of_any_name(spark):
    line = "these are the words of one line which comes again and again until it goes"
    docs = spark.createDataFrame([(i, f"own {i}\n{line}\nand {line} more") for i in range(4)], "doc_id long, text string")
    given = docs.selectExpr("*", *(f"{k} AS {x}" for k, x in enumerate(CLASHING) if x != "n_removed_lines"))
    got = line_chunks.without_repeats(given)
    assert got.columns == [*given.columns, "n_removed_lines"]
    assert all(r[x] == k for r in got.collect() for k, x in enumerate(CLASHING) if x != "n_removed_lines")
