"""The stages of the corpus pipeline. Each takes documents and returns documents, the last sequences.

All of them: columns beyond doc_id, text, lang and n_chars come through unread, whatever their
names (they have others meanwhile); an empty table gives an empty one; null texts have no words; texts are read whole; rows that
share a doc_id but differ in text are documents of their own (but for line dedup, which takes them
for parts of one), and rows alike in all are treated alike until near copies go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, leaks, line_chunks, near_join, packing
from .shared import landed, set_aside, table
from .tokens import vocabulary

#: What stages read of documents; all other columns are set aside.
OWN = ["doc_id", "text", "lang", "n_chars"]

#: A prediction below this says that the text is none of the known languages, or no language.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with text in one of the learned languages; the model learns from ``docs`` itself."""
    docs, back = set_aside(docs, OWN)
    judged = language.predict(docs, language.fit(docs.where(~language.held_out())))
    return back(judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated chunks out of the texts; a document all of which stands elsewhere goes."""
    docs, back = set_aside(docs, OWN)
    cleaned = line_chunks.without_repeats(docs)
    emptied = (F.col("n_removed_lines") > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    return back(cleaned.where(~F.coalesce(emptied, F.lit(False))))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near copies: that with the least doc_id, null last, and the least hash of its text."""
    docs, back = set_aside(docs, OWN)
    classes = landed(near_join.classes(docs), "classes")
    # Rows are known by doc_id and a hash of the text; those alike in both are one row of their class.
    best = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class", F.col("doc_id").alias("_kept")).agg(F.min("tie").alias("_tie"))
    best = landed(best.select("_kept", "_tie"), "kept")
    named = docs.withColumn("_own", F.xxhash64("text"))
    once = named.join(best, (F.col("_own") == F.col("_tie")) & F.col("doc_id").eqNullSafe(F.col("_kept"))).drop("_kept", "_tie")
    again = classes.groupBy("doc_id", "tie").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():  # rows of the table repeat
        once = once.dropDuplicates(["doc_id", "_own"])
    return back(once)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, edits allowed."""
    docs, back = set_aside(docs, OWN)
    return back(leaks.with_matches(docs, table(spark, sf_dir, "benchmark")).where(F.size("matches") == 0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.packed_documents(docs, vocabulary("word_bpe_49k.json"))
