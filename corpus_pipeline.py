"""The corpus pipeline: language ID, line dedup, near copies, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import session
from ledgerloom.llm import pipeline_stages
from ledgerloom.llm.shared import table

#: (name, function of (spark, docs, sf_dir)); each stage reads what the one before has written.
STAGES = [
    ("language ID", pipeline_stages.known_language),
    ("line dedup", pipeline_stages.without_repeated_lines),
    ("n-gram Jaccard join", pipeline_stages.one_of_each),
    ("benchmark decontamination", pipeline_stages.without_leaks),
    ("best-fit packing", pipeline_stages.packed),
]

#: Trained models, connected components and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``.

    What a stage has landed on its way goes once the stage's documents are written.
    """
    docs = table(spark, sf_dir, "documents")
    since = session.landed_so_far(spark)
    for _, stage in STAGES[:-1]:
        rows = stage(spark, docs, sf_dir)
        path = session.shared_path(spark, "stage")
        rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        session.remove_landed(spark, since, (path,))
    return STAGES[-1][1](spark, docs, sf_dir)
