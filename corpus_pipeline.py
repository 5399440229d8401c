"""The corpus pipeline: documents in, packed pieces out. Each stage is written as Parquet and read by the next.

All stages but the last return rows of ``documents`` unchanged, all columns included, whatever further columns there are.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, language_id, packing, toxicity
from plumbline.llm.base import stored, table, whole_rows
from plumbline.session import settings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.7 or more go."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.rate(docs.select(whole_rows(docs)), model, "_doc.text").filter("toxicity < 0.7").select("_doc.*")


def of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determinable language go: null, empty and letterless texts, and undecided ones."""
    found = language_id.identify(docs.select(whole_rows(docs)), language_id.train(docs), "_doc.text")
    return found.filter("lang_pred <> 'und' AND lang_score >= 0.5").select("_doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays: five words in a row, similarity 0.8 or more."""
    return jaccard_join.keep_one(docs, n=5, threshold=0.8)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item, or a whole shorter item, go."""
    rows = stored(docs.select(whole_rows(docs), F.monotonically_increasing_id().alias("_row")), "numbered")
    found = decontaminate.contamination(rows.select(F.col("_row").alias("doc_id"), "_doc.text"), table(spark, sf_dir, "benchmark"), width=10)
    hits = stored(found.filter("n_hit > 0").select(F.col("doc_id").alias("_row")), "contaminated")
    return rows.join(hits, "_row", "left_anti").select("_doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_of_toxicity),
    ("language", of_known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

#: The stages fit models and run iterations, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


#: Rows sent to Python at once. Stages hand on whole rows, so executors hold a batch of them several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    with settings(spark, BATCHES):
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
