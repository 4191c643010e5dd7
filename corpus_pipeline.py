"""Training-corpus pipeline: five operators over documents, each stage stored before the next reads it.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps;
the last returns the mix, in which a document stands as often as it is taken.

Defined cases: null, empty and repeated texts, null ids and other columns, whatever
their names, fare as the operator of each stage says; an empty table goes through as
an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from segtally.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality
from segtally.llm.base import exists, remove, shared_folder, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [("quality", good), ("exact_dedup", exact), ("jaccard_join", near), ("decontaminate", clean), ("mixing", mixed)]
#: The classifier and the similarity join cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The rows of the last stage. Stages are stored below folder, and one that is there already is not run again, so that
    a lost driver can go on; without folder they go below the shared folder, each until the next one is stored."""
    root = folder or f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        if not exists(spark, f"{path}/_SUCCESS"):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before and not folder:
            remove(spark, before)
        before = path
    return docs
