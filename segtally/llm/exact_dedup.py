"""Exact dedup: group by a 128-bit content hash and the bytes, keep the smallest id.

Rows are pre-aggregated before the shuffle, so a group that holds a third of all
rows leaves each task as one row. The grouping key holds the hash and the text
itself: Spark compares the bytes inside a hash group, and texts that only share
the hash stay apart. Each row then finds its group by hash and SHA-256, a narrow
join that adaptive execution splits where one group is large.

Defined cases: null counts as ""; null ids sort last, so an id stays before none;
a doc_id on several rows with equal text keeps one of those rows; an empty table
gives an empty table; a text of any length is hashed as a whole; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import WS, free_name


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WS}]+", " ")


def exact_groups(docs: DataFrame, content_hash=lambda c: F.unhex(F.md5(c))) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs."""
    text = normalised(F.col("text"))
    rows = docs.select("doc_id", text.alias("t")).withColumn("h", content_hash(F.col("t").cast("binary")))
    groups = (
        rows.groupBy("h", "t").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", F.sha2("t", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    found = rows.select("doc_id", "h", F.sha2("t", 256).alias("text_sha256")).join(groups, ["h", "text_sha256"])
    one = Window.partitionBy("doc_id", "text_sha256").orderBy("keep_id")
    return (
        found.repartition("doc_id", "text_sha256")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.row_number().over(one) == 1))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; different texts under one id all stay."""
    free = free_name("_sha", docs.columns)
    kept = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias(free))
    rows = docs.withColumn(free, F.sha2(normalised(F.col("text")), 256))
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows[free] == kept[free])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", free]).drop(free)


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""
