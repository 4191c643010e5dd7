"""Deterministic picks: every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_with_alternates(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """The first row of each key by path, with the other paths as a list."""
    others = df.groupBy(*keys).agg(F.array_sort(F.collect_list(path)).alias("_all"))
    return first_by(df, keys, [F.asc(path)]).join(others, keys).withColumn("alternates", F.slice("_all", 2, F.size("_all"))).drop("_all")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def select_candidate(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """first_by with candidate_count and selection_status."""
    w = Window.partitionBy(*keys)
    d = df.withColumn("candidate_count", F.count("*").over(w)).withColumn("_r", F.row_number().over(w.orderBy(*order))).where("_r = 1").drop("_r")
    return d.withColumn("selection_status", F.when(F.col("candidate_count") > 1, "MULTIPLE_CANDIDATES").otherwise("UNIQUE"))


def top_hit(hits: DataFrame, keys: list[str], score: str = "bit_score", evalue: str = "evalue", identity: str = "percent_identity") -> DataFrame:
    line = F.concat_ws("\t", *(F.col(c).cast("string") for c in hits.columns))
    return first_by(hits, keys, [F.desc(score), F.asc(evalue), F.desc(identity), line])


def limit_hits(hits: DataFrame, query: list[str], subject: str, order: list[Column], per_subject: int, subjects: int) -> DataFrame:
    """At most per_subject rows of each query and subject, and the best subjects of each query; rows are dealt by the query once, which serves every window."""
    d = hits.repartition(*query).withColumn("_h", F.row_number().over(Window.partitionBy(*query, subject).orderBy(*order))).where(F.col("_h") <= per_subject)
    d = d.withColumn("_all", F.row_number().over(Window.partitionBy(*query).orderBy(*order)))
    d = d.withColumn("_best", F.min("_all").over(Window.partitionBy(*query, subject)))
    return d.withColumn("_s", F.dense_rank().over(Window.partitionBy(*query).orderBy("_best"))).where(F.col("_s") <= subjects).drop("_h", "_all", "_best", "_s")


def flag_duplicates(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """duplicate: not the first row of its key; last: the row that a normalised table keeps."""
    w = Window.partitionBy(*keys)
    return df.withColumn("duplicate", F.row_number().over(w.orderBy(*order)) > 1).withColumn("last", F.row_number().over(w.orderBy(*order)) == F.count("*").over(w))


def head_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def renumber(df: DataFrame, keys: list[str], order: list[str], name: str = "read_no", cuts: int = 64) -> DataFrame:
    """df with 1, 2, ... of each key in ascending order of its columns ``order``, nulls first.

    A key's rows are cut at quantiles of the first column, so that no key is sorted in
    one task; the cuts only deal the rows out and need not be exact.
    """
    first = order[0]
    quantile = F.percentile_approx(first, F.array(*(F.lit((i + 1) / cuts) for i in range(cuts - 1))), 1000)
    numeric = df.schema[first].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint", "float", "double")
    if not numeric:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    own = [f"_k{i}" for i in range(len(keys))]
    renamed = lambda d, *cs: d.select(*(F.col(k).alias(o) for k, o in zip(keys, own)), *cs)
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    part = F.when(F.col(first).isNull(), -1).otherwise(F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c < F.col(first))))
    rows = df.join(renamed(df.groupBy(*keys).agg(quantile.alias("_cuts")), "_cuts"), same).withColumn("_part", part).drop(*own, "_cuts")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = renamed(rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n")), F.col("_part").alias("_p"), "_n").select(*own, "_p", before.alias("_before"))
    numbered = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    return numbered.join(sums, [*same, F.col("_part") == F.col("_p")]).withColumn(name, F.col("_r") + F.col("_before")).select(*df.columns, name)


def n50(df: DataFrame, keys: list[str], length: str) -> DataFrame:
    """The length at which the running total, longest first, reaches half; equal lengths are summed before the window."""
    sums = df.groupBy(*keys, length).agg(F.sum(length).alias("_s"))
    by = Window.partitionBy(*keys)
    run = sums.withColumn("_run", F.sum("_s").over(by.orderBy(F.desc(length)))).withColumn("_all", F.sum("_s").over(by))
    return run.where(2 * F.col("_run") >= F.col("_all")).groupBy(*keys).agg(F.max(length).alias("n50"))


def first_match(df: DataFrame, keys: list[str], order: list[str], column: str) -> DataFrame:
    """The first value of column that is not null, by ``order``."""
    return df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min_by(column, F.struct(*order)).alias(column))


def order_by_count(df: DataFrame, column: str) -> DataFrame:
    """Counts of each value, the largest first, equal ones by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def single_value(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """value, records, counts by value and status of each key: exactly one distinct value, or which error. Values of a key are a closed list."""
    each = df.groupBy(*keys, column).agg(F.count("*").alias("_n"))
    there = F.col(column).isNotNull()
    by_value = F.array_sort(F.collect_list(F.when(there, F.struct(F.col(column).alias("value"), F.col("_n").alias("records")))))
    g = each.groupBy(*keys).agg(F.count_if(there).alias("distinct_values"), F.min(column).alias("value"), F.coalesce(F.sum(F.when(there, F.col("_n"))), F.lit(0)).alias("records"), by_value.alias("by_value"))
    return g.withColumn("status", F.when(F.col("distinct_values") == 1, "OK").when(F.col("distinct_values") == 0, "NONE").otherwise("SEVERAL"))
