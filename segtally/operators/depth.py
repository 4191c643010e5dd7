"""Depth statistics, segment QC and depth from alignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators.rollup import closed_list


def depth_stats(depth: DataFrame, keys: list[str], value: str, threshold: float, contig: str | None = None, order: Column | None = None) -> DataFrame:
    """positions, median, mean, min, max and breadth of each key; exact median over all references of a key.

    With ``contig`` also the names of these references, those first seen first: a
    reference stands where its least ``order`` is (without order, by name).
    """
    c = F.col(value)
    stats = depth.groupBy(*keys).agg(
        F.count(c).alias("positions"), F.median(c).alias("median_depth"), F.avg(c).alias("mean_depth"), F.min(c).alias("min_depth"),
        F.max(c).alias("max_depth"), F.avg(F.when(c >= threshold, 1.0).otherwise(0.0)).alias("breadth_covered"))
    return stats.join(contig_lists(depth, keys, contig, order), keys, "left") if contig else stats


def contig_lists(df: DataFrame, keys: list[str], contig: str, order: Column | None = None, name: str = "contigs") -> DataFrame:
    """keys and the distinct values of contig, joined by commas in the order in which they are first seen; NA without one. Only one row for each value meets the others of its keys."""
    first = df.where(F.col(contig).isNotNull()).groupBy(*keys, contig).agg((F.min(order) if order is not None else F.first(F.lit(0))).alias("_first"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_first", contig))), lambda x: x[contig])
    return first.groupBy(*keys).agg(F.array_join(listed, ",").alias(name))


def with_bounds(df: DataFrame, bounds: DataFrame, key: str, overrides: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """df with lo and hi of its key, from the closed list bounds (key, lo, hi) or from ``overrides``, whose names must stand in the list."""
    if overrides:
        unknown = set(overrides) - {r[0] for r in closed_list(bounds.select(key)).collect()}
        if unknown:
            raise ValueError(f"unknown names in the bounds: {sorted(unknown)}")
        for side, i in (("lo", 0), ("hi", 1)):
            chosen = reduce(lambda c, kv, i=i: c.when(F.col(key) == kv[0], kv[1][i]), overrides.items(), F.when(F.lit(False), 0))
            bounds = bounds.withColumn(side, F.coalesce(chosen, F.col(side)))
    return df.join(closed_list(bounds), key, "left")


def segment_qc(grid: DataFrame, sequences: DataFrame, stats: DataFrame, bounds: DataFrame, keys: list[str], depth: float, breadth: float, most_n: float, bound_key: str | None = None) -> DataFrame:
    """One row of each grid row, with measures, the four statuses and the reason.

    sequences: keys, sequence (null: not there), error (null: readable); stats: keys,
    positions, median_depth, breadth_covered and, if it has one, depth_error; bounds: lo
    and hi by ``bound_key`` (the last key).
    """
    j = grid.join(sequences, keys, "left").join(stats, keys, "left").join(closed_list(bounds), bound_key or keys[-1], "left")
    j = j.select("*", *E.seq_stats(F.coalesce("sequence", F.lit(""))))
    broken_depth = F.col("depth_error").isNotNull() if "depth_error" in stats.columns else F.lit(False)
    states = E.segment_states(
        F.col("sequence").isNotNull() | F.col("error").isNotNull(), F.col("error").isNotNull(), broken_depth, F.col("positions"),
        E.coverage_status(F.col("median_depth"), F.col("breadth_covered"), depth, breadth), E.length_status(F.col("consensus_length"), F.col("lo"), F.col("hi")), E.n_status(F.col("n_fraction"), most_n))
    return j.withColumns(states).withColumn("qc_reason", E.qc_reason(F.col("status"), depth, breadth, most_n))


def alignment_blocks(aln: DataFrame, cigar: str = "cigar", pos: str = "pos") -> DataFrame:
    """start and end (exclusive) on the reference of each M, = or X block of a CIGAR; D and N move on, others do not."""
    ops = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), 0), lambda x: F.struct(F.regexp_extract(x, r"\d+", 0).cast("int").alias("n"), F.substring(x, -1, 1).alias("op")))
    start = F.struct(F.col(pos).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(a: Column, o: Column) -> Column:
        end = a["at"] + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0)
        block = F.when(o["op"].isin("M", "=", "X"), F.array(F.struct(a["at"].alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct(end.alias("at"), F.concat(a["out"], block).alias("out"))

    return aln.withColumn("_b", F.explode(F.aggregate(ops, start, step)["out"])).select(*aln.columns, F.col("_b.start").alias("start"), F.col("_b.end").alias("end"))


def depth_runs(blocks: DataFrame, refs: DataFrame, contig: str = "contig", stretch: int = 1 << 20) -> DataFrame:
    """contig, start, end, depth of runs of equal depth, zeros included; positions are never listed one by one. refs: contig, length.

    Events are summed by position, then within stretches of ``stretch`` positions; a
    small table hands each stretch the depth it begins with and where the next one goes on.
    """
    events = blocks.select(contig, F.col("start").alias("p"), F.lit(1).alias("d")).union(blocks.select(contig, "end", F.lit(-1)))
    events = events.union(refs.select(contig, F.lit(1), F.lit(0))).union(refs.select(contig, F.col("length") + 1, F.lit(0)))
    e = events.groupBy(contig, "p").agg(F.sum("d").alias("d")).withColumn("_at", F.floor(F.col("p") / stretch))
    by = Window.partitionBy(contig).orderBy("_at")
    sums = e.groupBy(contig, "_at").agg(F.sum("d").alias("_s"), F.min("p").alias("_p"))
    sums = sums.select(contig, "_at", F.coalesce(F.sum("_s").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_p").over(by).alias("_next"))
    inside = Window.partitionBy(contig, "_at").orderBy("p")
    e = e.join(sums, [contig, "_at"]).select(contig, F.col("p").alias("start"), F.coalesce(F.lead("p").over(inside), F.col("_next")).alias("end"), (F.sum("d").over(inside) + F.col("_before")).alias("depth"))
    return e.where(F.col("end").isNotNull())


def depth_run_stats(runs: DataFrame, contig: str, threshold: float) -> DataFrame:
    n = F.col("end") - F.col("start")
    return runs.groupBy(contig).agg(
        F.sum(n).alias("positions"), F.percentile("depth", F.lit(0.5), n).alias("median_depth"),
        (F.sum(F.col("depth") * n) / F.sum(n)).alias("mean_depth"), (F.sum(F.when(F.col("depth") >= threshold, n).otherwise(0)) / F.sum(n)).alias("breadth_covered"))
