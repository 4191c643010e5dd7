"""Read-level operators and shared-k-mer search."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fewer k-mers of queries than this are sent to every executor; more are joined by a shuffle.
BROADCAST_KMERS = 500_000


def filter_reads(reads: DataFrame, quality: Column, length: Column, least_quality: float, least_length: int) -> DataFrame:
    """reads with ``reason``: low_quality, too_short (in that order) or passed."""
    return reads.withColumn("reason", F.when(quality < least_quality, "low_quality").when(length < least_length, "too_short").otherwise("passed"))


def read_qc_summary(flagged: DataFrame, keys: list[str], length: str, quality: str | None = None) -> DataFrame:
    """Reads and bases before and after the filter with the reasons; with a Phred+33 quality text also the shares of bases of at least Q20 and Q30."""
    kept = F.col("reason") == "passed"
    bases = {"before": F.col(length), "after": F.when(kept, F.col(length))}
    rates = []
    for when, of in (("before", F.lit(True)), ("after", kept)) if quality else ():
        for name, good in (("q20", "[5-~]"), ("q30", "[?-~]")):
            rates.append(F.coalesce(F.try_divide(F.sum(F.when(of, F.regexp_count(quality, F.lit(good)))), F.sum(bases[when])), F.lit(0.0)).alias(f"{name}_rate_{when}"))
    return flagged.groupBy(*keys).agg(
        F.count("*").alias("reads_before"), F.sum(length).alias("bases_before"), F.count_if(kept).alias("reads_after"), F.coalesce(F.sum(bases["after"]), F.lit(0)).alias("bases_after"),
        F.count_if(F.col("reason") == "low_quality").alias("low_quality"), F.count_if(F.col("reason") == "too_short").alias("too_short"), *rates)


def read_set_stats(reads: DataFrame, keys: list[str], length: str, quality: str | None = None) -> DataFrame:
    """quality: column of a read's mean quality."""
    more = [F.avg(quality).alias("mean_quality"), F.median(quality).alias("median_quality")] if quality else []
    return reads.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.sum(length).alias("bases"), F.avg(length).alias("mean_length"), F.median(length).alias("median_length"),
        F.stddev(length).alias("sd_length"), F.max(length).alias("max_length"), *more)


def end_kmers(reads: DataFrame, sequence: Column, k: int, top: int) -> DataFrame:
    """The most frequent first and last k letters."""
    ends = reads.select(F.explode(F.array(F.struct(F.lit("start").alias("side"), F.substring(sequence, 1, k).alias("kmer")), F.struct(F.lit("end").alias("side"), F.substring(sequence, -k, k).alias("kmer")))).alias("_e")).select("_e.*")
    n = ends.where(F.length("kmer") == k).groupBy("side", "kmer").agg(F.count("*").alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy("side").orderBy(F.desc("n"), "kmer"))).where(F.col("_r") <= top).drop("_r")


#: So many adapters, and letters in them, are sent to every executor; a longer list is not one of adapters.
MOST_ADAPTERS, MOST_ADAPTER_LETTERS = 100_000, 10_000_000


def adapter_cuts(adapters: list[str]):
    """A function of the two ends of reads (Arrow batches of texts): how many letters of the first go, and how many of the last.

    All adapters are found in one pass over each end by an automaton, however many there are.
    """
    made = []

    def cuts(head: pd.Series, tail: pd.Series) -> pd.DataFrame:
        if not made:  # once a task
            import ahocorasick

            made.append(ahocorasick.Automaton())
            for a in adapters.value:
                made[0].add_word(a, len(a))
            if len(made[0]):
                made[0].make_automaton()
        machine = made[0]
        first = [0 if h is None or not len(machine) else max((end + 1 for end, _ in machine.iter(h)), default=0) for h in head]
        last = [0 if t is None or not len(machine) else max((len(t) - 1 - end + n for end, n in machine.iter(t)), default=0) for t in tail]
        return pd.DataFrame({"first": first, "last": last})

    return cuts


def trim_ends(reads: DataFrame, sequence: str, adapters: DataFrame, window: int) -> DataFrame:
    """reads with sequence cut behind the last adapter that lies within ``window`` letters of its start and before the first within as many of its end, and ``trimmed``.

    adapters: a closed list, one column. Where both cuts meet in a short read, the start wins
    and nothing else goes. Only the two ends of a read leave the JVM.
    """
    found = [r[0] for r in adapters.where(F.length(F.col(adapters.columns[0])) > 0).distinct().limit(MOST_ADAPTERS + 1).collect()]
    if len(found) > MOST_ADAPTERS or sum(map(len, found)) > MOST_ADAPTER_LETTERS:
        raise ValueError("the list of adapters is too long")
    sent = reads.sparkSession.sparkContext.broadcast(sorted(found))
    size, c = F.length(sequence), F.col(sequence)
    near = F.least(size, F.lit(window))
    cuts = F.pandas_udf(adapter_cuts(sent), "first int, last int")(F.substring(c, F.lit(1), near), F.substring(c, size - near + 1, near))
    t = reads.withColumn("_cuts", cuts)
    first, last = F.col("_cuts.first"), size - F.col("_cuts.last")
    last = F.when(last > first, last).when(first > 0, size).otherwise(last)
    kept = F.substring(c, first + 1, F.greatest(last - first, F.lit(0)))
    trimmed = F.coalesce((first > 0) | (last < size), F.lit(False))
    return t.withColumn("trimmed", trimmed).withColumn("_kept", kept).select(*(F.col("_kept").alias(n) if n == sequence else F.col(f"`{n}`") for n in reads.columns), "trimmed")


def kmer_candidates(q: DataFrame, r: DataFrame, q_id: str, r_id: str, text: str, k: int, least: int, top: int) -> DataFrame:
    """q_id, r_id, shared, containment: the best references of each query by distinct shared k-mers, however many references hold one.

    A window of k letters holds a whole seed, one of the pieces of (k + 1) // 2 letters
    that a reference is cut into; so only windows round seeds that some query holds are
    made and compared whole. K-mers that the same queries hold are one set: each
    reference counts its k-mers of a set, and only these counts meet the queries of
    the set. Texts are cut into chunks first, as taking a substring reads what stands before it.
    """
    seed = (k + 1) // 2
    chunk = seed * max(1, 480 // seed)

    def chunks(df: DataFrame, key: str) -> DataFrame:
        made = F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - k) / chunk).cast("int")), lambda i: F.substring(F.col(text), i * chunk + 1, F.lit(chunk + k - 1)))
        return df.where(F.length(text) >= k).select(key, F.explode(made).alias("_chunk"))

    def cut(first, last, size: int) -> Column:
        return F.transform(F.sequence(first, last), lambda i: F.substring(F.col("_chunk"), i, F.lit(size)))

    own = chunks(q, q_id)
    a = own.select(q_id, F.explode(cut(F.lit(1), F.length("_chunk") - k + 1, k)).alias("kmer")).distinct()
    n = a.groupBy(q_id).agg(F.count("*").alias("_n"))
    sets = a.groupBy("kmer").agg(F.struct(F.bit_xor(F.xxhash64(q_id)).alias("x"), F.bit_xor(F.xxhash64(q_id, F.lit(1))).alias("y")).alias("_set"))
    members = a.join(sets, "kmer").select("_set", q_id).distinct()
    small = F.broadcast if a.count() <= BROADCAST_KMERS else lambda df: df
    seeds = own.select(F.explode(cut(F.lit(1), F.length("_chunk") - seed + 1, seed)).alias("_seed")).distinct()
    numbers = F.sequence(F.lit(0), F.floor(F.length("_chunk") / seed).cast("int") - 1)
    placed = F.transform(numbers, lambda i: F.struct(i.alias("no"), F.substring(F.col("_chunk"), i * seed + 1, F.lit(seed)).alias("_seed")))
    near = chunks(r, r_id).select(r_id, "_chunk", F.explode(placed).alias("_p")).select(r_id, "_chunk", "_p.no", "_p._seed").join(small(seeds), "_seed", "left_semi")
    first = F.greatest(F.lit(1), F.col("no") * seed + 1 - (k - seed))
    last = F.least(F.col("no") * seed + 1, F.length("_chunk") - k + 1)
    b = near.where(first <= last).select(r_id, F.explode(cut(first, last, k)).alias("kmer"))
    held = b.join(small(sets), "kmer").repartition(r_id).dropDuplicates([r_id, "kmer"]).groupBy(r_id, "_set").agg(F.count("*").alias("_c"))
    m = held.join(members, "_set").groupBy(q_id, r_id).agg(F.sum("_c").alias("shared")).where(F.col("shared") >= least)
    m = m.join(n, q_id).withColumn("containment", F.col("shared") / F.col("_n")).drop("_n")
    return m.withColumn("_r", F.row_number().over(Window.partitionBy(q_id).orderBy(F.desc("shared"), r_id))).where(F.col("_r") <= top).drop("_r")
