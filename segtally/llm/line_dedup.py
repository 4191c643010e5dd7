"""Line dedup: a suffix array over sequences of line names, by distributed prefix doubling.

Every document is a sequence of line ids. Suffixes get ranks by their first 1, 2, ...,
``min_run`` lines and then by twice as many each round, until no two agree: the rank for
h + s lines is that of the pair (rank at the line, rank s lines on) among all such pairs.
Pairs are counted with partial sums, dealt by range, sorted and numbered by prefix sums that
are handed from one partition to the next, so a rank is where the class begins in the
suffix array, and a class is the interval [rank, rank + n) whose longest common prefix has at
least so many lines. A suffix that is alone in its class agrees with no other on more
lines, is in no deeper interval and leaves; places in the array behind an interval's
classes of several are those of such suffixes, in no stated order.

In each interval the first position (document, line) stays, and the others are later copies.
A suffix gives one run, that of the deepest interval in which it is a later copy and which has
``min_run`` lines or ``min_words`` words. Where a common prefix ends between two
depths, the suffixes that follow in the document reach to its end, so runs that overlap
or touch make one maximal repeated run, as long as the exact prefixes would give.

Ranks are joined back by pair, where adaptive execution splits a class that a third of all
documents share. Tables of one round go when the next one stands.

Defined cases: lines end at line feeds; blank lines are never deleted and not
counted in runs; null is ""; rows that repeat both id and text are one document
and get equal results; rows without an id come last, so lines under an id stay before
theirs; runs do not cross documents; a text of any length is one row
whose deleted lines are cut out in one pass; an empty table gives an empty table;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .base import WS, Scratch

#: A later copy of a run goes if it has so many lines, or so many words.
MIN_RUN, MIN_WORDS = 3, 50


def _place() -> Column:
    """Where a line stands; rows without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th", "seq")


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pairs with ``before``: how many suffixes of the same rank stand before in this partition, and its number."""
    part, open_rank, open_end = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        rank, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("rank", "n"))
        new = np.append(True, rank[1:] != rank[:-1])
        sums = np.cumsum(n) - n
        before = sums - sums[np.maximum.accumulate(np.where(new, np.arange(len(n)), 0))]
        if rank[0] == open_rank:
            before[rank == open_rank] += open_end
        open_rank, open_end = rank[-1], before[-1] + n[-1]
        columns = [*b.columns, pa.array(before, pa.int64()), pa.array(np.full(len(n), part, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, [*b.schema.names, "before", "part"])


def carried(ends: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(part, rank, suffixes of that rank in earlier partitions), from each partition's (part, first rank, last rank, suffixes of the last)."""
    out, open_rank, total = [], None, 0
    for part, first, last, n in sorted(ends):
        if first == open_rank:
            out.append((part, first, total))
        total = total + n if last == open_rank else n
        open_rank = last
    return out


def _ranked(scratch: Scratch, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored table of sorted pairs, and pairs (rank, next, n, first) with ``new``, the rank of each among all; the driver sees one row a partition."""
    schema = StructType([*pairs.schema.fields, StructField("before", LongType()), StructField("part", IntegerType())])
    dealt = scratch.keep(pairs.repartitionByRange("rank", "next").sortWithinPartitions("rank", "next").mapInArrow(_inside, schema))
    ends = dealt.groupBy("part").agg(F.min("rank").alias("first"), F.max(F.struct("rank", (F.col("before") + F.col("n")).alias("end"))).alias("last"))
    over = carried([(r.part, r.first, r.last["rank"], r.last["end"]) for r in ends.collect()])
    over = F.broadcast(pairs.sparkSession.createDataFrame(over, "part int, rank long, over long"))
    return dealt, dealt.join(over, ["part", "rank"], "left").select("rank", "next", "n", "first", (F.col("rank") + F.col("before") + F.coalesce("over", F.lit(0))).alias("new"))


def later_copies(docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, th (hash of the text), seq (from 0, blank lines not counted), length, source (where the first copy stands), copies (in that interval) of every run that stands earlier, too."""
    scratch = scratch or Scratch(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    whole = docs.select("doc_id", F.xxhash64(text).alias("th"), F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WS}]")).alias("lines"))
    lines = whole.select("doc_id", "th", F.posexplode("lines").alias("seq", "line"))
    lines = lines.select("doc_id", "th", "seq", F.regexp_count("line", F.lit(f"[^{WS}]+")).cast("long").alias("words"), F.unhex(F.md5("line")).alias("next"))
    no_run = F.lit(None).cast(StructType().add("length", IntegerType()).add("source", lines.select(_place().alias("p")).schema["p"].dataType).add("copies", LongType()))
    rows = scratch.keep(lines.repartition("doc_id", "th").dropDuplicates(["doc_id", "th", "seq"]).withColumns({"rank": F.lit(0).cast("long"), "run": no_run}))
    by = Window.partitionBy("doc_id", "th").orderBy("seq")
    alone = -1 - F.abs(F.xxhash64("doc_id", "th", "seq") % (1 << 40))  # no pair has it, and such rows are dealt evenly
    length, done, before = 1, [], rows
    while True:
        pairs = rows.where("next is not null" if length == 1 else "next >= 0").groupBy("rank", "next").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1")
        dealt, ranks = _ranked(scratch, pairs)
        found = rows.join(ranks, ["rank", "next"], "inner" if length == 1 else "left")
        long = F.lit(True) if length >= min_run else F.col("words") >= min_words
        copy = F.struct(F.lit(length).alias("length"), F.col("first").alias("source"), F.col("n").alias("copies"))
        found = found.withColumn("run", F.when(long & (F.col("first") != _place()), copy).otherwise(F.col("run")))
        found = scratch.keep(found.where("new is not null or run is not null").select("doc_id", "th", "seq", "words", F.col("new").alias("rank"), "run"))
        scratch.drop(dealt, *([before] if length == 1 else ()))
        done.append(found.where("rank is null").select("doc_id", "th", "seq", "run.*"))
        active = found.where("rank is not null")
        if active.isEmpty():
            return reduce(DataFrame.union, done)
        step = length if length >= min_run else min(length, min_run - length)
        ahead = by.rangeBetween(step, step)
        rows = active.withColumn("next", F.coalesce(F.first("rank").over(ahead), alone)).withColumn("words", F.col("words") + F.coalesce(F.first("words").over(ahead), F.lit(0)))
        length += step


def repeated(docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th (hash of the text), runs (maximal, each from seq to before ``end``, ascending) for every document with deleted lines."""
    scratch = Scratch(docs.sparkSession)
    runs = later_copies(docs, min_run, min_words, scratch).select("doc_id", "th", "seq", (F.col("seq") + F.col("length")).alias("end"))
    by = Window.partitionBy("doc_id", "th").orderBy("seq")
    new = F.coalesce(F.col("seq") > F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = runs.withColumn("k", F.sum(new.cast("long")).over(by)).groupBy("doc_id", "th", "k").agg(F.min("seq").alias("seq"), F.max("end").alias("end"))
    out = scratch.keep(runs.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("seq", "end"))).alias("runs")))
    scratch.drop_all_but(out)
    return out


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without the deleted lines, n_lines, n_removed, n_runs of every row of docs."""
    gone = repeated(docs, min_run, min_words)
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    gone = gone.withColumnsRenamed({"doc_id": "_id", "th": "_th"}).hint("merge")  # alike at every size; it grows with docs
    found = d.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("doc_id", "text", "runs")
    lines = F.split("text", "\n", -1)
    found = found.withColumn("lines", F.when(F.col("runs").isNotNull(), lines))
    full = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(f"[^{WS}]"), i)), lambda i: i.isNotNull())
    found = found.withColumn("full", full).withColumn("removed", F.flatten(F.transform("runs", lambda r: F.slice(F.col("full"), r["seq"] + 1, r["end"] - r["seq"]))))
    none, n = F.array(F.lit(-1)), F.size("lines")
    ends = F.concat("removed", F.array(n))  # what stands between two deleted lines is copied as a piece
    pieces = F.zip_with(F.concat(none, "removed"), ends, lambda p, q: F.slice(F.col("lines"), p + 2, q - p - 1))
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return found.select(
        "doc_id", kept.alias("text"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
    )


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
w AS (SELECT *, x || chr(10) || lead(x) OVER d AS two, x || chr(10) || lead(x) OVER d || chr(10) || lead(x, 2) OVER d AS three, words + lead(words) OVER d AS words2 FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY seq)),
f AS (SELECT *, words >= 50 AND row_number() OVER (PARTITION BY x ORDER BY doc_id, seq) > 1 AS one_, coalesce(words2 >= 50, FALSE) AND row_number() OVER (PARTITION BY two ORDER BY doc_id, seq) > 1 AS two_,
             three IS NOT NULL AND row_number() OVER (PARTITION BY three ORDER BY doc_id, seq) > 1 AS three_ FROM w),
c AS (SELECT *, greatest(one_::INT, max(two_::INT) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), max(three_::INT) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) AS gone FROM f),
r AS (SELECT *, (gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY seq), 0) = 0)::INT AS new FROM c),
a AS (SELECT l.doc_id, l.i, l.x, coalesce(r.gone, 0) AS gone, coalesce(r.new, 0) AS new FROM l LEFT JOIN r USING (doc_id, i))
SELECT doc_id, count(*) AS n_lines, sum(gone)::BIGINT AS n_removed, sum(new)::BIGINT AS n_runs,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
FROM a GROUP BY doc_id
"""
