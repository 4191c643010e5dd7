"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of the wanted words, stopped at ``cap`` times its
own words; what is cut off goes to the others by weight (a fill level over
sources). A document gets the whole copies that its source's ratio of target to
words holds; the rest of the ratio is its chance p of one more. Documents are
ranked by random odds over chance odds, u/(1-u) / (p/(1-p)), and taken in that
order until the rest of the target is filled, to the nearest document.

No source is sorted in one task: ranks fall into bins, sums per bin find the bin
that the target ends in, that bin is cut into bins again, and only the rows of
one bin in a million are ranked one by one. u comes from a hash of the id, so
reruns agree.

Defined cases: a null text has size 0 and is taken 0 words; the null source comes
last; equal ranks go by id, then size; an empty table gives an empty table;
repeated rows are separate documents; a text of any length is one row, of which only
the size goes on; other columns come through, whatever their names. The windows over
sources run in one task, over a row a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import WS, cut, free_name

BINS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WS}]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """source, source_size, target from one row per source; the level is where capped and shared words meet."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int"))
    everything = Window.partitionBy()
    return (
        sizes.withColumn("weight", w)
        .withColumn("before", F.coalesce(F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.lit(share) * F.sum("source_size").over(everything) - cap * F.col("before")) / F.col("open"))
        # the first source, in order of fill, that stays under its cap sets the level for itself and all later ones
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= cap * F.col("source_size"), F.struct("before", "level"))).over(everything)["level"])
        .select("source", "source_size", F.least(F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf"))), (cap * F.col("source_size")).cast("double")).alias("target"))
    )


def _bins(rows: DataFrame, key: str, bin_: Column, keys: list[str]) -> DataFrame:
    """rows with ``key``, their bin, and ``before``: the words of all lower bins of the same group."""
    rows = rows.withColumn(key, bin_)
    sums = rows.groupBy(*keys, key).agg(F.sum("size").alias("_s"))
    up = Window.partitionBy(*keys).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, key, F.coalesce(F.sum("_s").over(up), F.lit(0)).alias("_low"), "_s")
    same = [rows[k].eqNullSafe(sums[k]) for k in [*keys, key]]
    return rows.join(sums, same).select(rows["*"], "_low", "_s").withColumn("before", F.col("before") + F.col("_low")).withColumn("inside", F.col("_s")).drop("_low", "_s")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs."""
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), u.alias("u")))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    rows = sized.join(sources, sized.source.eqNullSafe(sources.source)).drop(sources.source)
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    p = F.col("ratio") - F.col("copies")
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    rows = (
        rows.withColumn("ratio", ratio).withColumn("copies", F.floor("ratio")).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
        .withColumn("rank", F.when(p > 0, odds))
        .withColumn("place", F.coalesce(F.col("rank") / (1 + F.col("rank")), F.lit(1.0)))
        .withColumn("before", F.lit(0).cast("long"))
    )
    scaled = F.col("place") * BINS
    rows = _bins(rows, "bin", F.least(F.floor(scaled), F.lit(BINS - 1)), ["source"])
    ends = (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("inside") >= F.col("rest")) & F.col("rank").isNotNull()
    far = rows.where(~F.coalesce(ends, F.lit(False))).withColumn("more", F.coalesce(F.col("before") + F.col("inside") < F.col("rest"), F.lit(False)) & F.col("rank").isNotNull())
    near = _bins(rows.where(ends), "fine", F.least(F.floor((scaled - F.col("bin")) * BINS), F.lit(BINS - 1)), ["source", "bin"])
    turn = Window.partitionBy("source", "bin", "fine").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("first", F.col("before") + F.coalesce(F.sum("size").over(turn), F.lit(0))).withColumn("more", 2 * F.col("first") + F.col("size") <= 2 * F.col("rest"))
    taken = (F.col("copies") * F.col("size") + F.when(F.col("more"), F.col("size")).otherwise(0)).cast("long").alias("taken")
    out = ["doc_id", "size", "source_size", "target", taken]
    return far.select(*out).unionByName(near.select(*out))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """docs with each row as many times as the mix takes it, in all their columns; rows of one doc_id and size are taken alike."""
    own, size, same, copies, number = (free_name(n, docs.columns) for n in ("_own", "_size", "_same", "_copies", "_number"))
    taken = mix(docs, **how).where("taken > 0").groupBy(F.col("doc_id").alias(own), F.col("size").alias(same)).agg((F.max("taken") / F.max("size")).cast("int").alias(copies))
    d = docs.withColumn(size, word_count(F.col("text")))
    joined = d.join(taken, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(size) == F.col(same)))
    return joined.select(*(d[f"`{c}`"] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col(copies))).alias(number)).drop(number)


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  (('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
f AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_,
             sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open_ FROM w),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - (2 * before_)::DOUBLE) / open_ AS level_ FROM f),
m AS (SELECT *, min_by(level_, before_) FILTER (level_ * weight <= 2 * source_size) OVER () AS lev FROM l),
t AS (SELECT source, source_size, least(coalesce(lev * weight, 'inf'::DOUBLE), (2 * source_size)::DOUBLE) AS target FROM m),
r AS (SELECT d.*, source_size, target, coalesce(target / nullif(source_size, 0), 0) AS ratio FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, floor(ratio) AS copies, target - floor(ratio) * source_size AS rest, ratio - floor(ratio) AS p FROM r),
o AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank_ FROM c),
q AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank_, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_ FROM o)
SELECT doc_id, size, source_size, target,
       (copies * size + CASE WHEN rank_ IS NOT NULL AND 2 * first_ + size <= 2 * rest THEN size ELSE 0 END)::BIGINT AS taken
FROM q
"""
