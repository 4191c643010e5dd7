"""Running values over groups of any length, in the order of a number.

A group is cut into stretches of its order. What each stretch sums up to, or ends
with, is a small table that hands the next one what it begins with; so one group, a
file of a billion lines say, is the work of many tasks.
"""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order that one stretch spans.
STRETCH = 1 << 16


def cut(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the folder of ``spark.checkpoint.dir``, so that plans over it stay short; a folder of this machine where that is unset and the master is local."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def running(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, earlier: dict[str, Column] | None = None, stretch: int = STRETCH) -> DataFrame:
    """df with, for each name: of sums the total of all rows of the keys up to this one, of lasts the last value up to it that is not null, of earlier the same without this row.

    order is a whole number, its values distinct within the keys; nulls in sums count as 0,
    null keys are a group of their own.
    """
    sums, lasts, earlier = sums or {}, lasts or {}, earlier or {}
    picked = {**lasts, **earlier}
    at = F.floor(F.col(order) / stretch)
    names = [*sums, *picked]
    parts = [F.sum(c).alias(f"_total_{n}") for n, c in sums.items()] + [F.max_by(c, F.when(c.isNotNull(), F.col(order))).alias(f"_total_{n}") for n, c in picked.items()]
    own = [f"_key_{i}" for i in range(len(keys))]
    totals = df.select(*(F.col(k).alias(o) for k, o in zip(keys, own)), at.alias("_stretch_"), "*").groupBy(*own, "_stretch_").agg(*parts)
    before = Window.partitionBy(*own).orderBy("_stretch_").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0)).alias(f"_carried_{n}") for n in sums] + [F.last(f"_total_{n}", ignorenulls=True).over(before).alias(f"_carried_{n}") for n in picked]
    totals = totals.select(*own, "_stretch_", *carried)
    here = df.withColumn("_at_", at)
    same = reduce(lambda a, b: a & b, (here[k].eqNullSafe(totals[o]) for k, o in zip(keys, own)), here["_at_"] == totals["_stretch_"])
    inside = Window.partitionBy(*keys, "_at_").orderBy(order)
    upto, prior = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    out = {n: F.coalesce(F.sum(c).over(upto), F.lit(0)) + F.col(f"_carried_{n}") for n, c in sums.items()}
    out |= {n: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_carried_{n}")) for some, w in ((lasts, upto), (earlier, prior)) for n, c in some.items()}
    return here.join(totals, same, "left").select(*(F.col(f"`{c}`") for c in df.columns if c not in names), *(c.alias(n) for n, c in out.items()))


def ordinals(df: DataFrame, keys: list[str], order: str, name: str, stretch: int = STRETCH) -> DataFrame:
    """df with the number of each row within its keys, from 1."""
    return running(df, keys, order, sums={name: F.lit(1).cast("long")}, stretch=stretch)
