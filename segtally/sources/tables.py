"""Delimited tables of many files, each read by its own header.

Lines come with the number they have in their file. A quoted value may go on over
lines: whether a line begins inside quotes depends on all lines before it, but each
line by itself only closes or opens a quote, toggles it or leaves it as it is. These are
composed over stretches of lines, so a file of any size is read by many tasks, and only
lines with a quote are looked at. The headers are a small table of one row a file, dealt
out to the stretches of its lines.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators.scans import STRETCH, cut, ordinals, running

#: A table of more columns is taken for one without a header.
MOST_COLUMNS = 20_000
# Normalised names of a depth column, the first that is there is taken.
DEPTH_NAMES = ["coverage_depth", "depth", "read_depth", "readdepth"]


def file_lines(spark: SparkSession, paths) -> DataFrame:
    """path, line_no (from 0), line: the lines of every file by number, however its blocks are read; any store and codec of Spark's readers."""
    t = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    sizes = t.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("path", "block", (before - F.col("first")).alias("shift"))
    return t.join(sizes, ["path", "block"]).select("path", (F.col("id") + F.col("shift")).alias("line_no"), "line")


def listing(spark: SparkSession, paths) -> DataFrame:
    """path and bytes of every file, empty ones too; nothing is read. Paths that match no file give no row.

    The names come from the listing that the driver makes for any read; readers leave empty files out.
    """
    try:
        names = spark.read.text(paths).inputFiles()
        some = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"), "length")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, bytes long")
    named = spark.createDataFrame([(re.sub("^file:/+", "file:/", n),) for n in names], "path string")
    return named.join(some, "path", "left").select("path", F.coalesce("length", F.lit(0).cast("long")).alias("bytes"))


def _patterns(sep: str) -> tuple[str, str, str]:
    """Of one separator: lines that end inside quotes when they begin outside, and when they begin inside; and one field behind its separator."""
    s = rf"\x{{{ord(sep):x}}}"
    inner = r'[^"]*+(?:""[^"]*+)*+'
    begun = rf'(?:(?:[^"{s}][^{s}]*+|"{inner}"[^{s}]*+|){s})*+"{inner}'
    return rf"^{begun}$", rf'^{inner}(?:$|"[^{s}]*+{s}{begun}$)', rf'{s}("{inner}"?[^{s}]*+|[^{s}]*+)'


def records(lines: DataFrame, sep: str = "\t", stretch: int = STRETCH) -> DataFrame:
    """path, line_no (of the first line) and text of every record of lines (path, line_no, line); a quote that is never closed raises.

    Which lines go on over others, a few rows, is found in a job of its own, before the rows are asked for.
    """
    opens, stays, _ = _patterns(sep)
    out0, out1 = (F.col("line").rlike(p).cast("int") for p in (opens, stays))
    quoted = lines.where(F.contains("line", F.lit('"'))).select("path", "line_no", out0.alias("out0"), out1.alias("out1")).where("not (out0 = 0 and out1 = 1)")
    quoted = quoted.select("path", "line_no", F.when(F.col("out0") == F.col("out1"), F.col("out0")).alias("fixed"))
    turns = F.col("fixed").isNull().cast("int")
    quoted = running(quoted, ["path"], "line_no", sums={"turned": turns}, stretch=stretch)
    quoted = running(quoted, ["path"], "line_no", earlier={"since": (F.col("fixed") + F.col("turned")) % 2}, stretch=stretch)
    # the state before a line: the last fixed one, turned as often as there were turns since
    quoted = quoted.withColumn("before", (F.coalesce("since", F.lit(0)) + F.col("turned") - turns) % 2)
    quoted = quoted.withColumn("after", F.coalesce("fixed", 1 - F.col("before"))).where("before != after")
    pairs = running(quoted, ["path"], "line_no", sums={"pair": F.col("after")}, stretch=stretch)
    spans = pairs.groupBy("path", "pair").agg(F.min("line_no").alias("first"), F.count("*").alias("ends"), F.max("line_no").alias("last"))
    broken = F.raise_error(F.concat(F.lit("a quote is not closed, line "), (F.col("first") + 1).cast("string"), F.lit(" of "), "path")).cast("long")
    spans = cut(spans.select("path", "first", F.when(F.col("ends") == 2, F.col("last")).otherwise(broken).alias("last")))
    members = spans.select("path", F.explode(F.sequence("first", "last")).alias("line_no"), "first")
    j = lines.join(members, ["path", "line_no"], "left")
    single = j.where("first is null").select("path", "line_no", F.col("line").alias("text"))
    several = j.where("first is not null").groupBy("path", F.col("first").alias("line_no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("line_no").alias("at"), "line"))), lambda x: x["line"]), "\n").alias("text"))
    return single.unionByName(several)


def fields(text: Column, sep: str = "\t") -> Column:
    """The values of a record, white space at their ends removed; quotes double inside quotes."""
    _, _, one = _patterns(sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), text), F.lit(one), F.lit(1))
    plain = F.split(text, re.escape(sep), -1)
    inner = r'^"([^"]*+(?:""[^"]*+)*+)"?'
    bare = lambda x: F.when(x.startswith('"'), F.concat(F.replace(F.regexp_extract(x, inner, 1), F.lit('""'), F.lit('"')), F.regexp_replace(x, inner, ""))).otherwise(x)
    return F.transform(F.when(F.contains(text, F.lit('"')), F.transform(found, bare)).otherwise(plain), E.clean)


def headers(recs: DataFrame, sep: str = "\t") -> DataFrame:
    """path, head_no and names of the first record of each file that is not blank, last_no of its last one; found in jobs of their own.

    The texts are looked up when their numbers are known: an aggregate that holds texts sorts all records of a task.
    """
    ends = cut(recs.where(E.strip(F.col("text")) != "").groupBy("path").agg(F.min("line_no").alias("head_no"), F.max("line_no").alias("last_no")))
    lowest = ends.agg(F.max("head_no")).first()[0]
    first = recs.where(F.col("line_no") <= F.lit(lowest).cast("long")).withColumnRenamed("line_no", "head_no").join(ends, ["path", "head_no"])
    return cut(first.select("path", "head_no", "last_no", fields(F.regexp_replace("text", "^﻿", ""), sep).alias("names")))


def under_heads(recs: DataFrame, heads: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """recs behind the header of their file, up to its last record that is not blank, with the columns of heads (path, head_no, last_no and more).

    Each header is handed to every stretch of its file's lines, so that one file is the work of many tasks.
    """
    at = lambda c: F.floor(F.col(c) / stretch)
    each = heads.withColumn("_at_", F.explode(F.sequence(at("head_no"), at("last_no"))))
    return recs.withColumn("_at_", at("line_no")).join(each, ["path", "_at_"]).where("line_no > head_no").drop("_at_", "last_no")


def column_names(heads: DataFrame) -> list[str]:
    """All names of the headers, in the order of the first file that has each."""
    each = heads.select("path", F.posexplode("names").alias("at", "name")).where("name != ''").groupBy("name").agg(F.min(F.struct("path", "at")).alias("place"))
    names = [r["name"] for r in each.orderBy("place").limit(MOST_COLUMNS + 1).collect()]
    if len(names) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} columns: not tables with a header")
    return names


def by_name(names: Column, values: Column, name: str) -> Column:
    """The value under a name: the last column of that name, "" where the record is shorter, null where the file has no such column."""
    at = F.size(names) + 1 - F.nullif(F.array_position(F.reverse(names), name), F.lit(0))
    return F.when(at.isNotNull(), F.coalesce(F.get(values, (at - 1).cast("int")), F.lit("")))


def table_rows(lines: DataFrame, columns: list[str] | None = None, sep: str = "\t", stretch: int = STRETCH) -> DataFrame:
    """path, line_no and the columns of every record that is not blank, by the header of its own file.

    lines: path, line_no, line. Without columns, all names of all headers are taken, in a job of its own.
    """
    recs = records(lines, sep, stretch)
    heads = headers(recs, sep)
    columns = column_names(heads) if columns is None else columns
    j = under_heads(recs, heads, stretch).withColumn("values", fields(F.col("text"), sep))
    full = F.exists(F.slice("values", F.lit(1), F.greatest(F.size("names"), F.lit(1))), lambda x: x != "")
    return j.where(full).select("path", "line_no", *(by_name(F.col("names"), F.col("values"), c).alias(c) for c in columns))


def _no_empty_files(files: DataFrame, lines: DataFrame) -> DataFrame:
    """No row; a file without any line of text raises."""
    some = lines.where(E.strip(F.col("line")) != "").groupBy("path").agg(F.lit(True).alias("some"))
    # the condition looks at the other side, so that it stays behind the join
    return files.join(some, "path", "left").where(F.when(F.col("some").isNull(), F.raise_error(F.concat(F.lit("empty table: "), "path"))).cast("boolean"))


def read_table(spark: SparkSession, paths, sep: str = "\t", keys: dict[str, str] | None = None, columns: list[str] | None = None, line: str | None = None, empty: str = "skip") -> DataFrame:
    """keys (of the path), then the columns of all files as text, each value from where its own file's header puts it.

    Values are trimmed and may be quoted, over several lines too; NA stays NA; blank records are
    dropped. A column that a file lacks is null, one that a record lacks "". line: name for the
    number of a record, as a reader of rows counts them: the header is 1, blank records do
    not count. empty: ``skip``, or ``raise`` for files without a header.
    """
    lines = file_lines(spark, paths)
    rows = table_rows(lines, columns, sep)
    names = rows.columns[2:]
    if line:
        rows = ordinals(rows, ["path"], "line_no", "_ordinal_")
    if empty == "raise":
        rows = rows.unionByName(_no_empty_files(listing(spark, paths), lines).select("path"), allowMissingColumns=True)
    number = [(F.col("_ordinal_") + 1).alias(line)] if line else []
    return rows.select(*(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {}).items()), *number, *(F.col(f"`{n}`") for n in names))


def depth_values(lines: DataFrame, sep: str = "\t", names: list[str] = DEPTH_NAMES) -> DataFrame:
    """path and depth of every record of lines (path, line_no, line) whose depth is a number; each file's own header says which column that is."""
    recs = records(lines, sep)
    heads = headers(recs, sep)
    known = F.transform("names", E.normalize_name)
    at = F.coalesce(*(F.nullif(F.array_position(known, n), F.lit(0)) for n in names))
    heads = heads.select("path", "head_no", "last_no", (at - 1).cast("int").alias("at")).where("at is not null")
    j = under_heads(recs, heads)
    value = F.get(fields(F.col("text"), sep), F.col("at")).try_cast("double")
    return j.select("path", value.alias("depth")).where("depth is not null and not isnan(depth)")


def read_coverage_report(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> DataFrame:
    """keys and depth of every position of coverage tables; a file without a depth column gives no row."""
    d = depth_values(file_lines(spark, paths))
    return d.select(*(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {"path": "(.*)"}).items()), "depth")


def read_summaries(spark: SparkSession, paths, sample: str, key: str = "sample_id", sep: str = "\t") -> DataFrame:
    """All summaries of a run as one table, whatever columns each has; key: its own value, else that of ``sample``, else the group of the pattern ``sample`` in the path. Empty and missing files raise."""
    t = read_table(spark, paths, sep, {"_of_path_": sample}, empty="raise")
    there = [F.nullif(F.col(c), F.lit("")) for c in (key, "sample") if c in t.columns]
    return t.select(F.coalesce(*there, "_of_path_").alias(key), *(F.col(f"`{c}`") for c in t.columns if c not in (key, "sample", "_of_path_")))
