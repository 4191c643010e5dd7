"""Tables of many files: headers, quotes over lines, numbers of records, running values."""

import csv
import gzip
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from segtally.operators import samples, scans
from segtally.sources import files, tables
from tests_common import put, rows

KEY = {"sample": r"in/([^/]+)/"}


def test_running_values(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), k, r.choice([None, 1, 2, 3])) for k in r.sample(range(5000), 900)]
    df = spark.createDataFrame(data, "g string, at long, v long").repartition(5)
    w = Window.partitionBy("g").orderBy("at")
    v = F.col("v")
    want = df.select("g", "at", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    for stretch in (1, 7, 1000, 10**6):
        got = scans.running(df, ["g"], "at", {"s": v}, {"l": v}, {"e": v}, stretch).select("g", "at", "s", "l", "e")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    n = scans.ordinals(df, ["g"], "at", "n", 50).where("g = 'a'").orderBy("at").collect()
    assert [x.n for x in n] == list(range(1, len(n) + 1))
    assert scans.running(df.limit(0), ["g"], "at", {"s": v}).count() == 0


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "s1/t.tsv", "segment\tcoverage_flag\nHA\tPASS\n")
    put(root / "s2/t.tsv", "﻿coverage_flag\tsegment\tmore\nFAIL\tNA\tx\n\n\t\t\nPASS\tMP\n")
    put(root / "s3/t.tsv", " segment \tsegment\nfirst\tsecond\textra\n")
    put(root / "s4/t.tsv", "segment\tcoverage_flag\n")
    p = f"{root}/*/t.tsv"
    t = tables.read_table(spark, p, keys=KEY)
    assert t.columns == ["sample", "segment", "coverage_flag", "more"]
    want = [("s1", "HA", "PASS", None), ("s2", "MP", "PASS", ""), ("s2", "NA", "FAIL", "x"), ("s3", "second", None, None)]
    assert rows(t) == want
    one = []
    for s in ("s1", "s2", "s3"):
        x = tables.read_table(spark, f"{root}/{s}/t.tsv", keys=KEY)
        one += [tuple(r[c] if c in x.columns else None for c in t.columns) for r in x.collect()]
    assert sorted(one) == want
    assert rows(tables.read_table(spark, p, keys=KEY, columns=["more", "absent"], line="n"))[:3] == [("s1", 2, None, None), ("s2", 2, "x", None), ("s2", 3, "", None)]
    assert rows(tables.read_table(spark, p, keys=KEY, empty="raise")) == want
    put(root / "s5/t.tsv", "")
    assert rows(tables.read_table(spark, p, keys=KEY)) == want
    with pytest.raises(Exception, match="empty table"):
        tables.read_table(spark, p, keys=KEY, columns=["segment"], empty="raise").select("sample").collect()


def test_summaries_take_their_sample_from_the_path(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "s1/x.tsv", "sample\ta\nown\t1\n")
    put(root / "s2/x.tsv", "b\ta\n2\t3\n")
    put(root / "s3/x.tsv", "sample_id\tsample\ta\nid\tother\t4\n")
    assert rows(tables.read_summaries(spark, f"{root}/*/x.tsv", KEY["sample"])) == sorted([("own", "1", None), ("s2", "3", "2"), ("id", "4", None)])


@pytest.mark.parametrize("sep", ["\t", ","])
def test_records_are_those_of_a_csv_reader(spark, sep):
    r = random.Random(4)
    pieces = ["a", '"', '""', sep, "\n", " ", "b c", '"x"', "é"]
    good = []
    while len(good) < 150:
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 25)))
        if not text.strip("\n") or "\r" in text:
            continue
        out0, out1, state = *tables._patterns(sep)[:2], 0
        parsed = list(csv.reader(io.StringIO(text, newline=""), delimiter=sep))
        # a reader takes a quote that is never closed to the end of the file; here that raises
        probe = list(csv.reader(io.StringIO(text + "\n\x01", newline=""), delimiter=sep))
        if probe[-1:] == [["\x01"]]:
            good.append((text, [[x.strip() for x in p] for p in parsed if any(x.strip() for x in p)]))
    lines = [(f"f{k}", i, x) for k, (text, _) in enumerate(good) for i, x in enumerate(text.split("\n"))]
    df = spark.createDataFrame(lines, "path string, line_no long, line string").repartition(4)
    for stretch in (2, scans.STRETCH):
        recs = tables.records(df, sep, stretch).select("path", "line_no", tables.fields(F.col("text"), sep).alias("f")).collect()
        for k, (text, want) in enumerate(good):
            got = [x.f for x in sorted((x for x in recs if x.path == f"f{k}"), key=lambda x: x.line_no)]
            assert [g for g in got if any(g)] == want, repr(text)


def test_quotes_of_a_large_file_in_many_tasks(spark, tmp_path):
    n = 4000
    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter="\t", lineterminator="\n")
    w.writerow(["id", "note"])
    for k in range(n):
        w.writerow([k, f'say "{k}"\nagain\t{k}' if k % 3 else "plain"])
    put(tmp_path / "t.tsv", out.getvalue())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        t = tables.read_table(spark, f"{tmp_path}/t.tsv", columns=["id", "note"], line="line")
        got = t.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((int(x.id), x.line, x.note) for x in got) == [(k, k + 2, f'say "{k}"\nagain\t{k}' if k % 3 else "plain") for k in range(n)]
    put(tmp_path / "bad.tsv", 'a\tb\n1\t"open\n2\t3\n')
    with pytest.raises(Exception, match="not closed, line 2"):
        tables.read_table(spark, f"{tmp_path}/bad.tsv", columns=["a"]).collect()


def test_depth_column_of_each_file(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "s1/c.txt", "Position\tCoverage Depth\n1\t5\n2\tNA\n3\t\n")
    put(root / "s2/c.txt", "ReadDepth\tPosition\n7.5\t1\n")
    put(root / "s3/c.txt", "x\ty\n1\t2\n")
    put(root / "s4/c.txt", "depth\tcoverage-depth\n1\t2\n")
    assert rows(tables.read_coverage_report(spark, f"{root}/*/c.txt", KEY)) == [("s1", 5.0), ("s2", 7.5), ("s4", 2.0)]


def test_fasta_of_any_size(spark, tmp_path):
    r = random.Random(9)
    want, text = [], []
    for k in range(300):
        lines = ["".join(r.choice("acgtN ") for _ in range(r.randint(1, 40))) for _ in range(r.choice([0, 1, 3, 40]))]
        want.append((f"r{k}", "".join("".join(lines).split()).upper()))
        text += [f">r{k} note > {k}", *lines, ""]
    put(tmp_path / "x.fasta", "\n".join(text))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = tables.file_lines(spark, f"{tmp_path}/x.fasta")
        assert spark.read.text(f"{tmp_path}/x.fasta").rdd.getNumPartitions() > 10
        for stretch in (5, scans.STRETCH):
            assert sorted((x.id, x.sequence) for x in files.fasta_records(lines, stretch).collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_strict_fasta_has_a_row_for_whatever_is_there(spark, tmp_path):
    root = tmp_path / "in"
    for name, text in {"good": ">a\nac\ngt\n", "two": "\n>a\nAC\n>b\n", "early": "AC\n>a\nGT\n>b\n", "bare": ">a\n  \n", "empty": "", "blank": "\n \n"}.items():
        put(root / name / "x.fa", text)
    expected = spark.createDataFrame([(x,) for x in ("good", "two", "early", "bare", "empty", "blank", "absent")], "sample string")
    got = files.read_fasta(spark, f"{root}/*/x.fa", KEY, strict=True, expected=expected)
    assert rows(got, "sample", "sequence", "error") == sorted([
        ("good", "ACGT", None), ("two", None, "several records, second header at line 4"), ("early", None, "sequence before the header, line 1"), ("bare", None, "empty sequence"),
        ("empty", None, "missing or empty"), ("blank", None, "missing or empty"), ("absent", None, "missing or empty")])
    none = files.read_fasta(spark, f"{root}/*/none.fa", KEY, strict=True, expected=expected)
    assert {r.error for r in none.collect()} == {"missing or empty"} and none.count() == 7


def test_files_that_are_not_there_or_cannot_be_read(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "a/f.flag.gz", "")
    with gzip.open(root / "a/f.flag.gz", "wt") as h:
        h.write(" PASS\n")
    put(root / "b/f.flag.gz", "not compressed at all")
    put(root / "c/f.flag.gz", "")
    expected = spark.createDataFrame([(x,) for x in "abcd"], "sample string")
    assert rows(files.read_flags(spark, f"{root}/*/f.flag.gz", KEY, expected)) == [("a", "PASS"), ("b", "ERROR"), ("c", "MISSING"), ("d", "MISSING")]
    assert rows(files.read_flags(spark, f"{root}/*/f.flag.gz", KEY)) == [("a", "PASS"), ("b", "ERROR"), ("c", "MISSING")]
    assert rows(files.whole_files(spark, f"{root}/*/f.flag.gz", KEY, expected), "sample", "state") == [("a", "PRESENT"), ("b", "UNREADABLE"), ("c", "EMPTY"), ("d", "MISSING")]
    assert rows(files.read_flags(spark, f"{root}/*/none", KEY, expected)) == [(x, "MISSING") for x in "abcd"]
    put(root / "a/m.tsv", "name\tversion\nx\t1\ny\t2\n")
    put(root / "b/m.tsv", 'version\tname\textra\n2\t"z ""q"""\n')
    put(root / "c/m.tsv", "name\n")
    assert rows(files.read_manifest_record(spark, f"{root}/*/m.tsv", KEY, expected)) == [("a", "x", "1", None), ("b", 'z "q"', "2", ""), ("c", None, None, None), ("d", None, None, None)]
    put(root / "a/s.tsv", "reason\tstatus\tsource\nr\tSUCCESS\tMEDAKA\n")
    put(root / "b/s.tsv", "status\tconsensus_source\n\n FAILED \tX\n")
    put(root / "c/s.tsv", "status\n")
    assert rows(files.read_stage_status(spark, f"{root}/*/s.tsv", KEY)) == [("a", "SUCCESS", "MEDAKA", "r"), ("b", "FAILED", "X", None)]
    assert rows(files.read_stage_status(spark, f"{root}/*/s.tsv", KEY, expected)) == [("a", "SUCCESS", "MEDAKA", "r"), ("b", "FAILED", "X", None), ("c", None, None, None), ("d", None, None, None)]


def test_depth_lines(spark, tmp_path):
    put(tmp_path / "in/a/d", "c\t1\t5\textra\nc\t2\t 7\n\n")
    put(tmp_path / "in/b/d", "c\t1\t5\nc\t2\n")
    put(tmp_path / "in/c/d", "c\t1\tx\n")
    p = f"{tmp_path}/in/*/d"
    assert rows(files.read_depth(spark, f"{tmp_path}/in/a/d", KEY)) == [("a", 0, "c", 1, 5), ("a", 1, "c", 2, 7)]
    for s, what in (("b", "fewer than three"), ("c", "no whole number")):
        with pytest.raises(Exception, match=what):
            files.read_depth(spark, f"{tmp_path}/in/{s}/d", KEY).collect()
    assert rows(files.read_depth(spark, p, KEY, "row").where("error is not null"), "sample", "error") == [("b", "fewer than three fields, line 2"), ("c", "depth is no whole number, line 1")]


def test_metadata_from_a_file_with_its_lines(spark, tmp_path):
    put(tmp_path / "m.tsv", 'sample_id\tday\nb\t"2026-01-01"\n\n\t2026-02-30\nb\t"no\ndate"\nz\t\n')
    meta = tables.read_table(spark, f"{tmp_path}/m.tsv", line="line")
    expected = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    table, issues, counts = samples.validate_metadata(meta, expected, ["day"], dates=("day",), strict=True)
    assert rows(table) == [("a", None, "MISSING"), ("b", "no\ndate", "COMPLETE")]
    assert rows(issues) == [(None, "ERROR", "sample without metadata: a"), (3, "ERROR", "sample_id is empty"), (4, "ERROR", "day is no date of the form YYYY-MM-DD: no\ndate"), (4, "ERROR", "sample_id stands here again: b"), (5, "WARNING", "no sample has this sample_id: z")]
    assert dict(rows(counts)) == {"expected": 2, "rows": 4, "matched": 1, "missing": 1, "warnings": 1, "errors": 4}
    with pytest.raises(ValueError, match="line"):
        samples.validate_metadata(meta.drop("line"), expected, ["day"])


def test_one_file_is_read_by_many_tasks(spark):
    lines = spark.range(4001).select(F.lit("f").alias("path"), F.col("id").alias("line_no"), F.when(F.col("id") == 0, "key\tDepth").otherwise(F.concat_ws("\t", F.col("id").cast("string"), F.lit("7"))).alias("line"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        t = tables.table_rows(lines, ["key"], stretch=64).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum(F.col("key").cast("long")).alias("keys")).collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(r.n for r in t) == 4000 and sum(r["keys"] for r in t) == 4000 * 4001 // 2
    assert len(t) > 1 and max(r.n for r in t) < 3000
    assert tables.depth_values(lines).count() == 4000


def test_headers_sort_no_records(spark, monkeypatch):
    text = {"a": ["", " \t", "\ufeffkey\tx", "1\t2", "", "3\t4", ""], "b": ["x\tkey", "5\t6"], "c": ["", " "], "d": ["", "", "", "key"]}
    lines = spark.createDataFrame([(p, n, x) for p, some in text.items() for n, x in enumerate(some)], "path string, line_no long, line string")
    plans, old = [], tables.cut
    monkeypatch.setattr(tables, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or old(df))
    heads = tables.headers(tables.records(lines))
    assert rows(heads, "path", "head_no", "last_no") == [("a", 2, 5), ("b", 0, 1), ("d", 3, 3)]
    assert {r.path: r.names for r in heads.collect()} == {"a": ["key", "x"], "b": ["x", "key"], "d": ["key"]}
    assert rows(tables.table_rows(lines, ["key", "x"])) == [("a", 3, "1", "2"), ("a", 5, "3", "4"), ("b", 1, "6", "5")]
    assert rows(tables.headers(lines.where("path = 'c'").withColumnRenamed("line", "text"))) == []
    assert len(plans) > 2 and not any("SortAggregate" in p for p in plans)


def test_counters_read_the_table_twice(spark):
    # once for the issues, once for the names
    meta = spark.range(1, 2001).select(F.when(F.col("id") % 10 == 0, " ").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("s"), (F.col("id") % 700).cast("string"))).alias("sample_id"), F.col("id").alias("line"))
    expected = spark.createDataFrame([("s2",), ("s2",), ("s3",), (" s4",), ("",), (" ",), (None,), ("x",)], "sample_id string")
    counts = samples.validate_metadata(meta, expected, [])[2]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Range (1, 2001") == 2
    # names of the samples are taken as they are: of seven, s2 and s3 stand in the table
    got = dict(rows(counts))
    assert {k: got[k] for k in ("expected", "rows", "matched", "missing")} == {"expected": 7, "rows": 2000, "matched": 2, "missing": 5}
    none = dict(rows(samples.validate_metadata(meta.limit(0), expected.limit(0), [])[2]))
    assert none == dict.fromkeys(("expected", "rows", "matched", "missing", "warnings", "errors"), 0)
