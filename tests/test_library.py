import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from segtally.functions import expr as E
from segtally.operators import depth, ranking, reads, rollup
from segtally.plans import file_queries as plans
from segtally.sources import files

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, DIR, plans.QUERIES[name], plans.SQL.get(name)).startswith(("equal", "rows only"))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def one(spark, *cs):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cs))).first())


def test_expressions(spark):
    s = F.lit
    assert one(spark, E.segment_of_contig(s("A_HA_H5")), E.segment_of_contig(s("A_PB2_X")), E.segment_of_contig(s("B_PA"))) == ("HA", "PB2", None)
    assert one(spark, E.length_status(s(1909), s(1600), s(1800)), E.coverage_status(s(100.0), s(1200 / 1350), 50, 0.95)) == ("WARNING", "FAIL")
    assert one(spark, E.valid_iso_date(s("2026-02-30")), E.valid_iso_date(s("")), E.valid_coordinate(s("45d"), -90, 90), E.valid_coordinate(s(None), -90, 90)) == (False, True, False, True)
    assert one(spark, E.extract_subtype(s("A_NA_N12"), "N"), E.normalize_screen(s("FAIL")), E.normalize_unknown(s("no_hit"))) == ("N12", "INDETERMINATE", "Unknown")
    assert one(spark, E.hit_status(s(99.883), E.query_coverage(s(1704), s(1909)), 90.0, 90.0), E.header_value(s("@r key=abc x"), "key")) == ("LOW_CONFIDENCE", "abc")
    assert one(spark, E.review_flags(s(8), s("DETECTED"), s(0), s(8), s(0)), E.review_flags(s(8), s("NOT_DETECTED"), s(0), s(8), s(0))) == ("h5n1_screen_detected", "NONE")


def test_segment_qc_golden(spark):
    grid = spark.createDataFrame([("s", x) for x in E.SEGMENTS], "sample string, segment string")
    seqs = spark.createDataFrame([("s", "HA", "A" * 1909, None), ("s", "NA", "A" * 1350, None), ("s", "PA", None, "two records")], "sample string, segment string, sequence string, error string")
    stats = spark.createDataFrame([("s", "HA", 1909, 100.0, 1.0), ("s", "NA", 1350, 100.0, 1200 / 1350)], "sample string, segment string, positions long, median_depth double, breadth_covered double")
    bounds = spark.createDataFrame([(x, 1000, 1800) for x in E.SEGMENTS], "segment string, lo int, hi int")
    out = {r.segment: (r.status, r.length_status) for r in depth.segment_qc(grid, seqs, stats, bounds, ["sample", "segment"], 50, 0.95, 0.02).collect()}
    assert len(out) == 8
    assert out["HA"] == ("PASS", "WARNING") and out["NA"] == ("FAIL", "PASS") and out["PA"][0] == "ERROR" and out["MP"][0] == "MISSING"


def test_candidates_and_stage(spark):
    c = spark.createDataFrame([("A_HA_H5_LOW", 25.0), ("A_HA_H5_HIGH", 100.0)], "contig string, median double").withColumn("segment", E.segment_of_contig(F.col("contig")))
    r = ranking.select_candidate(c, ["segment"], [F.desc("median"), F.asc("contig")]).first()
    assert (r.contig, r.selection_status) == ("A_HA_H5_HIGH", "MULTIPLE_CANDIDATES")
    s = spark.createDataFrame([("FAIL", "SUCCESS", True), ("PASS", "FAILED", True), ("PASS", "SUCCESS", False), ("PASS", "?", True)], "f string, i string, ok boolean")
    assert [r.reason for r in s.select(*rollup.stage_status(F.col("f"), F.col("i"), F.col("ok"))).collect()] == ["segment_qc_failed", "medaka_inference_failed", "medaka_consensus_failed", "invalid_inference_state"]


def test_files(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n")
    assert sorted((r.read_no, r.header, r.sequence, r.quality) for r in files.read_fastq(spark, str(tmp_path / "a.fastq")).collect()) == [(1, "@r1 x", "ACGT", "IIII"), (2, "@r2", "AC", "II")]
    (tmp_path / "x.fasta").write_text(">c1 d\nac\ngt\n>c2\nNN\n")
    assert [(r.id, r.sequence) for r in files.read_fasta(spark, str(tmp_path / "x.fasta")).collect()] == [("c1", "ACGT"), ("c2", "NN")]
    (tmp_path / "m.tsv").write_text("sample_id\thost \n s1 \tNA\n\t\n")
    assert [tuple(r) for r in files.read_table(spark, str(tmp_path / "m.tsv")).collect()] == [("s1", "NA")]
    assert [r["sample"] for r in files.discover_samples(spark, str(tmp_path), "{sample}.fastq").collect()] == ["a"]


def test_kmers_of_many_references(spark):
    text = "the license line that all of them hold"
    docs = spark.range(100_001).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    items = spark.createDataFrame([("a", text), ("a", text), ("b", "x" * 990 + text), ("c", "y" * 50)], "item_id string, text string")
    out = reads.kmer_candidates(items, docs, "item_id", "doc_id", "text", 24, 5, 2).orderBy("item_id", "doc_id").collect()
    n = len(text) - 23
    assert [(r.item_id, r.doc_id, r.shared) for r in out] == [("a", 0, n), ("a", 1, n), ("b", 0, n), ("b", 1, n)]
    assert out[0].containment == 1.0 and out[2].containment < 1.0
