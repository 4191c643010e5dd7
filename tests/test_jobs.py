"""Sources, sinks, stages and whole jobs on small files."""

import json

import pytest
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import depth, ranking, reports, rollup, samples, stages
from segtally.plans import jobs
from segtally.sources import files
from tests_common import put, rows


KEY = {"sample": r"in/([^/]+)/"}


def test_sources(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "s1/a.fasta", ">c1 c.12A>G note\nac g\nT\n>c2\nNN\n")
    put(root / "s2/a.fasta", ">only\nacgt\n")
    put(root / "s3/a.fasta", "no header\n")
    put(root / "s4/a.fasta", ">bare\n\n")
    p = f"{root}/*/a.fasta"
    assert rows(files.read_fasta(spark, p, KEY), "sample", "id", "sequence") == [("s1", "c1", "ACGT"), ("s1", "c2", "NN"), ("s2", "only", "ACGT"), ("s4", "bare", "")]
    assert rows(files.read_fasta(spark, p, KEY, strict=True), "sample", "error") == [("s1", "several records, second header at line 4"), ("s2", None), ("s3", "sequence before the header, line 1"), ("s4", "empty sequence")]
    put(root / "s1/t.tsv", 'id\t note\n1\t"said ""hi"", left"\n\t\n2\t"two\nlines"\n3\tPASS\t\n')
    assert rows(files.read_table(spark, f"{root}/*/t.tsv", keys=KEY)) == [("s1", "1", 'said "hi", left'), ("s1", "2", "two\nlines"), ("s1", "3", "PASS")]
    put(root / "s1/d.depth", "c\t1\t5\nc\t2\t7\n")
    put(root / "s2/d.depth", "c\t1\t9\n")
    assert rows(files.read_depth(spark, f"{root}/*/d.depth", KEY), "sample", "contig", "pos", "depth") == [("s1", "c", 1, 5), ("s1", "c", 2, 7), ("s2", "c", 1, 9)]
    hit = "q\tacc\ttitle\t99.5\t100\t120\t1\t100\t1\t100\t1e-50\t200"
    put(root / "s1/h.txt", hit + "\textra\n")
    put(root / "s2/h.txt", hit.replace("99.5", "x") + "\n")
    assert rows(files.read_hits(spark, f"{root}/s1/h.txt", KEY), "sample", "percent_identity", "bit_score") == [("s1", 99.5, 200.0)]
    with pytest.raises(Exception, match="no number"):
        files.read_hits(spark, f"{root}/s2/h.txt").collect()
    put(root / "s1/x.sam", "@HD\tVN:1\n@SQ\tSN:c\tLN:50\nr\t0\tc\t3\t60\t4M\n" "r2\t4\tc\t3\t60\t4M\n")
    aln, refs = files.read_alignments(spark, f"{root}/*/x.sam", KEY)
    assert rows(aln) == [("s1", "c", 0, 3, "4M")] and rows(refs) == [("s1", "c", 50)]
    put(root / "s1/pass.list", "# c\n\nX_HA more\n")
    lines = files.read_lines(spark, f"{root}/*/pass.list", KEY)
    assert rows(files.read_annotation_lists(lines, lines.limit(0), "sample")) == [("s1", "X_HA", "PASS")]
    assert rows(files.read_alerts(lines), "sample", "seq", "fatal") == [("s1", "X_HA", False)]
    put(root / "s1/ha.flag", " PASS\n")
    put(root / "s2/ha.flag", "")
    assert rows(files.read_flags(spark, f"{root}/*/ha.flag", KEY["sample"])) == [("s1", "PASS"), ("s2", "MISSING")]
    put(root / "db/m.tsv", "name\tversion\nx\t1\n")
    assert rows(files.read_manifest_record(spark, f"{root}/*/m.tsv", {"run": KEY["sample"]})) == [("db", "x", "1")]
    with pytest.raises(ValueError, match="sample"):
        files.discover_samples(spark, str(root), "x.fastq")


def test_fastq_of_many_blocks(spark, tmp_path):
    n = 3000
    put(tmp_path / "r.fastq", "".join(f"@r{i} k=v\n{'ACGT' * (i % 9 + 1)}\n+\n{'@III' * (i % 9 + 1)}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        r = files.read_fastq(spark, f"{tmp_path}/r.fastq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((x.read_no, x.header, len(x.sequence) == len(x.quality)) for x in r) == [(i + 1, f"@r{i} k=v", True) for i in range(n)]
    put(tmp_path / "bad.fastq", "@r\nAC\n+\n")
    with pytest.raises(Exception, match="broken record"):
        files.read_fastq(spark, f"{tmp_path}/bad.fastq").collect()


def test_expressions(spark):
    one = lambda *cs: tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cs))).first())
    s = F.lit
    assert one(E.clean(s("PASS\t\r\n")), E.parse_bool(s(" yes\r")), E.parse_bool(s("t")), E.parse_bool(s("T"), True)) == ("PASS", True, False, True)
    numbers = [0.0, 1.0, 0.5, 1e-50, 1.5e-7, 0.0001234567, 123456.0, 1234567.0, -2.25, 1e300, 99.99999999]
    assert [one(E.format_general(s(x)))[0] for x in numbers] == [f"{x:.6g}" for x in numbers]
    assert one(*E.selectors(s("m1"))) == ("m1:consensus", "m1:variant")
    assert one(E.screen_reason("HA", s("PASS"), s("A_HA")), E.screen_reason("HA", s("FAIL"), s("A_HA")), E.screen_reason("HA", s("PASS"), s("NA"))) == (None, "HA QC=FAIL", "HA contig unavailable")
    assert one(*E.retention_changes(s(10), s(4), s(0.8), s(0.9), s(None).cast("int")))[:2] == (6, 0.4)
    assert one(reports.split_list(s(" a; b,,c ")))[0] == ["a", "b", "c"]


def test_segment_states(spark):
    keys = "sample string, segment string"
    grid = spark.createDataFrame([("s", x) for x in ("HA", "NA", "PA", "NP", "MP")], keys)
    seqs = spark.createDataFrame([("s", "HA", "AN" * 700, None), ("s", "PA", None, "two records"), ("s", "NP", "A" * 900, None), ("s", "MP", "A" * 1100, None)], keys + ", sequence string, error string")
    stats = spark.createDataFrame([("s", "HA", 10, 100.0, 1.0, None), ("s", "NP", None, None, None, "broken"), ("s", "MP", 0, None, None, None)], keys + ", positions long, median_depth double, breadth_covered double, depth_error string")
    bounds = spark.createDataFrame([(x, 1000, 1800) for x in E.SEGMENTS], "segment string, lo int, hi int")
    out = {r.segment: (r.status, r.coverage_status, r.length_status, r.n_content_status) for r in depth.segment_qc(grid, seqs, stats, bounds, ["sample", "segment"], 50, 0.95, 0.02).collect()}
    assert out == {
        "HA": ("FAIL", "PASS", "PASS", "FAIL"), "NA": ("MISSING",) * 4, "PA": ("ERROR", "NA", "ERROR", "ERROR"), "NP": ("ERROR", "ERROR", "FAIL", "PASS"), "MP": ("MISSING", "MISSING", "PASS", "PASS"),
    }
    assert rows(depth.with_bounds(grid, bounds, "segment", {"HA": (1, 2)}).where("segment in ('HA', 'NA')"), "segment", "lo", "hi") == [("HA", 1, 2), ("NA", 1000, 1800)]
    with pytest.raises(ValueError, match="XX"):
        depth.with_bounds(grid, bounds, "segment", {"XX": (1, 2)})


def test_stage_machines(spark):
    c = spark.createDataFrame([(None, "SUCCESS", True, True), ("", "SUCCESS", True, True), ("PASS", "SUCCESS", True, None), ("PASS", "SUCCESS", False, True), ("PASS", "FAILED", True, True), ("PASS", None, True, True), ("PASS", "SUCCESS", None, None)], "f string, i string, ok boolean, found boolean")
    got = [tuple(r) for r in c.select(*stages.consensus_status(F.col("f"), F.col("i"), F.col("ok"))).collect()]
    assert got == [("SKIPPED_QC", "NONE", "segment_qc_failed")] * 2 + [("SUCCESS", "MEDAKA", "polishing_completed")] + [("FAILED", "IRMA_FALLBACK", x) for x in ("medaka_consensus_failed", "medaka_inference_failed", "invalid_inference_state", "medaka_consensus_failed")]
    got = [r.reason for r in c.select(*stages.variant_status(F.col("f"), F.col("i"), F.col("ok"), F.col("found"))).collect()]
    assert got == ["segment_qc_failed", "segment_qc_failed", "medaka_vcf_empty_output", "medaka_vcf_failed", "medaka_inference_failed", "invalid_inference_output", "medaka_vcf_failed"]
    assert [r.status for r in c.select(*stages.inference_status(F.col("f"), F.col("ok"))).collect()] == ["SKIPPED_QC", "SKIPPED_QC", "SUCCESS", "FAILED", "SUCCESS", "SUCCESS", "FAILED"]
    with pytest.raises(Exception, match="medaka_vcf|invalid_inference"):
        c.select(*stages.variant_status(F.col("f"), F.col("i"), F.col("ok"), F.col("found"), soft=False)).collect()
    with pytest.raises(Exception, match="unexpected screen status"):
        stages.route_by_screen(spark.createDataFrame([("s", "ODD")], "sample string, screen string"))[1].collect()


def test_assembly_from_files(spark, tmp_path):
    root = tmp_path / "irma"
    for name, text in (("A_HA_H5.fasta", ">x\nACGT\n"), ("A_HA_H5.bam", "bambam"), ("sub/A_HA_H5.fa", ">y\nA\n"), ("A_HA_H1.fasta", ">z\nACGTACGT\n"), ("A_NA_N1.bam", "b"), ("A_HA_H5-coverage.txt", "Position\tCoverage Depth\n1\t10\n2\tNA\n3\t30\n"), ("notes.txt", "x"), ("B_HA.fasta", ">b\nA\n")):
        put(root / "s1" / name, text)
    a = files.list_artifacts(spark, str(root), r"irma/([^/]+)/")
    assert a.count() == 6 and {r.kind for r in a.collect()} == {"fasta", "bam", "coverage"}
    lengths = files.read_fasta(spark, f"{root}/*/*.fasta").groupBy("path").agg(F.sum(F.length("sequence")).alias("fasta_length"))
    medians = reports.coverage_median(files.read_table(spark, f"{root}/*/*-coverage.txt", keys={"path": "(.*)"}), ["path"])
    m = {r.segment: r for r in stages.normalize_assembly(a.withColumn("path", F.regexp_replace("path", "^file:/*", "/")), medians.withColumn("path", F.regexp_replace("path", "^file:/*", "/")), lengths.withColumn("path", F.regexp_replace("path", "^file:/*", "/")), spark.createDataFrame([("s1",), ("s2",)], "sample string")).where("sample = 's1'").collect()}
    assert len(m) == 8 and (m["HA"].status, m["HA"].contig, m["HA"].candidate_count, m["HA"].coverage_median, m["HA"].fasta_length) == ("READY", "A_HA_H5", 2, 20.0, 4)
    assert len(m["HA"].alternates) == 1 and m["HA"].selection_status == "MULTIPLE_CANDIDATES" and m["NA"].status == "BAM_ONLY" and m["PA"].selection_status == "MISSING"


def test_jobs_from_files(spark, tmp_path):
    root = tmp_path / "results"
    put(root / "s1/metadata.tsv", "sample\thost\treads_before\ns1\tduck\tmany\n")
    put(root / "s1/read_qc.json", json.dumps({"summary": {"before_filtering": {"total_reads": 10}, "after_filtering": {"total_reads": 8}}}))
    put(root / "s1/coverage.tsv", "segment\tcoverage_flag\tcontig\tmedian_depth\tcandidate_count\n" + "".join(f"{s}\t{'FAIL' if s == 'MP' else 'PASS'}\tA_{s}_H5\t99\t{2 if s == 'HA' else 1}\n" for s in E.SEGMENTS))
    hit = "q\tacc\t{}\t99.5\t100\t120\t1\t100\t1\t100\t1e-50\t{}"
    put(root / "s1/blast/HA.txt", hit.format("second", 100) + "\n" + hit.format("best H5", 300) + "\n")
    put(root / "s1/h5n1.flag", "PASS\n")
    put(root / "s1/GenoFLU.tsv", "sample\tstatus\ns1\tH5N1_NOT_DETECTED\n")
    put(root / "s1/consensus_all_segments.fasta", "".join(f">{s}\nACGT\n" for s in E.SEGMENTS))
    put(root / "s1/medaka/HA/consensus.status.tsv", "status\tconsensus_source\treason\nfailed\tIRMA_FALLBACK\tmedaka_consensus_failed\n")
    put(root / "s1/medaka/HA/inference.status.tsv", "status\tmodel_source\tmodel\treason\nSUCCESS\tx\ty\tz\n")
    put(root / "s1/medaka/NA/consensus.status.tsv", "status\tconsensus_source\treason\nSUCCESS\tMEDAKA\tpolishing_completed\n")
    expected = spark.createDataFrame([("s1",), ("s2",)], "sample string")
    s = jobs.sample_job(spark, str(root), expected)
    r = {x["sample"]: x for x in s.collect()}
    assert s.columns[:3] == ["sample", "host", "metadata_reads_before"] and s.columns[3:] == samples.ANALYTICAL
    one, two = r["s1"], r["s2"]
    assert (one.host, one.metadata_reads_before, one.reads_before, one.reads_after, one.q20_rate_before) == ("duck", "many", "10", "8", "NA")
    assert (one.segments_pass, one.failed_segment_names, one.pass_segment_names, one.ha_contig, one.ha_top_blast_hit, one.na_top_blast_hit) == (7, "MP", "HA,NA,PB2,PB1,PA,NP,NS", "A_HA_H5", "best H5", "NO_HIT")
    assert (one.h5n1_screen, one.genoflu_status, one.consensus_segments, one.multiple_irma_candidate_segments) == ("DETECTED", "H5N1_NOT_DETECTED", 8, "HA")
    assert one.review_flags == "fewer_than_8_pass_segments;h5n1_screen_detected;coverage_failures;multiple_irma_candidates"
    assert (two.h5n1_screen, two.segments_pass, two.genoflu_status, two.max_irma_candidate_count) == ("MISSING", 0, "MISSING", 1) and "no_consensus_segments" in two.review_flags
    run = {x.sample_id: x for x in jobs.run_job(spark, str(root), [s]).collect()}
    assert (run["s1"].ha_call, run["s1"].genome_status, run["s1"].fallback_segments, run["s1"].polished_segments, run["s2"].status_records) == ("H5", "Near-complete", 1, 1, 0)
    assert run["s1"].review_reason.endswith("Medaka: 1 failed segment(s); 1 IRMA fallback segment(s)")
    report = samples.run_report(jobs.run_job(spark, str(root), [s]))
    assert dict(rows(report["overview"], "status", "n")) == {"Complete": 0, "Near-complete": 1, "Partial": 0, "Failed": 1} and report["attention"].columns[:2] == ["Sample", "Host"]
    assert rows(report["ha_calls"]) == [("H5", 1), ("Unknown", 1)] and report["minimum_depths"].agg(F.sum("n")).first()[0] == 1 and report["review"].count() == 2
    assert rows(samples.attention(s), "sample") == [("s1",)]
    assert {x.metric: x.value for x in samples.sample_cards(s.where("sample = 's1'")).collect()}["Passing segments"] == "7/8"


def test_summaries_of_several_versions(spark, tmp_path):
    root = tmp_path / "results"
    put(root / "s1/s1.tsv", "sample\thost\tsegments_pass\th5n1_screen\ns1\tduck\t8\tPASS\n")
    put(root / "s2/s2.tsv", "segments_pass\thost\n 6\tN/A\n")
    put(root / "s3/s3.tsv", "sample_id\tsample\tsegments_pass\n \twrong\tmany\n")
    put(root / "s4/s4.tsv", "sample_id\tsegments_pass\n")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "sample_id string")
    read = lambda expected: jobs.read_summaries(spark, f"{root}/*/*.tsv", r"results/([^/]+)/", expected)
    s = read(ids("s1", "s2", "s3"))
    assert rows(s, "sample_id", "segments_pass") == [("s1", "8"), ("s2", "6"), ("s3", "many")]
    run = samples.current_columns(s)
    assert rows(run, "sample_id", "pass_segments", "coverage_segments", "h5n1_screen", "state") == [("s1", 8.0, 8.0, "DETECTED", "Unknown"), ("s2", 6.0, 6.0, "INDETERMINATE", "Unknown"), ("s3", 0.0, 0.0, "INDETERMINATE", "Unknown")]
    assert rows(run.select("multiple_irma_candidate_count", "multiple_irma_candidate_segments", "aa_changes").distinct()) == [(0.0, "NONE", None)]
    for absent in ("s4", "s5"):  # no record, no file
        with pytest.raises(Exception, match=f"no summary, or an empty one: {absent}"):
            read(ids("s1", absent)).collect()
    with pytest.raises(ValueError, match="none of"):
        samples.current_columns(ids("s1"))
    long = rollup.metadata_long(spark.createDataFrame([("s1", " wild duck", "None", 1), ("s2", "n/a", None, 2)], "sample string, host_name string, state string, reads_before int"), "sample")
    assert rows(long) == [("s1", "Host Name", "wild duck")] and rollup.metadata_long(ids("s1"), "sample_id").count() == 0


def test_files_of_a_sample_report(spark):
    keys = ["sample", "segment"]
    coverage = spark.createDataFrame([("s", x, 9, "PASS" if x != "MP" else "REVIEW") for x in ("HA", "NA", "PA", "MP", "NP", "NS")], "sample string, segment string, length int, overall_status string")
    wide = spark.createDataFrame([("s", "HA", "SUCCESS", "SUCCESS", "MEDAKA", "SUCCESS"), ("s", "NA", "FAILED", "FAILED", "NONE", "FAILED"), ("s", "PA", "SUCCESS", "SUCCESS", "IRMA_FALLBACK", "SKIPPED_QC")], "sample string, segment string, inference_status string, consensus_status string, consensus_source string, variant_status string")
    artifacts = spark.createDataFrame([("s", "HA", "consensus", "b", 1, 0), ("s", "HA", "consensus", "a", 0, 0), ("s", "HA", "vcf", "v", 1, 1), ("s", "NA", "vcf", "v", 1, 1), ("s", "NS", "vcf", "w", 1, 0)], "sample string, segment string, kind string, path string, bytes int, records int")
    f = samples.files_table(coverage, wide, artifacts, keys)
    got = {r.segment: (r.consensus, r.consensus_file, r.variants, r.variant_file) for r in f.collect()}
    none = ("NOT RECORDED", "Not available")
    assert got == {
        "HA": ("SUCCESS · MEDAKA", "b", "1 variant", "v"), "NA": ("FAILED · NONE", "Not available", "FAILED", "Not generated"), "PA": ("SUCCESS · IRMA FALLBACK", "Not available", "Skipped: segment QC", "Not generated"),
        "MP": (*none, "Skipped: segment QC", "Not generated"), "NP": (*none, "No VCF produced", "Not generated"), "NS": (*none, "0 variants", "w")}


def test_metadata_report_and_sinks(spark, tmp_path):
    meta = spark.createDataFrame([("a", "2026-02-30", "95", "barcode1", 1), ("b", "", "", "x", 2), ("b", "2026-01-01", "5", "", 3), ("z", "", "", "", 4)], "sample_id string, day string, lat string, code string, line int")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")
    how = dict(columns=["day", "extra"], dates=("day",), coordinates={"lat": (-90, 90)}, barcode="code")
    table, issues, counts = samples.validate_metadata(meta, expected, **how)
    assert rows(table) == [("a", "2026-02-30", "", "COMPLETE"), ("b", "2026-01-01", "", "COMPLETE"), ("c", None, "", "MISSING")]
    assert dict(rows(counts)) == {"expected": 3, "rows": 4, "matched": 2, "missing": 1, "warnings": 3, "errors": 3}
    assert rows(issues) == [(None, "WARNING", "sample without metadata: c"), (1, "ERROR", "day is no date of the form YYYY-MM-DD: 2026-02-30"), (1, "ERROR", "lat is no number from -90 to 90: 95"), (2, "WARNING", "code is not of the form barcode01: x"), (3, "ERROR", "sample_id stands here again: b"), (4, "WARNING", "no sample has this sample_id: z")]
    with pytest.raises(ValueError, match="errors"):
        samples.validate_metadata(meta, expected, **how, path=f"{tmp_path}/report")
    text = [r.value for r in spark.read.text(f"{tmp_path}/report").collect()]
    assert "expected\t3" in text and any(x.startswith("ERROR\tline 1: ") for x in text)
    files.write_by_sample(table.withColumnRenamed("sample_id", "sample"), f"{tmp_path}/by")
    assert (tmp_path / "by" / "sample=a").is_dir()
    files.write_table(table, f"{tmp_path}/t", ["sample_id", "extra"])
    assert files.read_table(spark, f"{tmp_path}/t").columns == ["sample_id", "extra"]
    seqs = spark.createDataFrame([("a", "x", "AC", 2), ("a", "y", "GT", 1), ("a", "z", "", 3)], "sample string, id string, sequence string, ord int")
    files.write_fasta(seqs, f"{tmp_path}/fa")
    assert [r.value for r in spark.read.text(f"{tmp_path}/fa/sample=a").collect()] == [">y", "GT", ">x", "AC"]
    doc = spark.createDataFrame([("r1", '{"b":{"c":1},"a":2}')], "run string, document string")
    files.write_provenance(doc, f"{tmp_path}/prov")
    assert rows(files.read_table(spark, f"{tmp_path}/prov/fields")) == [("r1", "a", "2"), ("r1", "b.c", "1")]


def test_small_operators(spark):
    d = spark.createDataFrame([("k", 1, "b"), ("k", 2, "a"), ("k", 3, None), ("l", 1, None)], "key string, n int, v string")
    assert rows(ranking.single_value(d, ["key"], "v"), "key", "distinct_values", "records", "status") == [("k", 2, 2, "SEVERAL"), ("l", 0, 0, "NONE")]
    assert rows(ranking.first_match(d, ["key"], ["n"], "v")) == [("k", "b")]
    assert [tuple(r) for r in ranking.first_with_alternates(d.where("v is not null"), ["key"], "v").select("v", "alternates").collect()] == [("a", ["b"])]
    assert rows(samples.report_view(d, {"n": "Number", "key": None, "absent": None}))[0] == (1, "k") and samples.report_view(d, {"key": None}).columns == ["Key"]
    assert samples.require_columns(d, ["n"]) is d
    with pytest.raises(ValueError):
        samples.require_columns(d, ["zz"])
    with pytest.raises(ValueError, match="closed list"):
        rollup.closed_list(spark.range(20), 10)
    assert rows(stages.ordered(spark.createDataFrame([("HA",), ("??",)], "segment string"), report=True), "ord") == [(4,), (99,)]
    got = [(r.g, r.x, r.read_no) for r in ranking.renumber(spark.createDataFrame([("a", None), ("a", 5), ("a", 1), (None, 2), (None, 2)], "g string, x int"), ["g"], ["x"]).collect()]
    assert sorted(got, key=str) == sorted([("a", None, 1), ("a", 1, 2), ("a", 5, 3), (None, 2, 1), (None, 2, 2)], key=str)
    assert rows(samples.compare_runs(spark.createDataFrame([("r1", "a", "1"), ("r2", "a", "2"), ("r1", "b", None), ("r2", "b", None)], "run string, field string, value string"))) == [("a", 2, 2), ("b", 1, 2)]


def test_segment_table(spark):
    keys = "sample string, segment string"
    grid = spark.createDataFrame([("s", "HA"), ("s", "NA")], keys)
    manifest = spark.createDataFrame([("s", "HA", "A_HA", 1700, "READY", 2, "", "best")], keys + ", contig string, fasta_length int, status string, candidate_count int, selection_status string, selection_reason string")
    stats = spark.createDataFrame([("s", "HA", " ", 1600, "FAIL", 9.5)], keys + ", contig string, consensus_length int, status string, median_depth double")
    out = {r.segment: r for r in rollup.segment_table(grid, manifest, stats, spark.createDataFrame([("s", "HA", "PASS")], keys + ", flag string"), ["sample", "segment"]).collect()}
    ha, na = out["HA"], out["NA"]
    assert (ha.contig, ha.length, ha.overall_status, ha.coverage_status, ha.selection_status, ha.median_depth, ha.candidate_count) == ("A_HA", "1600", "FAIL", "PASS", "MULTIPLE_CANDIDATES", "9.5", 2)
    assert (na.contig, na.length, na.overall_status, na.assembly_status, na.selection_status, na.length_status) == ("NA", "0", "MISSING", "MISSING", "MISSING", "NA")


def test_reads(spark):
    from segtally.operators import reads

    r = spark.createDataFrame([("a", "xxADAPmidADyy", "5555"), ("a", "plain", "!!??"), ("a", "ADAP", ""), ("b", "longertailADzz", "I")], "k string, seq string, q string")
    adapters = spark.createDataFrame([("ADAP",), ("AD",), ("",)], "a string")
    assert rows(reads.trim_ends(r, "seq", adapters, 6), "seq", "trimmed") == sorted([("mid", True), ("plain", False), ("", True), ("longertail", True)])
    assert rows(reads.trim_ends(r, "seq", adapters.limit(0), 6), "seq", "trimmed") == sorted((x.seq, False) for x in r.collect())
    flagged = r.withColumn("reason", F.when(F.col("seq") == "plain", "too_short").otherwise("passed")).withColumn("n", F.length("q"))
    s = {x.k: x for x in reads.read_qc_summary(flagged, ["k"], "n", "q").collect()}
    assert (s["a"].q20_rate_before, s["a"].q30_rate_before, s["a"].q20_rate_after, s["a"].q30_rate_after, s["b"].q30_rate_after) == (6 / 8, 2 / 8, 1.0, 0.0, 1.0)
    assert reads.read_set_stats(flagged, ["k"], "n", "n").where("k = 'a'").first().median_quality == 4.0
    d = spark.createDataFrame([("k", "c2", 1.0), ("k", "c1", 3.0)], "k string, c string, v double")
    assert depth.depth_stats(d, ["k"], "v", 2, "c").first().contigs == "c1,c2"
    assert depth.depth_stats(d, ["k"], "v", 2, "c", F.col("v")).first().contigs == "c2,c1"


def test_rows_without_a_name_are_dealt_out(spark):
    meta = spark.range(2000).select(F.when(F.col("id") % 2 == 0, " ").otherwise(F.col("id").cast("string")).alias("sample_id"), F.col("id").alias("line"))
    expected = spark.createDataFrame([("1",), (" 1",), ("",), ("x",)], "sample_id string")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = samples.metadata_issues(meta, expected).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    blank = [r for r in got if r.message == "sample_id is empty"]
    assert sorted(r.line for r in blank) == list(range(0, 2000, 2)) and {r.level for r in blank} == {"ERROR"}
    assert max(sum(r.task == t for r in blank) for t in {r.task for r in blank}) < 600
    assert sorted(r.line for r in got if r.message.startswith("no sample has")) == list(range(3, 2000, 2))
    assert [(r.line, r.level) for r in got if r.message == "sample without metadata: x"] == [(None, "WARNING")] and len(got) == 2000
