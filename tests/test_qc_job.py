"""QC of a run from its files, and what is read of long FASTQ files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import rollup
from segtally.plans import jobs
from segtally.sources import fastq_head, files
from tests_common import put, rows

KEY = r"in/([^/]+)/"
COLUMNS = "\t".join(jobs.MANIFEST)


def sample(root, name, segments, **broken):
    put(root / name / "manifest.tsv", COLUMNS + "\n" + "".join(f"{s}\tREADY\tA_{s}\t1700\t{2 if s == 'HA' else 1}\t\tdeepest\n" for s in segments) + "NS\tMISSING\tNA\t0\t0\tMISSING\tnone\n")
    for s in segments:
        put(root / name / f"depth/{s}.tsv", "".join(f"A_{s}\t{p}\t{60 + p % 3}\textra\n" for p in range(1, 101)))
        put(root / name / f"consensus/{s}.fasta", f">{s}\n{'ACGT' * 25}\n{'acgt' * 400}\n")
    for path, text in broken.items():
        put(root / name / path.replace("__", "/").replace("_DOT_", "."), text)


def test_a_bad_sample_stops_no_other(spark, tmp_path):
    root = tmp_path / "in"
    segments = ["HA", "NA", "PB2", "MP"]
    sample(root, "good", segments)
    sample(root, "bad", segments, depth__HA_DOT_tsv="c\t1\t7\nc\t2\tx\n", consensus__NA_DOT_fasta="ACGT\n>late\n", consensus__PB2_DOT_fasta="", depth__MP_DOT_tsv="")
    put(root / "bad/manifest.tsv", "status\tsegment\tmore\tcontig\n" + "".join(f"READY\t{s}\tx\tB_{s}\n" for s in segments))
    expected = spark.createDataFrame([("good",), ("bad",), ("absent",)], "sample string")
    bounds = spark.createDataFrame([(s, 1600, 1800) for s in E.SEGMENTS], "segment string, lo int, hi int")
    table = jobs.qc_job(spark, str(root), expected, bounds).cache()
    got = {(r["sample"], r["segment"]): r for r in table.collect()}
    assert len(got) == 24
    good = got["good", "HA"]
    assert (good.overall_status, good.contig, good.length, good.median_depth, good.candidate_count, good.selection_status, good.assembly_status) == ("PASS", "A_HA", "1700", "61.0", 2, "MULTIPLE_CANDIDATES", "READY")
    assert {s: got["good", s].overall_status for s in E.SEGMENTS} == {s: "PASS" if s in segments else "MISSING" for s in E.SEGMENTS} and got["good", "NS"].assembly_status == "MISSING"
    bad = {s: (got["bad", s].overall_status, got["bad", s].coverage_status, got["bad", s].length_status) for s in segments}
    assert bad == {"HA": ("ERROR", "ERROR", "PASS"), "NA": ("ERROR", "NA", "ERROR"), "PB2": ("ERROR", "NA", "ERROR"), "MP": ("MISSING", "MISSING", "PASS")}
    assert got["bad", "HA"].qc_reason.endswith("depth is no whole number, line 2") and got["bad", "NA"].qc_reason.endswith("sequence before the header, line 1") and got["bad", "PB2"].qc_reason.endswith("missing or empty")
    assert (got["bad", "HA"].contig, got["bad", "HA"].selection_status) == ("B_HA", "MISSING") and {got["absent", s].overall_status for s in E.SEGMENTS} == {"MISSING"}
    # on to the sample summary
    put(root / "good/read_qc.json", json.dumps({"summary": {"before_filtering": {"total_reads": 10}}}))
    put(root / "bad/metadata.tsv", "host\tsample\nduck\tx\n")
    put(root / "good/metadata.tsv", "sample\tcountry\ngood\tDE\n")
    layout = {k: jobs.LAYOUT[k] for k in ("metadata", "read_qc")}
    summary = {r["sample"]: r for r in jobs.sample_job(spark, str(root), expected, layout, coverage=table).collect()}
    one, two, none = (summary[s] for s in ("good", "bad", "absent"))
    assert (one.segments_pass, one.pass_segment_names, one.ha_contig, one.ha_median_depth, one.reads_before, one.country, one.host) == (4, "HA,NA,PB2,MP", "A_HA", "61.0", "10", "DE", None)
    assert (two.segments_pass, two.segments_missing, two.host, two.country, two.reads_before) == (0, 5, "duck", None, "NA") and none.segments_missing == 8


def test_first_records_of_long_files(spark, tmp_path):
    root = tmp_path / "in"
    text = "".join(f"@r{i} model=m{1 if i < 9000 else 2}\n{'ACGT' * 50}\n+\n{'IIII' * 50}\n" for i in range(20000))
    put(root / "a b/x.fastq", text)
    put(root / "gz/x.fastq.gz", "")
    with gzip.open(root / "gz/x.fastq.gz", "wt") as h:
        h.write(text.replace("model=m1", "model=m9"))
    put(root / "two/x.fastq", "@r model=p\nA\n+\nI\n@r model=q\nA\n+\nI\n")
    put(root / "none/x.fastq", "@r\nA\n+\nI\n")
    put(root / "empty/x.fastq", "")
    t = fastq_head.read_fastq_head(spark, f"{root}/*/x.fastq*", 100, {"sample": KEY})
    n = {r["sample"]: (r.n, r.last, r.b) for r in t.groupBy("sample").agg(F.count("*").alias("n"), F.max("read_no").alias("last"), F.max("bytes_read").alias("b")).collect()}
    assert n["a%20b"][:2] == (100, 100) and n["a%20b"][2] <= 2 * fastq_head.STEP < len(text) / 50 and n["gz"][2] <= 2 * fastq_head.STEP and n["two"][0] == 2 and "empty" not in n
    whole = files.read_fastq(spark, f"{root}/a b/x.fastq", {"sample": KEY}).where("read_no <= 100")
    assert rows(t.where("sample = 'a%20b'"), "read_no", "header", "sequence", "quality") == rows(whole, "read_no", "header", "sequence", "quality")
    models = {r["sample"]: (r.model, r.model_status, r.found) for r in jobs.model_job(spark, f"{root}/*/x.fastq*", KEY, "model", 100).collect()}
    assert models == {"a%20b": ("m1", "RESOLVED", "OK"), "gz": ("m9", "RESOLVED", "OK"), "two": ("", "FAILED", "SEVERAL"), "none": ("", "FAILED", "NONE")}
    assert {r.model_source for r in jobs.model_job(spark, f"{root}/*/x.fastq*", KEY, "model", 100, "set").collect()} == {"config override"}
    put(root / "bad/x.fastq", "@r\nA\n+\n")
    with pytest.raises(Exception, match="broken record 1"):
        fastq_head.read_fastq_head(spark, f"{root}/bad/x.fastq", 5).collect()


def test_run_documents_of_any_size(spark, tmp_path):
    data = [(r, f"s{k:04}", k) for r in ("r1", "r2") for k in range(500 if r == "r1" else 3)]
    samples = spark.createDataFrame(data, "run string, sample string, n int")
    runs = spark.createDataFrame([("r1", "first"), ("r2", "second")], "run string, title string").select("run", F.struct("title").alias("run_section"))
    lines = rollup.run_document_lines(samples, "run", F.struct("n", F.lit('a"\nb').alias("text")), "sample", runs, "2026-01-01")
    files.write_run_document(lines, f"{tmp_path}/doc", "run", 6)
    parts = sorted((tmp_path / "doc/run=r1").glob("part-*"))
    assert len(parts) > 2
    doc = json.loads("".join(p.read_text() for p in parts))
    assert (doc["format"], doc["generated_at"], doc["run"], doc["sample_count"], len(doc["samples"])) == ("run-document", "2026-01-01", {"title": "first"}, 500, 500)
    assert doc["samples"]["s0007"] == {"n": 7, "text": 'a"\nb'} and list(doc["samples"]) == sorted(doc["samples"])
    back, rejects = rollup.document_samples(files.read_run_document_lines(spark, f"{tmp_path}/doc", "run"), "run")
    assert back.count() == 503 and rejects.count() == 0 and back.where("sample = 's0007' and run = 'r1'").select(F.get_json_object("payload", "$.n")).first()[0] == "7"
    bad = spark.createDataFrame([("a", '{"format":"other","run":{"x":1},"samples":{'), ("a", '"s":{"n":1}'), ("b", '{"format":"run-document","samples":{'), ("b", '"s":{"n":1}'), ("c", '{"format":"run-document","run":{"x":1},"samples":{'), ("d", '"x.html?q#f":{"n":1}'), ("d", '{"format":"run-document","run":{"x":1},"samples":{')], "run string, value string")
    good, rejects = rollup.document_samples(bad, "run")
    assert rows(rejects) == [("a", "format"), ("b", "no run section"), ("c", "no sample")] and rows(good) == [("d", "x", '{"n":1}')]
    with pytest.raises(Exception, match="sample twice"):
        rollup.run_document_lines(samples.union(samples.limit(1)), "run", F.struct("n"), "sample").collect()
    with pytest.raises(Exception, match="no sample in run"):
        rollup.run_document_lines(samples, "run", F.struct("n"), "sample", runs.union(runs.limit(1).withColumn("run", F.lit("r3")))).collect()
