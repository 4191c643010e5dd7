from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import reports


def test_annotation_log(spark):
    log = "# VADR 1.6.4\n 1  CY002009  fluA-seg4  H5  1  1  0\n 2  X  fluA-seg6  -  2  1  1\n\n 1  lowsim5s  yes*  LOW_SIMILARITY_START  sequence  3  2  low similarity\n 2  y  no  B  feature  1  1  text\n[ok]\n"
    lines = spark.createDataFrame([("a", x) for x in log.split("\n")] + [("b", "nothing")], "path string, line string")
    assert {r.path: (r.version, r.completed) for r in reports.annotation_info(lines).collect()} == {"a": ("1.6.4", True), "b": (None, False)}
    m = reports.annotation_models(lines)
    assert sorted((r.segment, r.subgroup, r.status) for r in m.collect()) == [("HA", "H5", "PASS"), ("NA", None, "REVIEW")]
    assert tuple(reports.annotation_totals(m).first()) == ("a", 3, 2, 1)
    assert sorted((r.alert, r.effect, r.failure_causing, r.cases, r.sequences) for r in reports.annotation_alerts(lines).collect()) == [("lowsim5s", "Low Similarity Start", True, 3, 2), ("y", "B", False, 1, 1)]


def test_genotype_report(spark):
    free = "pident_threshold: 98.0\ns consensus Genotype --> Not assigned: Only 6 segments >98.0% match found of total 8 segments in input file: HA: a, na:b:c, HA:d, bad at percent identity\n"
    gate = lambda s: f"sample\tstatus\ns1\t{s}\n"
    rows = spark.createDataFrame([(0, free), (1, gate("H5N1_NOT_DETECTED")), (2, gate("DISABLED")), (3, ""), (4, None), (5, "else")], "i int, t string")
    got = {r.i: r for r in rows.select("i", *reports.parse_genotype_report(F.col("t"))).collect()}
    assert (got[0].status, got[0].threshold, got[0].matched_segments, got[0].input_segments, got[0].calls) == ("Not assigned", 98.0, 6, 8, {"HA": "d", "NA": "b:c"})
    assert [got[i].status for i in range(1, 6)] == ["Not run", "DISABLED", "Not available", "Not available", "Not available"]
    assert got[1].reason.endswith("NOT_DETECTED") and got[5].reason is None


def test_documents(spark):
    d = spark.createDataFrame([(1, '{"a":{"b":{"c":1},"l":[1,2]},"e":{},"s":"x"}')], "k int, j string")
    assert sorted((r.field, r.value) for r in reports.flatten_json(d, "k", "j").collect()) == [("a.b.c", "1"), ("a.l", "[1,2]"), ("s", "x")]
    good = '{"format":"run-document","version":1,"run":{"name":"1"},"samples":{"x/s1.html?q":{"n":1}}}'
    docs = spark.createDataFrame([(1, good), (2, "no json"), (3, '{"format":"other","samples":{"a":{}}}'), (4, None), (5, good.replace('"run":{"name":"1"},', ""))], "run int, document string")
    rows, rejects = reports.read_run_documents(docs, "run")
    assert [tuple(r) for r in rows.collect()] == [(1, "s1", '{"n":1}')] and sorted(r.run for r in rejects.collect()) == [2, 3, 4, 5]


def test_backfill_and_review(spark):
    old = spark.createDataFrame([("HA", 1700, 0.0, "pass", "NA"), ("HA", 10, 0.0, "PASS", ""), ("ZZ", 10, 0.0, "PASS", None), ("HA", 10, 0.5, None, "warning")], "segment string, length int, n_fraction double, coverage_status string, length_status string")
    got = [(r.length_status, r.n_content_status, r.overall_status) for r in reports.backfill_qc(old, 0.02).collect()]
    assert got == [("PASS", "PASS", "PASS"), ("FAIL", "PASS", "FAIL"), ("REVIEW", "PASS", "REVIEW"), ("WARNING", "FAIL", "REVIEW")]
    s = spark.createDataFrame([(8, "Complete", "OK", 0, 0), (8, "Complete", "NONE", 1, 2), (7, "Near-complete", None, 0, 0), (7, "Near-complete", "a;b", 0, 1)], "pass_segments int, genome_status string, review_flags string, f int, m int")
    r = [(x.review_required, x.review_reason) for x in reports.merge_reason(reports.derive_review(s), "f", "m").collect()]
    note = "Medaka: %d failed segment(s); %d IRMA fallback segment(s)"
    assert r == [(False, None), (True, note % (1, 2)), (True, "Genome status: Near-complete"), (True, "a; b; " + note % (0, 1))]


def test_columns(spark):
    assert reports.pick_column(["Position", "Depth", " Coverage-Depth "], ["coverage_depth", "depth"]) == " Coverage-Depth "
    assert reports.pick_column(["x"], ["depth"]) is None
    s = F.lit
    row = spark.range(1).select(E.matches(s("Barcode12"), r"barcode\d+"), E.segment_of_path(s("/a/HA.blast.tsv"), ".blast.tsv"), E.segment_of_path(s("/a/NA.txt"), ".tsv"), E.min_nullsafe(s(None).cast("int"), s(3)),
                                E.selection_reason(s(2), s(True), s(True), s(100.0)), E.selection_reason(s(1), s(False), s(True), s(None).cast("double"))).first()
    assert tuple(row) == (True, "HA", "NA", 3, "selected from 2 candidate(s); FASTA+BAM pair available; median depth=100", "selected from 1 candidate(s); BAM only; no parseable coverage table")


def test_genotype_report_holds_its_text_a_few_times(spark):
    odd = "\n \t\nsample\tstatus\tmore\n\n s1\t H5N1_NOT_DETECTED \tx\n"
    late = "S CONSENSUS  genotype -->\tB3.13 :\n\n see below \nonly x only\t6 of\nMATCH found of total\r\n 8\nsegments in input file: , ha : b , :c, na:"
    rows = spark.createDataFrame([(0, odd), (1, late), (2, late + " at percent identity"), (3, " \n\t")], "i int, a_report string")
    columns = reports.parse_genotype_report(F.col("a_report"))
    got = [tuple(r)[1:] for r in rows.select("i", *columns).orderBy("i").collect()]
    rest = ("B3.13", "see below", None, 6, 8)
    assert got == [("Not run", "not run: the screen was NOT_DETECTED", None, None, None, {}), (*rest, {}), (*rest, {"HA": "b"}), ("Not available", None, None, None, None, {})]
    plan = rows.select("i", *columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("a_report#") < 40, plan.count("a_report#")
