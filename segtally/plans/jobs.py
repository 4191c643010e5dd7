"""Whole jobs from files: the summary of every sample, and of a run. All samples go through one job; Parquet stands between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import depth, ranking, rollup, samples, scans, stages
from segtally.sources import fastq_head, files

#: Where a results folder holds each input: path below it, and the pattern of the sample in a path.
LAYOUT = {
    "metadata": "*/metadata.tsv", "read_qc": "*/read_qc.json", "coverage": "*/coverage.tsv", "hits": "*/blast/*.txt", "screen": "*/h5n1.flag", "genotype": "*/GenoFLU.tsv", "consensus": "*/consensus_all_segments.fasta", "stages": "*/medaka/*/*.status.tsv",
}


#: Where the inputs of segment QC are: a manifest a sample, depths and sequences a segment.
QC_LAYOUT = {"manifest": "*/manifest.tsv", "depth": "*/depth/*.tsv", "consensus": "*/consensus/*.fasta"}
MANIFEST = ["segment", "status", "contig", "fasta_length", "candidate_count", "selection_status", "selection_reason"]


def qc_job(spark: SparkSession, results: str, expected: DataFrame, bounds: DataFrame, layout: dict[str, str] = QC_LAYOUT, least_depth: float = 50, breadth: float = 0.95, most_n: float = 0.02, threshold: float = 10) -> DataFrame:
    """The segment table (sample, segment, measures, statuses) of every expected sample from its files below results.

    bounds: segment, lo, hi. A segment whose manifest does not say READY is MISSING; one whose
    sequence or depths cannot be read is ERROR, with the reason, and stops no other.
    """
    root = results.rstrip("/")
    sample, keys = rf"{root.rpartition('/')[2]}/([^/]+)/", ["sample", "segment"]
    parts = {"sample": sample, "segment": r"/([^/.]+)\.[^/]*$"}
    grid = rollup.segment_grid(expected.select("sample").distinct(), spark.createDataFrame([(x,) for x in E.SEGMENTS], "segment string"))
    manifest = files.read_table(spark, f"{root}/{layout['manifest']}", keys={"sample": sample}, columns=MANIFEST, line="_line")
    manifest = scans.cut(ranking.first_by(manifest, keys, [F.asc("_line")]).drop("_line"))  # eight rows a sample, read three times below
    ready = manifest.where("status = 'READY'").select(*keys)
    sequences = files.read_fasta(spark, f"{root}/{layout['consensus']}", parts, strict=True, expected=ready).select(*keys, "sequence", "error")
    depths = files.read_depth(spark, f"{root}/{layout['depth']}", parts, broken="row").join(ready, keys, "left_semi")
    broken = depths.where("error is not null").groupBy(*keys).agg(F.min_by("error", "line_no").alias("depth_error"))
    stats = depth.depth_stats(depths, keys, "depth", threshold, "contig", F.col("line_no")).withColumnRenamed("contigs", "contig")
    qc = depth.segment_qc(grid, sequences, stats.join(broken, keys, "left"), bounds, keys, least_depth, breadth, most_n)
    seen = F.col("status") != "MISSING"
    measured = qc.select(
        *keys, *(F.when(F.col("depth_error").isNull(), F.col(c)).alias(c) for c in ("contig", "positions", "median_depth", "mean_depth", "breadth_covered")), F.when(seen, F.nullif("consensus_length", F.lit(0))).alias("consensus_length"), "n_count", "n_fraction", F.col("lo").alias("expected_length_min"), F.col("hi").alias("expected_length_max"),
        F.lit(most_n).alias("maximum_n_fraction"), "coverage_status", "length_status", "n_content_status", "status", F.concat_ws(": ", "qc_reason", F.coalesce("error", "depth_error")).alias("qc_reason"))
    return rollup.segment_table(grid, manifest, measured, qc.select(*keys, F.col("status").alias("flag")), keys)


def model_job(spark: SparkSession, reads: str, sample: str, key: str, records: int = 100, override: str | None = None) -> DataFrame:
    """The model of every sample from the headers of the first records of its FASTQ files, FAILED where they name none or several; sample: pattern of the path. However long the files are, a bounded part of each is read."""
    heads = fastq_head.read_fastq_head(spark, reads, records, {"sample": sample})
    found = ranking.single_value(heads.withColumn("_model", E.header_value(F.col("header"), key)), ["sample"], "_model")
    detected = F.when(F.col("status") == "OK", F.col("value"))
    return found.select("sample", *stages.resolve_model(detected, override), F.col("status").alias("found"), F.col("records").alias("reads_with_model"))


def sample_job(spark: SparkSession, results: str, expected: DataFrame, layout: dict[str, str] = LAYOUT, genotyping: bool = True, coverage: DataFrame | None = None) -> DataFrame:
    """The sample summary of every expected sample (column sample) from its files below results; a kind of file that no sample has may be left out of the layout. coverage: the table of qc_job, in place of the files of that kind."""
    root = results.rstrip("/")
    sample = rf"{root.rpartition('/')[2]}/([^/]+)/"
    at = lambda kind: f"{root}/{layout[kind]}"
    keys = {"sample": sample}

    def kind(name: str, read, columns: str) -> DataFrame:
        return read(at(name)) if name in layout else spark.createDataFrame([], columns)

    metadata = kind("metadata", lambda p: files.read_table(spark, p, keys={"_folder": sample}, line="_line"), "_folder string, _line long")
    metadata = ranking.first_by(metadata.drop("sample").withColumnRenamed("_folder", "sample"), ["sample"], [F.asc("_line")]).drop("_line")
    read_qc = kind("read_qc", lambda p: files.read_read_qc_json(spark, p, keys), "sample string, " + ", ".join(f"{n} string" for n in files.READ_QC_FIELDS))
    coverage = coverage if coverage is not None else kind("coverage", lambda p: files.read_table(spark, p, keys={"_folder": sample}).drop("sample").withColumnRenamed("_folder", "sample"), "sample string, segment string, coverage_flag string, contig string, median_depth string, candidate_count string")
    hits = kind("hits", lambda p: files.read_hits(spark, p, {**keys, "segment": r"/([^/.]+)\.[^/]*$"}), "sample string, segment string, subject_title string, percent_identity double, evalue double, bit_score double")
    top = ranking.top_hit(hits, ["sample", "segment"]).select("sample", "segment", F.col("subject_title").alias("top_hit"))
    flags = kind("screen", lambda p: files.read_flags(spark, p, sample), "key string, flag string").select(F.col("key").alias("sample"), F.col("flag").alias("screen"))
    texts = kind("genotype", lambda p: files.with_keys(spark.read.text(p, wholetext=True), keys), "sample string, value string")
    genotype = texts.select("sample", samples.genotype_status(F.col("value"), genotyping).alias("genoflu_status"))
    consensus = kind("consensus", lambda p: files.read_fasta(spark, p, keys), "sample string")
    return samples.sample_summary(expected.select("sample"), metadata, read_qc, coverage, top, flags, genotype, consensus.select("sample"))


def read_summaries(spark: SparkSession, paths: str, sample: str, expected: DataFrame) -> DataFrame:
    """The sample summaries of every expected ``sample_id``, each file by its own header; sample: pattern of the id in a path. An id whose file is absent or empty raises."""
    return samples.recovered_ids(files.read_table(spark, paths, keys={"_folder": sample}), expected, "_folder")


def run_job(spark: SparkSession, results: str, summaries: list[DataFrame], layout: dict[str, str] = LAYOUT) -> DataFrame:
    """The run summary of sample summaries with the stage status files below results."""
    root = results.rstrip("/")
    keys = {"sample_id": rf"{root.rpartition('/')[2]}/([^/]+)/", "segment": r"/([^/]+)/[^/]+$", "stage": r"/([^/.]+)\.status\.tsv$"}
    status = files.read_stage_status(spark, f"{root}/{layout['stages']}", keys).withColumn("stage", F.replace("stage", F.lit("variants"), F.lit("variant")))
    grid = status.select("sample_id", "segment").distinct()
    wide = rollup.stage_status_wide(grid, status, ["sample_id", "segment"], "stage", ["inference", "consensus", "variant"], ["status", "source", "reason"])
    return samples.run_summary(summaries, rollup.stage_rollup(wide, "sample_id"))
