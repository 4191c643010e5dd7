"""Sample and run summaries, metadata validation, report tables, provenance and run documents as whole operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import ranking, reports, rollup
from segtally.sources.files import READ_QC_FIELDS, write_validation_report

# The columns of a sample summary behind its metadata, in order.
ANALYTICAL = [
    "reads_before", "reads_after", "bases_before", "bases_after", "q20_rate_before", "q20_rate_after", "q30_rate_before", "q30_rate_after", "reads_passed", "reads_low_quality", "reads_too_short", "reads_with_adapters",
    "segments_detected", "segments_pass", "pass_segment_names", "failed_segment_names", "segments_missing", "missing_segment_names", "ha_contig", "na_contig", "ha_median_depth", "na_median_depth", "h5n1_screen", "genoflu_status",
    "consensus_segments", "multiple_irma_candidate_segments", "multiple_irma_candidate_count", "max_irma_candidate_count", "review_flags", "ha_top_blast_hit", "na_top_blast_hit",
]

# Columns that a run summary has by these values where no summary brings them.
RUN_DEFAULTS = {"host_common_name": "Unknown", "host_species": "Unknown", "collection_date": "Unknown", "state": "Unknown", "flyway": "Unknown", "multiple_irma_candidate_segments": "NONE"}
RUN_MEASURES = ["subtype_min_median_depth", "aa_changes", "synonymous_changes", "nonsynonymous_changes"]


def picked(by: str, wanted: dict[str, tuple[str, str]], default: str = "NA") -> list[Column]:
    """Aggregates: for each name of wanted (value of by, column), that column of the group's first such row in the order of the column; default without one."""
    return [F.coalesce(F.min(F.when(F.col(by) == v, F.col(c).cast("string"))), F.lit(default)).alias(n) for n, (v, c) in wanted.items()]


def pick(df: DataFrame, key: str, by: str, wanted: dict[str, tuple[str, str]], default: str = "NA") -> DataFrame:
    """key and what ``picked`` finds of each key."""
    return df.groupBy(key).agg(*picked(by, wanted, default))


def record_counts(records: DataFrame, key: str, name: str = "records") -> DataFrame:
    return records.groupBy(key).agg(F.count("*").alias(name))


def genotype_status(text: Column, enabled: bool = True) -> Column:
    """One word for a genotype report: what the gate wrote, COMPLETED, MISSING, or DISABLED_BY_CONFIG."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), E.strip), lambda x: x != "")
    gated = (F.size(lines) == 2) & F.get(lines, F.lit(0)).startswith("sample\tstatus")
    word = F.when(F.size(lines) == 0, "MISSING").when(gated, F.regexp_replace(F.try_element_at(lines, F.lit(2)), r"^[^\t]*\t", "")).otherwise("COMPLETED")
    return word if enabled else F.lit("DISABLED_BY_CONFIG")


def sample_summary(samples: DataFrame, metadata: DataFrame, read_qc: DataFrame, coverage: DataFrame, hits: DataFrame, screen: DataFrame, genotype: DataFrame, consensus: DataFrame, key: str = "sample") -> DataFrame:
    """One row a sample: metadata, then ``ANALYTICAL``; metadata columns of such names get the prefix ``metadata_``.

    read_qc: the twelve fields; coverage: segment, coverage_flag, contig, median_depth,
    candidate_count; hits: segment, top_hit; screen: screen; genotype: genoflu_status;
    consensus: a row for each sequence. Every table has the key.
    """
    reserved = {key, *ANALYTICAL}
    own = [F.col(f"`{c}`").alias(f"metadata_{c}" if c in reserved else c) for c in metadata.columns if c != key]
    names = [f"metadata_{c}" if c in reserved else c for c in metadata.columns if c != key]
    count = F.coalesce(F.col("candidate_count").try_cast("int"), F.lit(0))
    at = F.array(*map(F.lit, E.SEGMENTS))
    listed = lambda which: E.first_nonempty(F.array_join(F.array_intersect(at, F.collect_set(F.when(which, F.col("segment")))), ","), F.lit("NONE"))
    flag = F.col("coverage_flag")
    ends = picked("segment", {"ha_contig": ("HA", "contig"), "na_contig": ("NA", "contig"), "ha_median_depth": ("HA", "median_depth"), "na_median_depth": ("NA", "median_depth")})
    c = coverage.groupBy(key).agg(
        *ends,
        F.count_if(flag != "MISSING").alias("segments_detected"), F.count_if(flag == "PASS").alias("segments_pass"), F.count_if(flag == "FAIL").alias("_failed"), F.count_if(flag == "MISSING").alias("segments_missing"),
        listed(flag == "PASS").alias("pass_segment_names"), listed(flag == "FAIL").alias("failed_segment_names"), listed(flag == "MISSING").alias("missing_segment_names"),
        listed(count > 1).alias("multiple_irma_candidate_segments"), F.count_if(count > 1).alias("multiple_irma_candidate_count"), F.greatest(F.max(count), F.lit(1)).alias("max_irma_candidate_count"))
    top = pick(hits, key, "segment", {"ha_top_blast_hit": ("HA", "top_hit"), "na_top_blast_hit": ("NA", "top_hit")}, "NO_HIT")
    parts = [metadata.select(key, *own), read_qc.select(key, *READ_QC_FIELDS), c, top, screen.select(key, F.upper(E.clean(F.col("screen"))).alias("_screen")), genotype.select(key, F.col("genoflu_status").alias("_genotype")), record_counts(consensus, key, "_consensus")]
    j = reduce(lambda a, b: a.join(b, key, "left"), parts, samples.select(key))
    zero = lambda n: F.coalesce(F.col(n), F.lit(0))
    shown = F.coalesce(E.normalize_screen(F.col("_screen")), F.lit("MISSING"))
    known = F.when(shown.isin("DETECTED", "NOT_DETECTED"), shown).otherwise("INDETERMINATE")
    flags = E.review_flags(zero("segments_pass"), known, zero("_failed"), zero("_consensus"), zero("multiple_irma_candidate_count"))
    j = j.withColumns({"h5n1_screen": shown, "genoflu_status": F.coalesce("_genotype", F.lit("MISSING")), "consensus_segments": zero("_consensus"), "review_flags": flags})
    words = {"pass_segment_names": "NONE", "failed_segment_names": "NONE", "missing_segment_names": "NONE", "multiple_irma_candidate_segments": "NONE", "ha_top_blast_hit": "NO_HIT", "na_top_blast_hit": "NO_HIT"}
    numbers = {"segments_detected": 0, "segments_pass": 0, "segments_missing": 0, "multiple_irma_candidate_count": 0, "max_irma_candidate_count": 1}
    absent = {**{n: "NA" for n in [*READ_QC_FIELDS, "ha_contig", "na_contig", "ha_median_depth", "na_median_depth"]}, **words, **numbers}
    return j.select(key, *(F.col(f"`{n}`") for n in names), *(F.coalesce(F.col(n), F.lit(absent[n])).alias(n) if n in absent else F.col(n) for n in ANALYTICAL))


def recovered_ids(summaries: DataFrame, expected: DataFrame, path_id: str, key: str = "sample_id") -> DataFrame:
    """The summary rows of every expected id (column key), with ``key`` as their first column.

    summaries: path_id (the id in the path of the row's file), then what the files hold, null
    where a file lacks a column. A row's id is its ``key``, or its ``sample`` where the file has no
    ``key``; a blank one gives way to the id in the path. An expected id without any row, as its
    file is absent or holds no record, raises. Files that are not expected are left out.
    """
    own = [F.col(f"`{c}`") for c in summaries.columns if c not in (path_id, key, "sample")]
    given = [E.strip(F.col(c)) for c in (key, "sample") if c in summaries.columns]
    found = F.nullif(F.coalesce(*given, F.lit("")), F.lit(""))
    rows = summaries.select(F.col(path_id).alias("_path_id"), F.coalesce(found, F.col(path_id)).alias("_found"), *own)
    j = expected.select(F.col(key).alias("_expected")).distinct().join(rows, F.col("_expected") == F.col("_path_id"), "left")
    absent = F.raise_error(F.concat(F.lit("no summary, or an empty one: "), "_expected")).cast("boolean")
    return j.where(F.when(F.col("_path_id").isNull(), absent).otherwise(True)).select(F.col("_found").alias(key), *own)


def current_columns(s: DataFrame) -> DataFrame:
    """Summaries of any version with what the present one has: counts as numbers (0 for none), screens as one of three words, ``RUN_DEFAULTS`` and ``RUN_MEASURES`` (null) where the column is absent."""
    new = {"pass_segments": rollup.versioned_column(s, ["pass_segments", "segments_pass", "coverage_segments", "segments_detected"])}
    new["coverage_segments"] = rollup.versioned_column(s, ["coverage_segments", "segments_detected"], new["pass_segments"])
    new["multiple_irma_candidate_count"] = rollup.versioned_column(s, ["multiple_irma_candidate_count"], F.lit(0.0))
    new["h5n1_screen"] = E.normalize_screen(F.col("h5n1_screen"), strict=True) if "h5n1_screen" in s.columns else F.lit("INDETERMINATE")
    new |= {n: F.lit(v) for n, v in RUN_DEFAULTS.items() if n not in s.columns} | {n: F.lit(None).cast("double") for n in RUN_MEASURES if n not in s.columns}
    return s.withColumns(new)


def run_summary(summaries: list[DataFrame], stages: DataFrame, key: str = "sample_id") -> DataFrame:
    """All sample summaries of a run with subtype calls, genome status, stage counts and what asks for review; summaries of other versions may lack columns.

    stages: rollup.stage_rollup by ``sample_id``.
    """
    s = rollup.union_versions(*summaries)
    if key not in s.columns:
        s = s.withColumnRenamed("sample", key)
    elif "sample" in s.columns:
        s = s.withColumn(key, F.coalesce(F.nullif(E.clean(F.col(key)), F.lit("")), F.col("sample"))).drop("sample")
    s = current_columns(s)
    s = s.withColumn("genome_status", E.genome_status(F.col("pass_segments")))
    for n in ("ha_contig", "na_contig", "ha_top_blast_hit", "na_top_blast_hit"):
        if n not in s.columns:
            s = s.withColumn(n, F.lit("NA"))
    h, n = (F.coalesce(E.extract_subtype(F.col(f"{x}_contig"), p), E.extract_subtype(F.col(f"{x}_top_blast_hit"), p)) for x, p in (("ha", "H"), ("na", "N")))
    s = s.withColumns({"ha_call": E.normalize_unknown(F.coalesce(h, F.lit(""))), "na_call": E.normalize_unknown(F.coalesce(n, F.lit(""))), "potential_subtype": E.normalize_unknown(E.compose_subtype(h, n))})
    s = reports.derive_review(s)
    counts = [c for c in stages.columns if c != key]
    s = s.join(stages, key, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    return reports.merge_reason(s, "failed_segments", "fallback_segments")


def attention(run: DataFrame) -> DataFrame:
    """Samples whose screen found something or could not tell."""
    return run.where(F.col("h5n1_screen").isin("DETECTED", "INDETERMINATE"))


def failure_causing(alerts: DataFrame) -> DataFrame:
    return alerts.where("failure_causing")


def several_candidates(coverage: DataFrame) -> DataFrame:
    return coverage.where(F.coalesce(F.col("candidate_count").try_cast("int"), F.lit(0)) > 1)


def populated_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """values: the distinct values, sorted and joined, of the first column that holds any but blanks and UNKNOWN. Such columns are closed lists (hosts)."""
    good = lambda c: F.when(~F.upper(E.clean(F.col(c))).isin("", "UNKNOWN"), E.strip(F.col(c)))
    there = [c for c in columns if c in df.columns]
    a = df.agg(*(F.array_join(F.array_sort(F.collect_set(good(c))), ", ").alias(c) for c in there)) if there else df.limit(0).agg(F.lit(None).cast("string").alias("_"))
    return a.select(E.first_nonempty(*(F.col(c) for c in there), F.lit("Not available")).alias("values"))


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    return df


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key and side: both, left or right."""
    one = lambda df, n: df.select(key).distinct().withColumn(n, F.lit(True))
    j = one(a, "_a").join(one(b, "_b"), key, "full")
    return j.select(key, F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "left").otherwise("right").alias("side"))


def report_view(df: DataFrame, spec: dict[str, str | None]) -> DataFrame:
    """Columns of df in the order of spec, by their new names; without one in title case. Columns that df lacks are left out."""
    title = lambda c: " ".join(w[:1].upper() + w[1:] for w in c.split("_"))
    return df.select(*(F.col(f"`{c}`").alias(n or title(c)) for c, n in spec.items() if c in df.columns))


def equal_bins(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """bin (from 1), low, high and n of equally wide bins from the least to the largest value; empty bins are 0."""
    c = F.col(column).cast("double")
    ends = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    counts = df.where(c.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.least(F.floor((c - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins))).alias("bin")).agg(F.count("*").alias("n"))  # ends is one row
    every = ends.where("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"))
    edge = lambda k: F.col("lo") + (F.col("hi") - F.col("lo")) * k / bins
    return every.join(counts, "bin", "left").select("bin", edge(F.col("bin") - 1).alias("low"), edge(F.col("bin")).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def metadata_issues(meta: DataFrame, samples: DataFrame, key: str = "sample_id", line: str = "line", dates: tuple[str, ...] = (), coordinates: dict[str, tuple[float, float]] | None = None, barcode: str | None = None, strict: bool = False) -> DataFrame:
    """line, level, message of everything that is wrong with a metadata table; line as sources.tables.read_table numbers its rows.

    A row without a key is an error and looked at no further. The second and later rows of a
    key are errors, rows of no sample warnings. A sample without metadata is a warning, or
    an error if strict, without a line.
    """
    if line not in meta.columns:
        raise ValueError(f"the table has no column {line!r}; read it with its line numbers")
    name = E.clean(F.col(key).cast("string"))
    own = [c for c in (*dates, *(coordinates or {}), *([barcode] if barcode else [])) if c in meta.columns]
    found = meta.select(F.col(line).cast("long").alias("_line"), name.alias("_name"), *(E.clean(F.col(c).cast("string")).alias(c) for c in own), F.lit(False).alias("_known"))
    known = samples.select(E.clean(F.col(key).cast("string")).alias("_name")).distinct().where("_name != ''").withColumn("_known", F.lit(True))
    # a sample stands behind the rows of its name; rows without a name, of which there may be any number, are compared with nothing
    by = ["_name", "_alone"]
    rows = found.unionByName(known, allowMissingColumns=True).withColumn("_alone", F.when(F.col("_name") == "", F.col("_line")))
    rows = ranking.flag_duplicates(rows, by, [F.asc("_known"), F.asc("_line")]).withColumn("_expected", F.max("_known").over(Window.partitionBy(*by)))
    issue = lambda level, when, message: F.when(when, F.struct(F.lit(level).alias("level"), message.alias("message")))
    said = lambda text, c: F.concat(F.lit(text), F.lit(": "), F.col(c))
    checks = [issue("ERROR", F.col("duplicate"), said(f"{key} stands here again", "_name")), issue("WARNING", ~F.col("_expected"), said(f"no sample has this {key}", "_name"))]
    checks += [issue("ERROR", ~E.valid_iso_date(F.col(c)), said(f"{c} is no date of the form YYYY-MM-DD", c)) for c in dates if c in own]
    checks += [issue("ERROR", ~E.valid_coordinate(F.col(c), lo, hi), said(f"{c} is no number from {lo:g} to {hi:g}", c)) for c, (lo, hi) in (coordinates or {}).items() if c in own]
    if barcode in own:
        checks.append(issue("WARNING", (F.col(barcode) != "") & ~F.lower(barcode).rlike(r"^barcode\d+$"), said(f"{barcode} is not of the form barcode01", barcode)))
    lost = issue("ERROR" if strict else "WARNING", ~F.col("duplicate"), said("sample without metadata", "_name"))
    all_checks = F.when(F.col("_known"), F.array(lost)).when(F.col("_name") == "", F.array(issue("ERROR", F.lit(True), F.lit(f"{key} is empty")))).otherwise(F.array(*checks))
    return rows.select(F.when(~F.col("_known"), F.col("_line")).alias("line"), F.inline(F.array_compact(all_checks)))


def validate_metadata(meta: DataFrame, samples: DataFrame, columns: list[str], key: str = "sample_id", line: str = "line", dates: tuple[str, ...] = (), coordinates: dict[str, tuple[float, float]] | None = None,
                      barcode: str | None = None, strict: bool = False, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The conformed table, the issues (metadata_issues) and the counters (name, value).

    Of several rows of a key the last line wins in the table. All samples without metadata
    count as one warning (or error). With path, the report is written before errors raise.
    """
    issues = metadata_issues(meta, samples, key, line, dates, coordinates, barcode, strict)
    rows = ranking.flag_duplicates(meta.where(E.clean(F.col(key).cast("string")) != ""), [key], [F.asc(line)])
    table = rollup.conform_metadata(rows.where("last").drop("duplicate", "last"), samples.select(key).distinct(), key, columns)
    lost = F.col("line").isNull()
    count = lambda level: (F.count_if((F.col("level") == level) & ~lost) + F.coalesce(F.max(F.when((F.col("level") == level) & lost, 1)), F.lit(0))).cast("long")
    # the counters need the names of the table and how often each stands there, not its rows
    sides = samples.select(key, F.lit(1).alias("_samples"), F.lit(0).alias("_rows")).unionByName(meta.select(key, F.lit(0).alias("_samples"), F.lit(1).alias("_rows")))
    names = sides.groupBy(key).agg((F.max("_samples") > 0).alias("_sample"), F.sum("_rows").alias("_rows"))
    there = (F.col("_rows") > 0) & (E.clean(F.col(key).cast("string")) != "")
    counts = (
        names.agg(F.count_if("_sample").alias("expected"), F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("rows"), F.count_if(F.col("_sample") & there).alias("matched"), F.count_if(F.col("_sample") & ~there).alias("missing"))
        .crossJoin(issues.agg(count("WARNING").alias("warnings"), count("ERROR").alias("errors")))  # one row each
        .unpivot([], ["expected", "rows", "matched", "missing", "warnings", "errors"], "name", "value")
    )
    if path:
        write_validation_report(counts, issues, path)
    return table, issues, counts


def segment_payload(qc: DataFrame, key: str, thresholds: dict[str, float], columns: list[str]) -> DataFrame:
    """key and a JSON text with the thresholds and the segments, in report order, as objects; NaN becomes null. A sample has eight segments."""
    at = F.array_position(F.array(*map(F.lit, E.REPORT_ORDER)), F.col("segment"))
    clean = [(F.when(~F.isnan(c), F.col(c)) if t in ("double", "float") else F.col(c)).alias(c) for c, t in qc.select(*columns).dtypes]
    item = F.struct(F.when(at > 0, at).otherwise(99).alias("ord"), F.struct("segment", *clean).alias("v"))
    g = qc.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias("segments"))
    limits = F.struct(*(F.lit(v).alias(k) for k, v in thresholds.items()))
    return g.select(key, F.to_json(F.struct(limits.alias("thresholds"), "segments"), {"ignoreNullFields": "false"}).alias("payload"))


def provenance(params: DataFrame, files: DataFrame, database: DataFrame, run: str = "run") -> DataFrame:
    """run and a JSON document: parameters, file checksums by name, the record of the reference database (null without one).

    params: run, columns; files: run, name, sha256, checksum_status; database: run, columns.
    """
    inner = lambda df: F.struct(*(c for c in df.columns if c != run))
    f = files.groupBy(run).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", F.struct("sha256", "checksum_status"))))).alias("files"))  # a few files a run
    d = database.select(run, inner(database).alias("database"))
    j = params.select(run, inner(params).alias("parameters")).join(f, run, "left").join(d, run, "left")
    return j.select(run, F.to_json(F.struct("parameters", "files", "database"), {"ignoreNullFields": "false"}).alias("document"))


def sample_cards(summary: DataFrame, key: str = "sample") -> DataFrame:
    """key, metric, value: the header of each sample report."""
    review = F.when(F.col("review_flags") == "NONE", "No").otherwise(F.concat(F.lit("Yes: "), F.replace("review_flags", F.lit(";"), F.lit("; "))))
    cards = {"Screen": F.initcap(F.replace("h5n1_screen", F.lit("_"), F.lit(" "))), "Passing segments": F.concat(F.col("segments_pass").cast("string"), F.lit("/8")), "Reads after filtering": F.col("reads_after").cast("string"), "Review": review}
    return reports.metric_table(summary, key, cards)


def variant_table(wide: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, consensus_source, variants (what the report shows), variant_reason of each segment. wide: rollup.stage_status_wide; counts: keys, records."""
    from segtally.operators.stages import variant_display

    j = wide.join(counts, keys, "left")
    return j.select(*keys, "consensus_source", variant_display(F.col("variant_status"), F.col("inference_status"), F.col("records")).alias("variants"), "variant_reason")


def files_table(coverage: DataFrame, wide: DataFrame, artifacts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, length, overall_status, the stages, and which files of each segment can be had, for the files table of all sample reports.

    coverage: keys, length, overall_status; wide: rollup.stage_status_wide with the stages inference,
    consensus (status, source) and variant; artifacts: keys, kind (consensus or vcf), path, bytes, records.
    Files of no bytes count as absent; of several the first path counts. A table of variants without a
    recorded stage, as old runs have them, is shown too.
    """
    there = artifacts.where("bytes > 0")
    of = lambda kind, c: F.min_by(F.when(F.col("kind") == kind, F.col(c)), F.when(F.col("kind") == kind, F.col("path")))
    a = there.groupBy(*keys).agg(of("consensus", "path").alias("_consensus"), of("vcf", "path").alias("_vcf"), F.coalesce(of("vcf", "records"), F.lit(0)).alias("_records"))
    j = coverage.join(wide, keys, "left").join(a, keys, "left")
    word = {n: F.coalesce(F.col(n), F.lit("NOT_RECORDED")) for n in ("inference_status", "consensus_status", "consensus_source", "variant_status")}
    variant, vcf = word["variant_status"], F.col("_vcf").isNotNull()
    counted = F.concat(F.col("_records").cast("string"), F.when(F.col("_records") == 1, " variant").otherwise(" variants"))
    called = vcf & ~variant.isin("FAILED", "SKIPPED_QC")
    skipped = (variant == "SKIPPED_QC") | (F.coalesce("overall_status", F.lit("")) != "PASS")
    calls = F.when(called, counted).when(variant == "FAILED", "FAILED").when(skipped, "Skipped: segment QC").otherwise("No VCF produced")
    source = F.when(~word["consensus_source"].isin("", "NOT_RECORDED"), F.concat(F.lit(" · "), F.replace(word["consensus_source"], F.lit("_"), F.lit(" "))))
    return j.select(
        *keys, "length", "overall_status", word["inference_status"].alias("inference_status"), F.concat(F.replace(word["consensus_status"], F.lit("_"), F.lit(" ")), F.coalesce(source, F.lit(""))).alias("consensus"),
        F.coalesce("_consensus", F.lit("Not available")).alias("consensus_file"), variant.alias("variant_status"), calls.alias("variants"), F.coalesce(F.when(called, F.col("_vcf")), F.lit("Not generated")).alias("variant_file"))


def compare_runs(fields: DataFrame, run: str = "run") -> DataFrame:
    """field and the number of distinct values of flattened provenance documents: where runs differ."""
    return fields.groupBy("field").agg(F.count_distinct(F.coalesce("value", F.lit("null"))).alias("distinct_values"), F.count_distinct(run).alias("runs"))




def run_report(run: DataFrame) -> dict[str, DataFrame]:
    """The tables of a run report, from run_summary: completeness and screen overviews, samples that need attention or review, and distributions."""
    title = {"sample_id": "Sample", "host": None, "potential_subtype": "Subtype", "pass_segments": "Passing segments", "genome_status": None, "h5n1_screen": "H5N1 screen", "review_required": None, "review_reason": None}
    depth_ = E.min_nullsafe(*(F.col(f"{x}_median_depth").try_cast("double") for x in ("ha", "na")))
    return {
        "overview": rollup.overview(run, "genome_status", ["Complete", "Near-complete", "Partial", "Failed"]), "screens": rollup.overview(run, "h5n1_screen", ["DETECTED", "NOT_DETECTED", "INDETERMINATE", "MISSING"]),
        "attention": report_view(attention(run), title), "review": report_view(run.where("review_required"), title), "samples": report_view(run, title),
        "ha_calls": ranking.order_by_count(run, "ha_call"), "na_calls": ranking.order_by_count(run, "na_call"), "passing_segments": rollup.histogram(run, "pass_segments", 1, 8), "minimum_depths": equal_bins(run.withColumn("_depth", depth_), "_depth"),
    }


def sample_report(summary: DataFrame, wide: DataFrame, counts: DataFrame, key: str = "sample", coverage: DataFrame | None = None, artifacts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of all sample reports: header cards, metadata, the variants of each segment, notes where polishing fell back or failed, and, with coverage and artifacts, the files of each segment."""
    changed = wide.where((F.col("consensus_source") == "IRMA_FALLBACK") | F.col("inference_status").isin("FAILED") | F.col("consensus_status").isin("FAILED"))
    files = {} if coverage is None or artifacts is None else {"files": files_table(coverage, wide, artifacts, [key, "segment"])}
    return files | {"cards": sample_cards(summary, key), "metadata": rollup.metadata_long(summary, key), "variants": variant_table(wide, counts, [key, "segment"]), "notes": changed.select(key, "segment", "consensus_status", "consensus_source", E.first_nonempty(F.col("consensus_reason"), F.col("inference_reason")).alias("reason"))}
