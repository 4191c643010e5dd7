"""Grids, joins, roll-ups and validation over (sample, segment) tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import reports


#: A closed list of levels has at most so many rows; only such a list is sent to every executor.
MOST_LEVELS = 10_000


def closed_list(levels: DataFrame, most: int = MOST_LEVELS) -> DataFrame:
    """levels for a broadcast; more than ``most`` rows raise, so that no large table is sent by mistake."""
    if levels.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} levels: not a closed list")
    return F.broadcast(levels)


def segment_grid(samples: DataFrame, levels: DataFrame) -> DataFrame:
    """Every sample with every level; levels is the closed list of segments."""
    found = [x[0] if len(x) == 1 else tuple(x) for x in levels.distinct().limit(MOST_LEVELS + 1).collect()]
    if len(found) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} levels: not a closed list")
    name = levels.columns[0]
    if len(levels.columns) > 1:
        return samples.crossJoin(closed_list(levels))
    return samples.withColumn(name, F.explode(F.array(*(F.lit(x).cast(levels.schema[0].dataType) for x in found)))) if found else samples.withColumn(name, F.lit(None).cast(levels.schema[0].dataType)).limit(0)


def coverage_table(grid: DataFrame, keys: list[str], *parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, keys, "left"), parts, grid)


def segment_table(grid: DataFrame, manifest: DataFrame, stats: DataFrame, flags: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each grid row with measures and statuses as text: what QC measured comes before the manifest, that before a default.

    manifest: contig, fasta_length, status, candidate_count, selection_status,
    selection_reason; stats: columns of the same names and measures, any of them absent;
    flags: flag.
    """
    tables = {"s": stats, "m": manifest, "f": flags}
    j = grid
    for short, t in tables.items():
        j = j.join(t.select(*keys, *(F.col(c).cast("string").alias(f"_{short}_{c}") for c in t.columns if c not in keys)), keys, "left")

    def first(*names: str, default: str) -> Column:
        there = [F.col(f"_{n}") for n in names if f"_{n}" in j.columns]
        return E.first_nonempty(*(E.strip(c) for c in there), F.lit(default))

    count = F.coalesce(first("m_candidate_count", "s_candidate_count", default="0").try_cast("int"), F.lit(0))
    status = first("s_status", "f_flag", default="MISSING")
    selection = E.first_nonempty(first("m_selection_status", "s_selection_status", default=""), F.when(count > 1, "MULTIPLE_CANDIDATES").when(count == 1, "UNIQUE").otherwise("MISSING"))
    plain = {"median_depth": "NA", "mean_depth": "NA", "breadth_covered": "NA", "n_count": "0", "n_fraction": "NA", "expected_length_min": "NA", "expected_length_max": "NA", "maximum_n_fraction": "NA"}
    return j.select(
        *grid.columns, first("s_contig", "m_contig", default="NA").alias("contig"), first("s_consensus_length", "m_fasta_length", default="0").alias("length"), first("s_positions", default="0").alias("coverage_positions"),
        *(first(f"s_{c}", default=d).alias(c) for c, d in plain.items()), first("s_coverage_status", "f_flag", default="MISSING").alias("coverage_status"), first("s_length_status", default="NA").alias("length_status"),
        first("s_n_content_status", default="NA").alias("n_content_status"), status.alias("overall_status"), status.alias("coverage_flag"), first("m_status", default="MISSING").alias("assembly_status"),
        count.alias("candidate_count"), selection.alias("selection_status"), first("m_selection_reason", default="").alias("selection_reason"), first("s_qc_reason", default="").alias("qc_reason"))


def pair_artifacts(artifacts: DataFrame) -> DataFrame:
    """sample, contig, and the first path and bytes of each kind."""
    return artifacts.groupBy("sample", "contig").pivot("kind", ["fasta", "bam", "coverage"]).agg(F.min("path").alias("path"), F.min_by("bytes", "path").alias("bytes"))


def qc_gate(df: DataFrame, flags: DataFrame, keys: list[str], flag: str = "flag") -> DataFrame:
    return df.join(flags.where(F.col(flag) == "PASS"), keys, "left_semi")


def summarize_hits(grid: DataFrame, keys: list[str], flag: str, top: DataFrame, has_hit: str, identity: str, coverage: Column, t1: float, t2: float) -> DataFrame:
    j = grid.join(top, keys, "left")
    status = F.when(F.coalesce(F.col(flag), F.lit("")) != "PASS", "SKIPPED_QC").when(F.col(has_hit).isNull(), "NO_HIT").otherwise(E.hit_status(F.col(identity), coverage, t1, t2))
    return j.withColumn("hit_status", status)


def conform_metadata(meta: DataFrame, samples: DataFrame, key: str, columns: list[str]) -> DataFrame:
    known = meta.withColumn("_there", F.lit(1))
    j = samples.join(known, key, "left").withColumn("metadata_status", F.when(F.col("_there").isNull(), "MISSING").otherwise("COMPLETE"))
    return j.select(key, *(F.col(c) if c in j.columns else F.lit("").alias(c) for c in columns), "metadata_status")


def unmatched(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """side and key of what only one of the tables has."""
    only = lambda x, y, side: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").select(F.lit(side).alias("side"), key)
    return only(a, b, "left").unionByName(only(b, a, "right"))


def screen_pair(qc: DataFrame, key: str, kind: str, a: str, b: str, informative: Column, positive: Column) -> DataFrame:
    """DETECTED if both kinds are informative and positive, INDETERMINATE if one is not informative, else NOT_DETECTED."""
    any_ = lambda k, c: F.coalesce(F.max(F.when(F.col(kind) == k, c)), F.lit(False))
    g = qc.groupBy(key).agg(any_(a, informative).alias("a_ok"), any_(b, informative).alias("b_ok"), any_(a, positive & informative).alias("a_pos"), any_(b, positive & informative).alias("b_pos"))
    reason = F.concat_ws(";", F.when(~F.col("a_ok"), F.lit(f"{a} not informative")), F.when(~F.col("b_ok"), F.lit(f"{b} not informative")))
    status = F.when(~(F.col("a_ok") & F.col("b_ok")), "INDETERMINATE").when(F.col("a_pos") & F.col("b_pos"), "DETECTED").otherwise("NOT_DETECTED")
    return g.select(key, status.alias("screen"), reason.alias("reason"))


def stage_wide(status: DataFrame, key: str, stage: str, stages: list[str], value: Column) -> DataFrame:
    """One column a stage; what is absent is NOT_RECORDED."""
    w = status.groupBy(key).pivot(stage, stages).agg(F.max(F.upper(value)))
    return w.select(key, *(F.coalesce(F.col(f"`{s}`"), F.lit("NOT_RECORDED")).alias(s) for s in stages))


def stage_status_wide(grid: DataFrame, status: DataFrame, keys: list[str], stage: str, stages: list[str], values: list[str]) -> DataFrame:
    """Every grid row with a column <stage>_<value> each; blank or absent is NOT_RECORDED, values other than reasons in upper case."""
    w = status.groupBy(*keys).pivot(stage, stages).agg(*(F.max(E.clean(F.col(v))).alias(v) for v in values))
    found = lambda s, v: w.columns[len(keys) + stages.index(s) * len(values) + values.index(v)]
    j = grid.join(w, keys, "left")

    def shown(s: str, v: str) -> Column:
        c = E.first_nonempty(F.col(f"`{found(s, v)}`"))
        return (c if v == "reason" else F.upper(F.when(c == "", "NOT_RECORDED").otherwise(c))).alias(f"{s}_{v}")

    return j.select(*grid.columns, *(shown(s, v) for s in stages for v in values))


def stage_rollup(wide: DataFrame, key: str) -> DataFrame:
    """Six counts a sample from stage_status_wide with the stages inference, consensus (status, source) and variant."""
    i, c, v, source = (F.col(x) for x in ("inference_status", "consensus_status", "variant_status", "consensus_source"))
    any_ = lambda word: (i == word) | (c == word)
    return wide.groupBy(key).agg(
        F.count_if((i != "NOT_RECORDED") | (c != "NOT_RECORDED") | (v != "NOT_RECORDED")).alias("status_records"), F.count_if((c == "SUCCESS") & (source == "MEDAKA")).alias("polished_segments"),
        F.count_if(source == "IRMA_FALLBACK").alias("fallback_segments"), F.count_if(any_("FAILED") | (v == "FAILED")).alias("failed_segments"),
        F.count_if(any_("SKIPPED_QC")).alias("skipped_qc_segments"), F.count_if(v == "FAILED").alias("variant_failed_segments"))


def stage_status(flag: Column, inference: Column, tool_ok: Column, soft: bool = True) -> list[Column]:
    """status, source and reason of polishing. Without soft a failure raises."""
    s = [
        (F.coalesce(flag, F.lit("")) != "PASS", "SKIPPED_QC", "NONE", "segment_qc_failed"), (inference == "SKIPPED_QC", "SKIPPED_QC", "NONE", "inference_skipped_qc"),
        (inference == "FAILED", "FAILED", "IRMA_FALLBACK", "medaka_inference_failed"), ((inference == "SUCCESS") & F.coalesce(tool_ok, F.lit(False)), "SUCCESS", "MEDAKA", "polishing_completed"),
        (inference == "SUCCESS", "FAILED", "IRMA_FALLBACK", "medaka_consensus_failed"),
    ]
    end = ("FAILED", "IRMA_FALLBACK", "invalid_inference_state")
    pick = lambda i: F.coalesce(*(F.when(c, F.lit(v[i])) for c, *v in s), F.lit(end[i]))
    status = pick(0) if soft else F.when(pick(0) == "FAILED", F.raise_error(pick(2))).otherwise(pick(0))
    return [status.alias("status"), pick(1).alias("source"), pick(2).alias("reason")]


def segment_rollup(cov: DataFrame, key: str, segment: str, status: str, count: str | None = None) -> DataFrame:
    names = lambda s: E.first_nonempty(F.array_join(F.array_sort(F.collect_list(F.when(F.col(status) == s, F.col(segment)))), ","), F.lit("NONE"))
    n = lambda s: F.count_if(F.col(status) == s)
    more = [F.count_if(F.col(count) > 1).alias("multiple_candidates"), F.coalesce(F.max(count), F.lit(1)).alias("max_candidates")] if count else []
    return cov.groupBy(key).agg(
        n("PASS").alias("pass_n"), n("FAIL").alias("fail_n"), n("MISSING").alias("missing_n"), F.count_if(F.col(status) != "MISSING").alias("detected"),
        names("PASS").alias("pass_names"), names("FAIL").alias("fail_names"), names("MISSING").alias("missing_names"), *more)


def count_categories(df: DataFrame, column: str, levels: DataFrame) -> DataFrame:
    """n and fraction of each level of a closed list, absent ones 0."""
    c = df.groupBy(column).agg(F.count("*").alias("n"))
    j = levels.join(c, column, "left")
    j = j.withColumn("n", F.coalesce("n", F.lit(0)))
    return j.withColumn("fraction", F.coalesce(F.try_divide("n", F.sum("n").over(Window.partitionBy())), F.lit(0.0)))


def overview(df: DataFrame, status: str, levels: list[str]) -> DataFrame:
    a = df.agg(F.count("*").alias("samples"), *(F.count_if(F.col(status) == x).alias(x) for x in levels))
    return a.select("samples", F.explode(F.map_from_arrays(F.array(*map(F.lit, levels)), F.array(*(F.col(f"`{x}`") for x in levels)))).alias("status", "n")).withColumn("share", F.col("n") / F.greatest("samples", F.lit(1)))


def histogram(df: DataFrame, column: str, width: float, last: int) -> DataFrame:
    """bin and n of bins of one width from 0; empty bins are 0."""
    n = df.groupBy(F.least(F.floor(F.col(column) / width), F.lit(last)).alias("bin")).agg(F.count("*").alias("n"))
    return df.sparkSession.range(last + 1).select(F.col("id").alias("bin")).join(n, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def union_versions(*dfs: DataFrame) -> DataFrame:
    if not dfs:
        raise ValueError("no summaries")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def versioned_column(df: DataFrame, names: list[str], default: Column | None = None) -> Column:
    """The first of the names that df has, as a number with 0 for what is none; default where it has none of them, else an error."""
    found = next((n for n in names if n in df.columns), None)
    if found is None and default is None:
        raise ValueError(f"none of {names}")
    return default if found is None else F.coalesce(F.col(found).try_cast("double"), F.lit(0.0))


def metadata_long(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """key, field (in title case), value of every filled value of the columns; without columns of those that a sample summary holds before ``reads_before``."""
    if columns is None:
        end = df.columns.index("reads_before") if "reads_before" in df.columns else 0
        columns = [c for c in df.columns[:end] if c != key]
    if not columns:
        return df.select(key, F.lit("").alias("field"), F.lit("").alias("value")).where("false")
    u = df.select(key, *(F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in columns)).unpivot(key, [F.col(f"`{c}`") for c in columns], "field", "value")
    return u.where(~F.upper("value").isin("", "NA", "N/A", "NONE", "NAN")).withColumn("field", F.initcap(F.trim(F.replace("field", F.lit("_"), F.lit(" ")))))


def annotation_summary(passed: DataFrame, failed: DataFrame, alerts: DataFrame, key: str) -> DataFrame:
    """PASS, FAIL (which wins) or REVIEW where there are alerts only, with alert counts."""
    s = passed.select(key, F.lit(0).alias("f")).union(failed.select(key, F.lit(1))).groupBy(key).agg(F.max("f").alias("f"))
    a = alerts.groupBy(key).agg(F.count("*").alias("alerts"), F.count_if("fatal").alias("fatal_alerts"))
    status = F.when(F.col("f") == 1, "FAIL").when(F.col("f") == 0, "PASS").otherwise("REVIEW")
    return s.join(a, key, "full").select(key, status.alias("status"), F.coalesce("alerts", F.lit(0)).alias("alerts"), F.coalesce("fatal_alerts", F.lit(0)).alias("fatal_alerts"))


def validation_issues(meta: DataFrame, key: str, checks: list[tuple[str, str, Column]], duplicate: Column | None = None) -> DataFrame:
    """key, level and message of every check that a row fails."""
    found = [F.when(~ok, F.struct(F.lit(level).alias("level"), F.lit(message).alias("message"))) for level, message, ok in checks]
    if duplicate is not None:
        found.append(F.when(duplicate, F.struct(F.lit("ERROR").alias("level"), F.lit("duplicate key").alias("message"))))
    return meta.select(key, F.explode(F.array_compact(F.array(*found))).alias("_i")).select(key, "_i.level", "_i.message")


def _run_sections(samples: DataFrame, run: str, name: str, runs: DataFrame | None) -> DataFrame:
    """run, sample_count, first and last sample, and every section of runs, of each run; a run of runs without a sample raises."""
    n = samples.groupBy(run).agg(F.count("*").alias("_count"), F.min(F.col(name).cast("string")).alias("_first"), F.max(F.col(name).cast("string")).alias("_last"))
    if runs is None:
        return n.withColumn("run_section", F.struct(F.col(run).cast("string").alias("name")))
    missing = F.raise_error(F.concat(F.lit("no sample in run "), F.col(run).cast("string"))).cast("long")
    return runs.join(n, run, "left").withColumn("_count", F.coalesce("_count", missing))


def run_document(samples: DataFrame, run: str, payload: Column, name: str, generated_at: str | None = None) -> DataFrame:
    """One JSON document a run as one row, with a run section and a map of samples; a sample twice raises. For runs of a few thousand samples; run_document_lines has no bound."""
    entry = F.struct(F.col(name).cast("string").alias("key"), payload.alias("value"))
    g = samples.groupBy(run).agg(F.count("*").alias("sample_count"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("samples"))
    made = [F.lit(generated_at).alias("generated_at")] if generated_at else []
    return g.select(run, F.to_json(F.struct(F.lit("run-document").alias("format"), F.lit(1).alias("version"), *made, F.struct(F.col(run).cast("string").alias("name")).alias("run"), "sample_count", "samples")).alias("document"))


def run_document_lines(samples: DataFrame, run: str, payload: Column, name: str, runs: DataFrame | None = None, generated_at: str | None = None) -> DataFrame:
    """run, sample and the lines of its part of the run's JSON document, which is that of run_document but that each sample has a line of its own.

    runs: run, ``run_section`` (a struct) and, if it has one, ``provenance`` (a struct);
    its runs must have samples. The first sample of a run also carries the line that opens
    the document, the last what closes it, so no row holds more than one sample. A sample
    that stands twice in a run raises.
    """
    sections = _run_sections(samples, run, name, runs)
    head = [F.lit("run-document").alias("format"), F.lit(1).alias("version"), *([F.lit(generated_at).alias("generated_at")] if generated_at else []), F.col("run_section").alias("run")]
    head += ["provenance"] if "provenance" in sections.columns else []
    opening = F.to_json(F.struct(*head, F.col("_count").alias("sample_count")), {"ignoreNullFields": "false"})
    opening = F.concat(F.substring(opening, F.lit(1), F.length(opening) - 1), F.lit(',"samples":{\n'))
    twice = F.raise_error(F.concat(F.lit("sample twice: "), F.col("sample"))).cast("long")
    own = samples.select(run, F.col(name).cast("string").alias("sample"), payload.alias("payload")).groupBy(run, "sample").agg(F.count("*").alias("_n"), F.first("payload").alias("payload"))
    own = own.withColumn("_n", F.when(F.col("_n") > 1, twice).otherwise(F.col("_n")))
    j = own.join(sections, run, "right" if runs is not None else "inner")
    entry = F.to_json(F.create_map("sample", "payload"))
    entry = F.substring(entry, F.lit(2), F.length(entry) - 2)
    line = F.concat(F.when(F.col("sample") == F.col("_first"), opening).otherwise(""), entry, F.when(F.col("sample") == F.col("_last"), "\n}}").otherwise(","))
    return j.where("_n = 1 and _count > 0").select(run, "sample", line.alias("lines"))


def document_samples(lines: DataFrame, run: str, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """run, sample, payload of documents that come as the lines of run_document_lines, and the runs (run, reason) whose documents are of another format or have no run section or sample."""
    text = F.col(line)
    head, item = text.startswith("{"), text.startswith('"')
    d = F.from_json(F.concat(F.regexp_replace(text, r',"samples":\{$', ""), F.lit("}")), "format string, run map<string,string>")
    heads = lines.groupBy(run).agg(F.max(F.when(head, F.struct(F.coalesce(d["format"] == "run-document", F.lit(False)).alias("known"), d["run"].isNotNull().alias("has_run")))).alias("_d"), F.count_if(item).alias("_n"))
    reason = F.when(~F.coalesce(F.col("_d.known"), F.lit(False)), "format").when(~F.col("_d.has_run"), "no run section").when(F.col("_n") == 0, "no sample")
    heads = heads.select(run, reason.alias("reason"))
    entry = F.from_json(F.concat(F.lit("{"), F.regexp_replace(text, r",$", ""), F.lit("}")), "map<string,string>")
    rows = lines.where(item).select(run, F.explode(entry).alias("_s", "payload")).join(heads.where("reason is null").select(run), run, "left_semi")
    return rows.select(run, reports.sample_key(F.col("_s")).alias("sample"), "payload"), heads.where("reason is not null")
