"""Tool reports as tables, run documents, checksums and the tables of sample reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segtally.functions import expr as E

# Length bounds of tables that carry none.
DEFAULT_BOUNDS = {
    "PB2": (2200, 2400), "PB1": (2200, 2400), "PA": (2100, 2300), "HA": (1600, 1800),
    "NP": (1450, 1600), "NA": (1300, 1500), "MP": (950, 1050), "NS": (800, 950),
}


def annotation_info(lines: DataFrame) -> DataFrame:
    """path, version, completed of logs given as path, line."""
    version = F.nullif(F.regexp_extract("line", r"# VADR\s+(\S+)", 1), F.lit(""))
    return lines.groupBy("path").agg(F.max(version).alias("version"), F.coalesce(F.bool_or(F.col("line").rlike(r"^\[ok\]\s*$")), F.lit(False)).alias("completed"))


def _number(c: Column) -> Column:
    """c as a whole number if it consists of digits alone."""
    return F.when(F.translate(c, "0123456789", "") == "", F.nullif(c, F.lit("")).try_cast("long"))


def _cells(lines: DataFrame) -> DataFrame:
    """lines with ``_c``: the words of a table row that begins with its number; other lines are left out."""
    cells = F.filter(F.split(F.translate("line", "\t\r", "  "), " "), lambda x: x != "")
    return lines.withColumn("_c", cells).where(_number(F.try_element_at("_c", F.lit(1))).isNotNull())


def annotation_models(lines: DataFrame) -> DataFrame:
    """path, segment, model, subgroup, status, nseq, npass, nfail of the model table: rows of seven words that end in three numbers."""
    cell = lambda i: F.try_element_at("_c", F.lit(i))
    n = {c: _number(cell(i)) for i, c in ((5, "nseq"), (6, "npass"), (7, "nfail"))}
    rows = _cells(lines).where((F.size("_c") == 7) & cell(3).startswith("fluA-seg")).withColumns(n).where("nseq is not null and npass is not null and nfail is not null")
    return rows.select("path", E.segment_of_group(cell(3)).alias("segment"), cell(2).alias("model"), F.nullif(cell(4), F.lit("-")).alias("subgroup"), F.when(F.col("nfail") == 0, "PASS").otherwise("REVIEW").alias("status"), *n)


def annotation_alerts(lines: DataFrame) -> DataFrame:
    """path, alert, effect, failure_causing, cases, sequences of the alert table: rows whose third word says whether the alert is fatal, with two numbers before the description."""
    cell = lambda i: F.try_element_at("_c", F.lit(i))
    rows = _cells(lines).where((F.size("_c") >= 8) & cell(3).isin("yes", "yes*", "no")).withColumns({"cases": _number(cell(6)), "sequences": _number(cell(7))}).where("cases is not null and sequences is not null")
    return rows.select("path", cell(2).alias("alert"), F.initcap(F.replace(cell(4), F.lit("_"), F.lit(" "))).alias("effect"), (cell(3) != "no").alias("failure_causing"), "cases", "sequences")


def annotation_totals(models: DataFrame) -> DataFrame:
    return models.groupBy("path").agg(F.sum("nseq").alias("sequences"), F.sum("npass").alias("passed"), F.sum("nfail").alias("failed"))


def _after(text: Column, label: str) -> Column:
    """What follows the label, whatever the case of its letters; null without it. It holds the text once, so nested calls stay as long as their number."""
    return F.get(F.split(text, rf"(?i)\Q{label}\E", 2), F.lit(1))


def parse_genotype_report(text: Column) -> list[Column]:
    """status, reason, threshold, matched_segments, input_segments, calls (map of segment to call) of a report; a two-line report of the gate has a status alone.

    The report is searched for its labels, with runs of blanks as one: the call stands up
    to a colon behind the arrow, its reason behind the colon or, if nothing is there, on
    the next line.
    """
    text = F.coalesce(text, F.lit(""))
    # each step holds the one before it once: an expression that held it twice would double with every step
    found = lambda c, pattern: F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.lit(0))
    filled = lambda c: found(c, r"(?sU)^\s*(\S(?:.*\S)?)\s*\z")
    plain = F.regexp_replace(text, r"[ \t\r]+", " ")
    plain = F.trim(F.replace(F.replace(plain, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
    # the second value of the second line, lines without text not counted
    gate = filled(found(text, r"(?U)^(?:\s*\n)?sample\tstatus[^\n]*\n(?:\s*\n)?[^\n\t]*\t([^\t\n]*)"))
    screened = gate.isin("H5N1_NOT_DETECTED", "H5N1_INDETERMINATE")
    called = _after(plain, "consensus genotype --> ")
    call = filled(found(called, r"^([^:\n]*+):"))
    status = F.when(~text.rlike(r"(?U)\S"), "Not available").when(screened, "Not run").otherwise(gate)
    reason = F.when(screened, F.concat(F.lit("not run: the screen was "), F.replace(gate, F.lit("H5N1_"), F.lit("")))).when(gate.isNotNull(), "gated by the screen")
    said = E.strip(found(called, r"(?U)^[^:\n]*?[^:\s][^:\n]*+:\s*(\S[^\n]*)"))
    flat = F.replace(plain, F.lit("\n"), F.lit(" "))
    number = lambda c, before="": found(c, rf"(?isU)^{before}\s*([0-9]+)(?: |\s*\z)").try_cast("long").cast("int")
    only = F.regexp_extract(flat, r"(?is)^(.*?)match found of total", 1)
    listed = F.regexp_extract(flat, r"(?is)segments in input file:(.*?)at percent identity", 1)
    pair = lambda x: F.struct(F.upper(E.strip(F.substring_index(x, ":", 1))).alias("key"), E.strip(_after(x, ":")).alias("value"))
    items = F.filter(F.transform(F.filter(F.split(F.coalesce(listed, F.lit("")), ","), lambda x: F.instr(x, ":") > 0), pair), lambda x: (x["key"] != "") & (x["value"] != ""))
    calls = F.aggregate(items, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["key"]), F.map_from_entries(F.array(x))))
    return [
        F.coalesce(status, call, F.lit("Not available")).alias("status"), F.coalesce(reason, said).alias("reason"),
        F.substring_index(F.substring_index(E.strip(_after(plain, "pident_threshold:")), "\n", 1), " ", 1).try_cast("double").alias("threshold"),
        number(only, "(?>(?:.*only )?)").alias("matched_segments"), number(_after(flat, "match found of total")).alias("input_segments"), calls.alias("calls"),
    ]


def split_list(c: Column) -> Column:
    """The items of a text that are cut by commas and semicolons, without blanks."""
    return F.filter(F.transform(F.split(F.translate(F.coalesce(c, F.lit("")), ";", ","), ","), E.strip), lambda x: x != "")


def flatten_json(df: DataFrame, key: str, column: str, depth: int = 4) -> DataFrame:
    """key, field (dotted), value of every leaf of a JSON text; lists are leaves, objects below ``depth`` too."""
    spark = df.sparkSession
    level = df.select(F.col(key).alias("_k"), F.lit("").alias("_f"), F.parse_json(column).alias("_v"))
    out = None
    for left in range(depth, -1, -1):
        is_object = F.schema_of_variant("_v").startswith("OBJECT<")
        leaves = (level.where(~is_object) if left else level).select(F.col("_k").alias(key), F.col("_f").alias("field"), F.col("_v").cast("string").alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        if left:
            inner = level.where(is_object).lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
            level = inner.select("_k", F.concat_ws(".", F.nullif(F.col("_f"), F.lit("")), F.col("key")).alias("_f"), F.col("value").alias("_v"))
    return out.where("field != ''")


def read_run_documents(docs: DataFrame, run: str, column: str = "document") -> tuple[DataFrame, DataFrame]:
    """Rows run, sample, payload of documents, and the documents that are of another format, have no run section or hold no sample."""
    d = F.from_json(column, "format string, version int, sample_count long, run map<string,string>, samples map<string,string>")
    parsed = docs.withColumn("_d", d)
    good = F.coalesce((F.col("_d.format") == "run-document") & F.col("_d.run").isNotNull() & (F.size("_d.samples") > 0), F.lit(False))
    rows = parsed.where(good).select(run, F.explode("_d.samples").alias("_s", "payload")).select(run, sample_key(F.col("_s")).alias("sample"), "payload")
    return rows, parsed.where(~good).drop("_d")


def sample_key(c: Column) -> Column:
    """A sample's name from a link to its report: no query, fragment, folders or suffix."""
    return F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"^.*/|\.html?$", "")


def checksums(files: DataFrame, key: str, content: str, expected: DataFrame) -> DataFrame:
    """key, sha256, checksum_status of every expected file: MATCH, MISMATCH or MISSING. expected: key, expected."""
    have = files.select(key, F.sha2(content, 256).alias("sha256"))
    status = F.when(F.col("sha256").isNull(), "MISSING").when(F.col("sha256") == F.lower("expected"), "MATCH").otherwise("MISMATCH")
    return expected.join(have, key, "left").select(key, "sha256", status.alias("checksum_status"))


# What a log of a run that failed inside says, whatever its exit code.
FATAL_PATTERNS = {
    "process killed": r"(?im)^.*\bKilled\b.*$",
    "no QC-passing data": r"(?i)found no QC[’']?d data",
    "out of memory": r"(?i)(out of memory|oom-kill|oom killed|cannot allocate memory)",
    "segmentation fault": r"(?i)segmentation fault",
}


def scan_logs(lines: DataFrame, keys: list[str], line: str = "line", patterns: dict[str, str] = FATAL_PATTERNS) -> DataFrame:
    """keys, labels (in the order of the patterns, joined by commas) and n_lines of the logs in which any pattern is found.

    A pattern is looked for line by line, so a log is never one row; each task hands on
    one row a key and pattern.
    """
    found = F.array_compact(F.array(*(F.when(F.col(line).rlike(p), F.struct(F.lit(i).alias("at"), F.lit(label).alias("label"))) for i, (label, p) in enumerate(patterns.items()))))
    each = lines.select(*keys, F.explode(found).alias("_f")).groupBy(*keys, "_f").agg(F.count("*").alias("n"))
    labels = F.transform(F.array_sort(F.collect_list("_f")), lambda x: x["label"])
    return each.groupBy(*keys).agg(F.array_join(labels, ", ").alias("labels"), F.sum("n").alias("n_lines"))


def pick_column(columns: list[str], names: list[str]) -> str | None:
    """The column whose normalised name comes first in names."""
    plain = {"_".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in c.lower()).split()): c for c in reversed(columns)}
    return next((plain[n] for n in names if n in plain), None)


def coverage_median(report: DataFrame, keys: list[str]) -> DataFrame:
    """Median of the depth column of coverage reports read as text; blank, NA and other words are left out."""
    found = pick_column([c for c in report.columns if c not in keys], ["coverage_depth", "depth", "read_depth", "readdepth"])
    value = F.when(~F.isnan(F.col(f"`{found}`").try_cast("double")), F.col(f"`{found}`").try_cast("double")) if found else F.lit(None).cast("double")
    return report.groupBy(*keys).agg(F.median(value).alias("coverage_median"))


def backfill_qc(df: DataFrame, max_n: float, bounds: dict[str, tuple[int, int]] = DEFAULT_BOUNDS) -> DataFrame:
    """Statuses that an old table lacks or has blank. df: segment, length, n_fraction, coverage_status; other columns as they are there."""
    for c in ("expected_length_min", "expected_length_max", "maximum_n_fraction", "length_status", "n_content_status", "overall_status"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None))
    table = F.create_map(*(F.lit(x) for s, (lo, hi) in bounds.items() for x in (s, f"{lo},{hi}")))
    limit = lambda i: F.split_part(table[F.col("segment")], F.lit(","), F.lit(i)).cast("double")
    df = df.withColumns({
        "expected_length_min": F.coalesce(F.col("expected_length_min").try_cast("double"), limit(1)), "expected_length_max": F.coalesce(F.col("expected_length_max").try_cast("double"), limit(2)),
        "maximum_n_fraction": F.coalesce(F.col("maximum_n_fraction").try_cast("double"), F.lit(max_n)), "coverage_status": F.upper(F.coalesce("coverage_status", F.lit("MISSING"))),
    })
    given = lambda c: F.when(~F.upper(E.clean(F.col(c).cast("string"))).isin("", "NA", "NAN", "NONE"), F.upper(F.col(c).cast("string")))
    judge = lambda ok: F.when(ok.isNull(), "REVIEW").when(ok, "PASS").otherwise("FAIL")
    length = F.coalesce(F.col("length"), F.lit(0)).between(F.col("expected_length_min"), F.col("expected_length_max"))
    bounded = F.col("expected_length_min").isNotNull() & F.col("expected_length_max").isNotNull()
    df = df.withColumn("length_status", F.coalesce(given("length_status"), judge(F.when(bounded, length))))
    df = df.withColumn("n_content_status", F.coalesce(given("n_content_status"), judge(F.col("n_fraction") <= F.col("maximum_n_fraction"))))
    parts = F.array("coverage_status", "length_status", "n_content_status")
    overall = F.when(F.forall(parts, lambda s: s == "PASS"), "PASS").when(F.exists(parts, lambda s: s.isin("MISSING", "ERROR", "REVIEW")), "REVIEW").otherwise("FAIL")
    return df.withColumn("overall_status", F.coalesce(given("overall_status"), overall))


def derive_review(df: DataFrame) -> DataFrame:
    """review_required and review_reason from review_flags (where there is one), pass_segments and genome_status; columns that are there win."""
    flags = E.clean(F.col("review_flags")) if "review_flags" in df.columns else F.lit("")
    flags = F.when(~F.upper(flags).isin("NONE", "NA", "N/A", "CLEAR", "OK", ""), flags)
    if "review_required" in df.columns:
        df = df.withColumn("review_required", F.lower(E.clean(F.col("review_required").cast("string"))).isin("true", "t", "1", "yes", "y"))
    else:
        df = df.withColumn("review_required", flags.isNotNull() | F.coalesce(F.col("pass_segments") < 8, F.lit(False)))
    if "review_reason" in df.columns:
        return df
    return df.withColumn("review_reason", F.when(F.col("review_required"), F.coalesce(F.replace(flags, F.lit(";"), F.lit("; ")), F.concat(F.lit("Genome status: "), "genome_status"))))


def merge_reason(df: DataFrame, failed: str = "medaka_failed_segments", fallback: str = "irma_fallback_segments") -> DataFrame:
    """Failed or replaced polishing asks for review and adds its counts to the reason."""
    changed = (F.col(failed) > 0) | (F.col(fallback) > 0)
    text = F.concat(F.lit("Medaka: "), F.col(failed), F.lit(" failed segment(s); "), F.col(fallback), F.lit(" IRMA fallback segment(s)"))
    reason = F.when(changed, F.concat_ws("; ", F.nullif(F.trim("review_reason"), F.lit("")), text)).otherwise(F.col("review_reason"))
    return df.withColumn("review_reason", reason).withColumn("review_required", F.col("review_required") | changed)


def metric_table(df: DataFrame, key: str, metrics: dict[str, Column]) -> DataFrame:
    """key, metric, value: a row for each named metric of a wide row, as text."""
    return df.select(key, *(c.cast("string").alias(n) for n, c in metrics.items())).unpivot(key, list(metrics), "metric", "value")
