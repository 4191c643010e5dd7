"""Sources and sinks: all samples of a run at once, keyed by what their paths hold; text stays text until cast."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators.reports import flatten_json
from segtally.operators.scans import STRETCH, running
from segtally.sources.tables import by_name, column_names, fields, file_lines, listing, read_table


def path_part(pattern: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def with_keys(df: DataFrame, keys: dict[str, str] | None) -> DataFrame:
    """df with a column for each of keys, name to pattern: the pattern's first group in the path of the file."""
    return df.select(*(path_part(p).alias(n) for n, p in (keys or {}).items()), "*")


def discover_samples(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """sample, path, bytes of folder/pattern, pattern being like ``{sample}.fastq.gz``; of several paths of a sample the first; contents are not read."""
    before, found, after = pattern.partition("{sample}")
    if not found:
        raise ValueError(f"no {{sample}} in {pattern!r}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{before.rpartition('/')[2]}*{after}").load(folder).select("path", F.col("length").alias("bytes"))
    name = F.nullif(F.regexp_extract("path", rf"(?:^|/)\Q{before}\E([^/]+)\Q{after}\E$", 1), F.lit(""))
    return files.withColumn("sample", name).where("sample is not null").groupBy("sample").agg(F.min("path").alias("path"), F.min_by("bytes", "path").alias("bytes"))


def whole_files(spark: SparkSession, paths, keys: dict[str, str], expected: DataFrame | None = None) -> DataFrame:
    """keys (of the path), path, value and state of small files, each read whole: PRESENT, EMPTY (no text), UNREADABLE or MISSING.

    Every file that is listed has its row, whatever reading it gives, and so has every row of
    expected (the keys) without a file; without expected no file is MISSING.
    """
    read = lambda: spark.read.option("ignoreCorruptFiles", "true").text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    files = listing(spark, paths)
    try:
        text = read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        text = spark.createDataFrame([], "path string, value string")
    found = files.join(text, "path", "left")
    state = F.when(F.col("path").isNull(), "MISSING").when((F.col("bytes") == 0) | (E.clean(F.col("value")) == "") & F.col("value").isNotNull(), "EMPTY").when(F.col("value").isNull(), "UNREADABLE").otherwise("PRESENT")
    found = found.select(*(F.regexp_extract("path", p, 1).alias(n) for n, p in keys.items()), "path", "bytes", "value")
    if expected is not None:
        found = expected.select(*keys).distinct().join(found, list(keys), "left")
    return found.select(*keys, "path", "value", state.alias("state"))


def read_flags(spark: SparkSession, paths, keys: str | dict[str, str], expected: DataFrame | None = None) -> DataFrame:
    """keys (``key`` for one pattern) and flag: the word that each file holds, MISSING for empty and absent ones, ERROR for those that cannot be read."""
    found = whole_files(spark, paths, {"key": keys} if isinstance(keys, str) else keys, expected)
    word = F.nullif(F.regexp_replace(F.coalesce("value", F.lit("")), r"\s+", ""), F.lit(""))
    return found.select(*(c for c in found.columns if c not in ("path", "value", "state")), F.when(F.col("state") == "UNREADABLE", "ERROR").otherwise(F.coalesce(word, F.lit("MISSING"))).alias("flag"))


def _one_row(found: DataFrame, sep: str = "\t") -> DataFrame:
    """found with names (of the header) and values (of the first data row) of one-row tables; null where there is no such row."""
    lines = F.filter(F.split(F.regexp_replace("value", "^\ufeff", ""), r"\r\n|\r|\n"), lambda x: E.strip(x) != "")
    return found.withColumn("names", F.when(F.size(lines) > 1, fields(F.get(lines, F.lit(0)), sep))).withColumn("values", F.when(F.size(lines) > 1, fields(F.get(lines, F.lit(1)), sep)))


def fasta_records(lines: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """path, head_no, id, sequence of every record of lines (path, line_no, line); a record begins at a line that starts with ``>``.

    The header that is open where a stretch of lines begins is handed to it, so a file of
    any size is the work of many tasks; only the lines of one record meet.
    """
    text = E.strip(F.col("line"))
    head = text.startswith(">")
    t = running(lines.select("path", "line_no", text.alias("line")).where("line != ''"), ["path"], "line_no", lasts={"head_no": F.when(head, F.col("line_no"))}, stretch=stretch).where("head_no is not null")
    piece = F.when(~head, F.struct("line_no", F.upper(F.regexp_replace("line", r"(?U)\s", "")).alias("piece")))
    r = t.groupBy("path", "head_no").agg(F.max(F.when(head, F.col("line"))).alias("_head"), F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["piece"]), "").alias("sequence"))
    return r.select("path", "head_no", F.split(F.substring("_head", 2, 1 << 30), r"\s", 2)[0].alias("id"), "sequence")


def fasta_states(lines: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """path and error (null: exactly one record, not empty) of every file of lines that holds any text."""
    text = E.strip(F.col("line"))
    head = text.startswith(">")
    t = running(lines.select("path", "line_no", text.alias("line")).where("line != ''"), ["path"], "line_no", earlier={"head_no": F.when(head, F.col("line_no"))}, stretch=stretch)
    early = F.min(F.when(~head & F.col("head_no").isNull(), F.col("line_no"))) + 1
    second = F.min(F.when(head & F.col("head_no").isNotNull(), F.col("line_no"))) + 1
    some = F.count_if(~head)
    error = F.when(early.isNotNull(), F.concat(F.lit("sequence before the header, line "), early.cast("string"))).when(second.isNotNull(), F.concat(F.lit("several records, second header at line "), second.cast("string"))).when(some == 0, "empty sequence")
    return t.groupBy("path").agg(error.alias("error"))


def read_fasta(spark: SparkSession, paths, keys: dict[str, str] | None = None, strict: bool = False, expected: DataFrame | None = None) -> DataFrame:
    """path, keys, id, sequence (upper case, white space out) of every record.

    strict: one row a file, and of each row of expected (the keys), with ``error`` where
    there is no file, no text, no record, several, an empty one, or text before the first.
    """
    named = lambda df, *more: df.select("path", *(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {}).items()), *more)
    if not strict:
        return named(fasta_records(file_lines(spark, paths)), "id", "sequence")
    files = listing(spark, paths)
    try:
        lines = file_lines(spark, paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "path string, line_no long, line string")
    states = fasta_states(lines).withColumn("_read", F.lit(True))
    whole = fasta_records(lines).join(states.where("error is null").select("path"), "path", "left_semi").select("path", "id", "sequence")
    found = named(files.join(states, "path", "left").join(whole, "path", "left"), "id", "sequence", F.when(F.col("_read").isNull(), "missing or empty").otherwise(F.col("error")).alias("error"))
    if expected is None:
        return found
    return expected.select(*keys).distinct().join(found, list(keys), "left").select("path", *keys, "id", "sequence", F.when(F.col("path").isNull(), "missing or empty").otherwise(F.col("error")).alias("error"))


def read_depth(spark: SparkSession, paths, keys: dict[str, str] | None = None, broken: str = "raise") -> DataFrame:
    """keys, contig, pos, depth and, by file, the number of the line; further fields are not read, blank lines left out.

    Fewer than three fields and a depth that is no whole number raise, or with broken
    ``row`` stay as rows with ``error``, so that one bad file does not stop a run.
    """
    lines = file_lines(spark, paths).where("line != ''").withColumn("_f", F.split("line", "\t", -1))
    depth = E.strip(F.get("_f", F.lit(2))).try_cast("int")
    where = F.concat(F.lit(", line "), (F.col("line_no") + 1).cast("string"))
    error = F.when(F.size("_f") < 3, F.concat(F.lit("fewer than three fields"), where)).when(depth.isNull(), F.concat(F.lit("depth is no whole number"), where))
    t = lines.select("path", *(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {}).items()), "line_no", F.get("_f", F.lit(0)).alias("contig"), F.get("_f", F.lit(1)).try_cast("int").alias("pos"), depth.alias("depth"), error.alias("error"))
    own = [*(keys or {}), "line_no", "contig", "pos"]
    if broken == "row":
        return t.select(*own, "depth", "error")
    return t.select(*own, F.when(F.col("error").isNull(), F.col("depth")).otherwise(F.raise_error(F.concat("error", F.lit(" of "), "path")).cast("int")).alias("depth"))


# The twelve columns of tabular hits, in order.
HIT_COLUMNS = {
    "query_id": "string", "subject_accession": "string", "subject_title": "string", "percent_identity": "double", "alignment_length": "int", "query_length": "int",
    "query_start": "int", "query_end": "int", "subject_start": "int", "subject_end": "int", "evalue": "double", "bit_score": "double",
}


def read_hits(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> DataFrame:
    """keys and 12 columns of tabular hits; rows of fewer fields and values that are no numbers raise, further fields are not read."""
    t = with_keys(spark.read.text(paths), keys).where("trim(value) != ''").withColumn("_f", F.split("value", "\t"))
    t = t.withColumn("_f", F.when(F.size("_f") >= 12, F.col("_f")).otherwise(F.raise_error(F.concat(F.lit("fewer than 12 fields: "), "value"))))

    def field(i: int, kind: str) -> Column:
        c = F.col("_f")[i]
        return c if kind == "string" else F.coalesce(E.strip(c).try_cast(kind), F.raise_error(F.concat(F.lit("no number: "), "value")).cast(kind))

    return t.select(*(keys or {}), *(field(i, kind).alias(name) for i, (name, kind) in enumerate(HIT_COLUMNS.items())))


def read_lines(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> DataFrame:
    """Lines without comments and blanks, of lists and variant files."""
    return with_keys(spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "_metadata", E.strip(F.col("value")).alias("line")), keys).drop("_metadata").where("line != '' and not startswith(line, '#')")


def read_annotation_lists(passed: DataFrame, failed: DataFrame, *keys: str) -> DataFrame:
    """keys, seq, status: the first word of each line of the two lists."""
    one = lambda df, status: df.select(*keys, F.split("line", r"\s+")[0].alias("seq"), F.lit(status).alias("status"))
    return one(passed, "PASS").unionByName(one(failed, "FAIL"))


def read_alerts(lines: DataFrame, token: int = 0) -> DataFrame:
    low = F.lower("line")
    return lines.select(*(c for c in lines.columns if c != "line"), F.split("line", r"\s+")[token].alias("seq"), (low.contains("fatal") | low.contains(" fail")).alias("fatal"))


# Where a read report holds each field.
READ_QC_FIELDS = {
    "reads_before": "summary.before_filtering.total_reads", "bases_before": "summary.before_filtering.total_bases", "q20_rate_before": "summary.before_filtering.q20_rate", "q30_rate_before": "summary.before_filtering.q30_rate",
    "reads_after": "summary.after_filtering.total_reads", "bases_after": "summary.after_filtering.total_bases", "q20_rate_after": "summary.after_filtering.q20_rate", "q30_rate_after": "summary.after_filtering.q30_rate",
    "reads_passed": "filtering_result.passed_filter_reads", "reads_low_quality": "filtering_result.low_quality_reads", "reads_too_short": "filtering_result.too_short_reads", "reads_with_adapters": "adapter_cutting.adapter_trimmed_reads",
}


def read_qc_fields(text: Column) -> list[Column]:
    """The twelve fields of a read report, as text; NA where one is not there."""
    return [F.coalesce(F.get_json_object(text, f"$.{path}"), F.lit("NA")).alias(name) for name, path in READ_QC_FIELDS.items()]


def read_read_qc_json(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> DataFrame:
    t = with_keys(spark.read.text(paths, wholetext=True), keys)
    return t.select(*(keys or {}), *read_qc_fields(F.col("value")))


def read_alignments(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Mapped primary alignments (keys, contig, flag, pos, cigar), and the references of the headers (keys, contig, length)."""
    t = with_keys(spark.read.text(paths), keys)
    names = list(keys or {})
    f = F.split("value", "\t")
    rows = t.where("not startswith(value, '@')").select(*names, f[2].alias("contig"), f[1].cast("int").alias("flag"), f[3].cast("int").alias("pos"), f[5].alias("cigar")).where("(flag & 1796) = 0")
    field = lambda tag: F.regexp_extract("value", rf"\t{tag}:([^\t]*)", 1)
    refs = t.where("startswith(value, '@SQ\t')").select(*names, field("SN").alias("contig"), field("LN").cast("long").alias("length")).distinct()
    return rows, refs


def list_artifacts(spark: SparkSession, root: str, sample: str) -> DataFrame:
    """sample, contig, segment, kind, path, bytes of sequences, alignments and coverage tables below root; sample: pattern of the path. Contigs of no known segment are left out; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    low = F.lower(name)
    kind = F.when(low.rlike(r"\.(fasta|fa|fas|fna)$"), "fasta").when(low.endswith(".bam"), "bam").when(low.endswith("-coverage.txt"), "coverage")
    contig = F.when(low.endswith("-coverage.txt"), F.regexp_replace(name, r"(?i)-coverage\.txt$", "")).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))
    found = files.select(F.regexp_extract("path", sample, 1).alias("sample"), contig.alias("contig"), E.segment_of_contig(contig).alias("segment"), kind.alias("kind"), "path", "bytes")
    return found.where("kind is not null and segment is not null")


def read_stage_status(spark: SparkSession, paths, keys: dict[str, str], expected: DataFrame | None = None) -> DataFrame:
    """keys, status, source, reason of the first data row of each status table; files without one give nothing, or, where expected, nulls. keys as those of with_keys, by path."""
    t = _one_row(whole_files(spark, paths, keys, expected))
    get = lambda *cs: F.coalesce(*(by_name(F.col("names"), F.col("values"), c) for c in cs))
    t = t if expected is not None else t.where("values is not null")
    return t.select(*keys, get("status").alias("status"), get("consensus_source", "source").alias("source"), get("reason").alias("reason"))


def read_fastq(spark: SparkSession, paths, keys: dict[str, str] | None = None) -> DataFrame:
    """path, keys, read_no, header, sequence, quality of every record of four lines; a header without ``@`` and a short last record raise.

    Lines are numbered by the blocks in which they are read, so one large plain file is
    read by many tasks, from any store and codec that Spark reads.
    """
    at = F.col("line_no") % 4
    pick = lambda i: F.max(F.when(at == i, F.col("line")))
    r = file_lines(spark, paths).groupBy("path", (F.floor(F.col("line_no") / 4) + 1).alias("read_no")).agg(pick(0).alias("header"), pick(1).alias("sequence"), pick(2).alias("_plus"), pick(3).alias("quality"), F.count("*").alias("_n"))
    broken = F.raise_error(F.concat(F.lit("broken record "), F.col("read_no").cast("string"), F.lit(" of "), "path"))
    header = F.when((F.col("_n") == 4) & F.col("header").startswith("@"), E.strip(F.col("header"))).otherwise(broken)
    return r.select("path", *(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {}).items()), "read_no", header.alias("header"), E.strip(F.col("sequence")).alias("sequence"), E.strip(F.col("quality")).alias("quality"))


def read_manifest_record(spark: SparkSession, paths, keys: dict[str, str], expected: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """keys and the first row of each one-row table, by its own header; nulls for expected keys (and files) without a row. Of several files of a key, the first path.

    Without columns, the names of all headers are taken, in a job of its own.
    """
    t = _one_row(whole_files(spark, paths, keys, expected))
    columns = column_names(t.where("names is not null").select("path", "names")) if columns is None else columns
    t = t.select(*keys, "path", *(by_name(F.col("names"), F.col("values"), c).alias(c) for c in columns))
    return t.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("path"))).where("_r = 1").drop("_r", "path")


def write_table(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    df.select(*columns).write.csv(path, sep=sep, header=True, emptyValue="")


def write_fasta(seqs: DataFrame, path: str, by: str = "sample") -> None:
    """One folder a sample, records in the order of ``ord``; empty sequences are left out."""
    (seqs.where("sequence != ''").repartition(by).sortWithinPartitions(by, "ord").select(by, F.concat(F.lit(">"), "id", F.lit("\n"), "sequence").alias("value")).write.partitionBy(by).text(path))


def write_by_sample(df: DataFrame, path: str, by: tuple[str, ...] = ("sample",)) -> None:
    """Parquet, one folder a sample (and segment); rows of one are written by the tasks that hold them."""
    df.write.partitionBy(*by).parquet(path)


def write_validation_report(counts: DataFrame, issues: DataFrame, path: str) -> None:
    """One text line for each counter (name, value) and each issue (line, level, message), warnings first; errors raise after the report is written."""
    lines = counts.select(F.lit(0).alias("o"), F.lit(0).cast("long").alias("line"), F.concat_ws("\t", "name", F.col("value").cast("string")).alias("value"))
    text = F.concat("level", F.lit("\t"), F.when(F.col("line").isNotNull(), F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(": "))).otherwise(""), "message")
    lines = lines.unionByName(issues.select(F.when(F.col("level") == "WARNING", 1).otherwise(2).alias("o"), F.col("line").cast("long").alias("line"), text.alias("value")))
    lines.orderBy("o", "line", "value").select("value").write.text(path)
    if not issues.where("level = 'ERROR'").isEmpty():
        raise ValueError(f"errors in the metadata, see {path}")


def write_provenance(df: DataFrame, path: str, run: str = "run", document: str = "document") -> None:
    """path/json: a document a run; path/fields: run, field, value, sorted within each run."""
    df.select(document).write.text(f"{path}/json")
    flatten_json(df, run, document).repartition(run).sortWithinPartitions(run, "field").write.csv(f"{path}/fields", sep="\t", header=True, emptyValue="")


def write_run_document(lines: DataFrame, path: str, run: str, parts: int | None = None) -> None:
    """Documents of runs (run, sample, lines), one folder a run; its files, in the order of their names, are the document.

    Rows are dealt by ranges of run and sample, so a large run is written by several tasks.
    """
    by = [run, "sample"]
    dealt = lines.repartitionByRange(parts, *by) if parts else lines.repartitionByRange(*by)
    dealt.sortWithinPartitions(*by).select(run, F.col("lines").alias("value")).write.partitionBy(run).text(path)


def read_run_document_lines(spark: SparkSession, path: str, run: str) -> DataFrame:
    """run and the lines of documents that write_run_document wrote."""
    return spark.read.text(f"{path}/{run}=*").select(F.regexp_extract("_metadata.file_path", rf"/{run}=([^/]*)/", 1).alias(run), "value")
