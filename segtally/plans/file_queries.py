"""Registered queries over what files hold: the given tables are written as lines of many files and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import depth, ranking, reads, reports, rollup, samples, scans
from segtally.plans.queries import QUERIES, SQL, query
from segtally.sources import files, tables


def tsv(*cells: Column) -> Column:
    return F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit("")) for c in cells))


def with_header(rows: DataFrame, header: Column) -> DataFrame:
    """rows (path, line_no, line) with a line 0 in each path; header is a text over path."""
    return rows.unionByName(rows.select("path").distinct().select("path", F.lit(0).cast("long").alias("line_no"), header.alias("line")))


@query("""SELECT l_suppkey % 3 AS grp, l_orderkey * 10 + l_linenumber AS "at", sum(n) OVER w AS total, last_value(CASE WHEN big THEN n END IGNORE NULLS) OVER w AS last_big,
 last_value(CASE WHEN big THEN n END IGNORE NULLS) OVER (PARTITION BY l_suppkey % 3 ORDER BY l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier_big FROM
 (SELECT l_suppkey % 3 AS l_suppkey, l_orderkey, l_linenumber, count(*) AS n, count(*) > 1 AS big FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY l_suppkey % 3 ORDER BY l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING)""")
def running_values(t):
    li = t("lineitem").groupBy((F.col("l_suppkey") % 3).alias("grp"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at")).agg(F.count("*").alias("n"))
    big = F.when(F.col("n") > 1, F.col("n"))
    return scans.running(li, ["grp"], "at", {"total": F.col("n")}, {"last_big": big}, {"earlier_big": big}, stretch=4096).drop("n")


@query("""SELECT 'f' || o_custkey % 40 AS path, o_orderkey + 1 AS line_no, o_orderkey::VARCHAR AS key, CASE WHEN o_custkey % 40 % 3 <> 1 THEN o_orderstatus END AS status,
 CASE WHEN o_orderkey % 11 = 0 AND o_custkey % 40 % 3 <> 1 THEN '' ELSE round(o_totalprice)::BIGINT::VARCHAR END AS total, CASE WHEN o_custkey % 40 % 3 = 1 THEN o_orderpriority END AS more FROM orders""")
def tables_by_header(t):
    n, total = F.col("o_custkey") % 40, F.round("o_totalprice").cast("long")
    key, some = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 11 != 0, total)
    short = F.when(some.isNull(), tsv(key, F.col("o_orderstatus"))).otherwise(tsv(key, F.col("o_orderstatus"), some))
    line = F.when(n % 3 == 0, short).when(n % 3 == 1, tsv(total, key, F.col("o_orderpriority"))).otherwise(tsv(F.concat(F.lit(" "), "o_orderstatus"), key, F.lit("wrong"), some))
    rows = t("orders").select(F.concat(F.lit("f"), n.cast("string")).alias("path"), (key + 1).alias("line_no"), line.alias("line"))
    of = F.substring("path", 2, 9).cast("int") % 3
    lines = with_header(rows, F.when(of == 0, "key\tstatus\ttotal").when(of == 1, "﻿total\tkey\tmore").otherwise("status \tkey\ttotal\ttotal"))
    return tables.table_rows(lines, ["key", "status", "total", "more"])


@query("""SELECT 'f' || c_nationkey % 5 AS path, 3 * c_custkey + 3 AS line_no, c_custkey::VARCHAR AS key, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || chr(10) || 'said "' || c_mktsegment || '"' || chr(9) || c_nationkey || CASE WHEN c_custkey % 3 = 1 THEN chr(10) || 'twice' ELSE '' END END AS note,
 c_mktsegment AS "last" FROM customer""")
def quoted_records(t):
    k = F.col("c_custkey")
    note = F.concat(F.col("c_name"), F.lit('\nsaid "'), "c_mktsegment", F.lit('"\t'), F.col("c_nationkey").cast("string"), F.when(k % 3 == 1, "\ntwice").otherwise(""))
    value = F.when(k % 3 == 0, F.col("c_name")).otherwise(F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"')))
    rows = t("customer").select(F.concat(F.lit("f"), (F.col("c_nationkey") % 5).cast("string")).alias("path"), k.alias("k"), F.posexplode(F.split(tsv(k, value, F.col("c_mktsegment")), "\n")).alias("i", "line"))
    lines = with_header(rows.select("path", (3 * F.col("k") + 3 + F.col("i")).cast("long").alias("line_no"), "line"), F.lit("key\tnote\tlast"))
    return tables.table_rows(lines, ["key", "note", "last"], stretch=256)


META = """m AS (SELECT o_orderkey + 2 AS line, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE o_custkey::VARCHAR END AS k, CASE WHEN o_orderkey % 7 = 0 THEN '2026-02-30' WHEN o_orderkey % 13 = 0 THEN '' ELSE '2026-02-28' END AS day, floor(o_totalprice / 2500)::BIGINT::VARCHAR AS lat,
 CASE WHEN o_orderkey % 9 = 0 THEN 'Barcode7' WHEN o_orderkey % 17 = 0 THEN 'b7' ELSE '' END AS barcode FROM orders), s AS (SELECT c_custkey::VARCHAR AS k FROM customer WHERE c_mktsegment <> 'BUILDING'),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line) AS n, row_number() OVER (PARTITION BY k ORDER BY line DESC) AS back FROM m WHERE k <> ''),
i AS (SELECT line, 'ERROR' AS level, 'sample_id is empty' AS message FROM m WHERE k = '' UNION ALL SELECT line, 'ERROR', 'sample_id stands here again: ' || k FROM r WHERE n > 1
 UNION ALL SELECT line, 'WARNING', 'no sample has this sample_id: ' || k FROM r WHERE k NOT IN (FROM s) UNION ALL SELECT line, 'ERROR', 'day is no date of the form YYYY-MM-DD: ' || day FROM r WHERE day = '2026-02-30'
 UNION ALL SELECT line, 'ERROR', 'lat is no number from -90 to 90: ' || lat FROM r WHERE lat::BIGINT > 90 UNION ALL SELECT line, 'WARNING', 'barcode is not of the form barcode01: b7' FROM r WHERE barcode = 'b7'
 UNION ALL SELECT NULL, 'WARNING', 'sample without metadata: ' || k FROM s WHERE k NOT IN (SELECT k FROM r))"""


def _metadata(t):
    key = F.col("o_orderkey")
    cell = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = tsv(F.when(key % 50 != 0, F.col("o_custkey")), F.when(key % 7 == 0, cell(F.lit("2026-02-30"))).when(key % 13 == 0, "").otherwise("2026-02-28"), F.floor(F.col("o_totalprice") / 2500), F.when(key % 9 == 0, "Barcode7").when(key % 17 == 0, " b7").otherwise(""))
    lines = with_header(t("orders").select(F.lit("metadata").alias("path"), (key + 1).alias("line_no"), line.alias("line")), F.lit("sample_id\tday\tlat\tbarcode"))
    meta = scans.ordinals(tables.table_rows(lines, ["sample_id", "day", "lat", "barcode"]), ["path"], "line_no", "line").withColumn("line", F.col("line") + 1)
    return meta, t("customer").where("c_mktsegment != 'BUILDING'").select(F.col("c_custkey").cast("string").alias("sample_id"))


CHECKS = {"dates": ("day",), "coordinates": {"lat": (-90, 90)}, "barcode": "barcode"}


@query(f"WITH {META} SELECT line - (SELECT min(line) FROM m) + 2 AS line, level, message FROM (SELECT line, level, message FROM i WHERE line IS NOT NULL) UNION ALL SELECT NULL, level, message FROM i WHERE line IS NULL")
def metadata_issues(t):
    meta, expected = _metadata(t)
    return samples.metadata_issues(meta, expected, **CHECKS)


@query(f"""WITH {META} SELECT 'expected' AS name, count(*) AS value FROM s UNION ALL SELECT 'rows', count(*) FROM m UNION ALL SELECT 'matched', count(*) FROM s WHERE k IN (SELECT k FROM r) UNION ALL SELECT 'missing', count(*) FROM s WHERE k NOT IN (SELECT k FROM r)
 UNION ALL SELECT 'warnings', count(*) FILTER (line IS NOT NULL) + max((line IS NULL)::INT) FROM i WHERE level = 'WARNING' UNION ALL SELECT 'errors', count(*) FROM i WHERE level = 'ERROR'""")
def metadata_counters(t):
    meta, expected = _metadata(t)
    return samples.validate_metadata(meta, expected, ["day"], **CHECKS)[2]


@query(f"WITH {META} SELECT k AS sample_id, day, lat, CASE WHEN r.line IS NULL THEN 'MISSING' ELSE 'COMPLETE' END AS metadata_status FROM s LEFT JOIN (SELECT * FROM r WHERE back = 1) r USING (k)")
def metadata_conformed(t):
    meta, expected = _metadata(t)
    return samples.validate_metadata(meta, expected, ["day", "lat"], **CHECKS)[0]


@query(r"""SELECT p_brand AS path, 5 * p_partkey AS head_no, 'p' || p_partkey AS id, upper(regexp_replace(CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name || CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE '' END END, '\s', '', 'g')) AS sequence FROM part""")
def fasta_records(t):
    k = F.col("p_partkey").cast("long")
    parts = F.array(F.concat(F.lit(" >p"), k.cast("string"), F.lit(" of > "), "p_type"), F.when(k % 7 != 0, F.col("p_name")).otherwise(""), F.lit("\t"), F.when((k % 7 != 0) & (k % 2 == 0), F.col("p_type")).otherwise(""))
    lines = t("part").select(F.col("p_brand").alias("path"), k.alias("k"), F.posexplode(parts).alias("i", "line"))
    return files.fasta_records(lines.select("path", (5 * F.col("k") + F.col("i")).cast("long").alias("line_no"), "line"), stretch=1024)


@query("""SELECT 'c' || c_custkey AS path, CASE c_custkey % 5 WHEN 1 THEN 'several records, second header at line 4' WHEN 2 THEN 'sequence before the header, line 2' WHEN 3 THEN 'empty sequence' END AS error FROM customer""")
def fasta_states(t):
    kinds = [[">a", "", "AC", "GT"], [">a", "AC", "", ">b"], ["", "AC", ">a", ">b"], [">a", " "], [">a b", "AC"]]
    kind = F.element_at(F.array(*(F.array(*map(F.lit, x)) for x in kinds)), (F.col("c_custkey") % 5 + 1).cast("int"))
    lines = t("customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("path"), F.posexplode(kind).alias("line_no", "line"))
    return files.fasta_states(lines.withColumn("line_no", F.col("line_no").cast("long")))


@query("SELECT 'r' || o_custkey % 97 AS path, round(o_totalprice / 1000, 1) AS depth FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 97 % 3 <> 2")
def depth_by_header(t):
    n = F.col("o_custkey") % 97
    value = F.when(F.col("o_orderstatus") == "P", F.element_at(F.array(F.lit("NA"), F.lit(""), F.lit("nan")), (F.col("o_orderkey") % 3 + 1).cast("int"))).otherwise(F.round(F.col("o_totalprice") / 1000, 1).cast("string"))
    rows = t("orders").select(F.concat(F.lit("r"), n.cast("string")).alias("path"), (F.col("o_orderkey") + 1).alias("line_no"), F.when(n % 3 == 0, tsv(F.col("o_orderkey"), value)).when(n % 3 == 1, tsv(value, F.lit(7), F.col("o_orderkey"))).otherwise(tsv(value, value)).alias("line"))
    of = F.substring("path", 2, 9).cast("int") % 3
    return tables.depth_values(with_header(rows, F.when(of == 0, "Position\tCoverage Depth").when(of == 1, "READ-depth\tReadDepth\tPosition").otherwise("a\tb")))


@query("""WITH f AS (SELECT l_suppkey, l_returnflag AS c, min({'o': l_orderkey, 'n': l_linenumber}) AS p FROM lineitem GROUP BY ALL), d AS (SELECT l_suppkey, median(l_quantity) AS median_depth, count(*) AS positions FROM lineitem GROUP BY 1)
SELECT l_suppkey, positions, median_depth, string_agg(c, ',' ORDER BY p, c) AS contigs FROM f JOIN d USING (l_suppkey) GROUP BY ALL""")
def depth_contigs(t):
    return depth.depth_stats(t("lineitem"), ["l_suppkey"], "l_quantity", 25, "l_returnflag", F.struct("l_orderkey", "l_linenumber")).select("l_suppkey", "positions", "median_depth", "contigs")


CUSTOMER_RUNS = """c AS (SELECT 'run' || c_nationkey AS run, c_custkey::VARCHAR AS sample, '{"n":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' AS payload FROM customer),
n AS (SELECT run, count(*) AS n, min(sample) AS first_, max(sample) AS last_ FROM c GROUP BY 1)"""


def _runs(t):
    c = t("customer").select(F.concat(F.lit("run"), F.col("c_nationkey").cast("string")).alias("run"), F.col("c_custkey").alias("sample"), F.col("c_custkey").alias("n"), F.col("c_mktsegment").alias("segment"))
    runs = c.select("run").distinct().select("run", F.struct(F.col("run").alias("title"), F.lit(2).alias("rules")).alias("run_section"), F.struct(F.lit(None).cast("string").alias("database")).alias("provenance"))
    return rollup.run_document_lines(c, "run", F.struct("n", "segment"), "sample", runs, "2026-01-01T00:00:00Z")


@query(f"""WITH {CUSTOMER_RUNS} SELECT run, sample, CASE WHEN sample = first_ THEN '{{"format":"run-document","version":1,"generated_at":"2026-01-01T00:00:00Z","run":{{"title":"' || run || '","rules":2}},"provenance":{{"database":null}},"sample_count":' || n || ',"samples":{{' || chr(10) ELSE '' END
 || '"' || sample || '":' || payload || CASE WHEN sample = last_ THEN chr(10) || '}}}}' ELSE ',' END AS lines FROM c JOIN n USING (run)""")
def run_document_lines(t):
    return _runs(t)


@query(f"""WITH {CUSTOMER_RUNS} SELECT run, sample, payload FROM c""")
def document_samples(t):
    lines = _runs(t).select("run", F.explode(F.split("lines", "\n")).alias("value"))
    return rollup.document_samples(lines, "run")[0]


@query("""WITH a AS (SELECT DISTINCT left(text, 5) AS a FROM documents WHERE length(text) >= 5), c AS (SELECT *, length(text) AS n, least(length(text), 30) AS w FROM conversations),
p AS (SELECT conv_id, turn, text, n, w, unnest(range(1, greatest(w - 4, 0) + 1)) AS i FROM c),
h AS (SELECT conv_id, turn, max(i) + 4 AS first_ FROM p WHERE substr(text, i, 5) IN (FROM a) GROUP BY ALL), l AS (SELECT conv_id, turn, min(n - w + i) - 1 AS last_ FROM p WHERE substr(text, n - w + i, 5) IN (FROM a) GROUP BY ALL),
j AS (SELECT conv_id, turn, text, n, coalesce(first_, 0) AS f, coalesce(last_, n) AS l FROM c LEFT JOIN h USING (conv_id, turn) LEFT JOIN l USING (conv_id, turn)),
k AS (SELECT *, CASE WHEN l > f THEN l WHEN f > 0 THEN n ELSE l END AS e FROM j) SELECT conv_id, turn, substr(text, f + 1, greatest(e - f, 0)) AS text, f > 0 OR e < n AS trimmed FROM k""")
def trim_ends(t):
    adapters = t("documents").where(F.length("text") >= 5).select(F.substring("text", 1, 5).alias("adapter")).distinct()
    return reads.trim_ends(t("conversations").select("conv_id", "turn", "text"), "text", adapters, 30)


@query("""WITH p(ord, label, re) AS (VALUES (1, 'script', '(?i)<script'), (2, 'table', '(?i)<table'), (3, 'title', '(?i)<title')), l AS (SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages),
f AS (SELECT page_id, ord, label, count(*) AS n FROM l, p WHERE regexp_matches(line, re) GROUP BY ALL) SELECT page_id, string_agg(label, ', ' ORDER BY ord) AS labels, sum(n)::BIGINT AS n_lines FROM f GROUP BY 1""")
def scan_logs(t):
    lines = t("pages").select("page_id", F.explode(F.split("html", "\n")).alias("line"))
    return reports.scan_logs(lines, ["page_id"], patterns={x: f"(?i)<{x}" for x in ("script", "table", "title")})


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_discount, l_quantity DESC, concat_ws(chr(9), l_partkey, l_suppkey, l_linenumber)) = 1""")
def top_hit(t):
    hits = t("lineitem").select("l_orderkey", F.col("l_extendedprice"), F.col("l_discount").alias("evalue"), F.col("l_quantity").alias("percent_identity"), "l_partkey", "l_suppkey", "l_linenumber")
    return ranking.top_hit(hits, ["l_orderkey"], score="l_extendedprice").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query("SELECT event_id, " + ", ".join(f"{sql} AS {name}" for name, sql in {
    "reads_before": "event_id::VARCHAR", "bases_before": "(event_id * 150)::VARCHAR", "q20_rate_before": "'0.5'", "q30_rate_before": "'NA'", "reads_after": "CASE WHEN event_type = 'click' THEN 'NA' ELSE user_id::VARCHAR END",
    "bases_after": "CASE WHEN event_type = 'click' THEN 'NA' ELSE (user_id * 150)::VARCHAR END", "q20_rate_after": "CASE WHEN event_type = 'click' THEN 'NA' ELSE '0.75' END", "q30_rate_after": "'NA'", "reads_passed": "event_type", "reads_low_quality": "(props->>'$.k')",
    "reads_too_short": "'NA'", "reads_with_adapters": "'0'"}.items()) + " FROM events")
def read_qc_json(t):
    part = lambda n, rate: F.struct(n.alias("total_reads"), (n * 150).alias("total_bases"), F.lit(rate).alias("q20_rate"))
    after = F.when(F.col("event_type") != "click", part(F.col("user_id"), 0.75))
    text = F.to_json(F.struct(
        F.struct(part(F.col("event_id"), 0.5).alias("before_filtering"), after.alias("after_filtering")).alias("summary"),
        F.struct(F.col("event_type").alias("passed_filter_reads"), F.get_json_object("props", "$.k").cast("int").alias("low_quality_reads")).alias("filtering_result"), F.struct(F.lit(0).alias("adapter_trimmed_reads")).alias("adapter_cutting")))
    return t("events").select("event_id", *files.read_qc_fields(text))


@query("""SELECT d.doc_id, CASE WHEN n_chars >= 500 THEN sha256(text) END AS sha256, CASE WHEN n_chars < 500 THEN 'MISSING' WHEN d.doc_id % 3 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS checksum_status FROM documents d""")
def checksums(t):
    docs = t("documents")
    expected = docs.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.upper(F.sha2("text", 256))).otherwise("0").alias("expected"))
    return reports.checksums(docs.where("n_chars >= 500"), "doc_id", "text", expected)


@query("""SELECT CASE c_custkey % 4 WHEN 0 THEN 'n' WHEN 1 THEN 'm' ELSE 'c' END || c_custkey AS sample_id, CASE WHEN c_custkey % 4 < 2 THEN c_nationkey ELSE 0 END::DOUBLE AS pass_segments, CASE WHEN c_custkey % 4 = 3 THEN c_nationkey ELSE 0 END::DOUBLE AS coverage_segments,
 CASE WHEN c_custkey % 4 <> 1 THEN 'INDETERMINATE' WHEN c_nationkey % 3 = 0 THEN 'DETECTED' WHEN c_nationkey % 3 = 1 THEN 'NOT_DETECTED' ELSE 'INDETERMINATE' END AS h5n1_screen, 'Unknown' AS state FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def summary_versions(t):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    name = lambda x: F.concat(F.lit(x), k.cast("string"))
    screen = F.when(n % 3 == 0, " pass").when(n % 3 == 1, "Not_detected").otherwise("odd")
    text = F.when(k % 4 == 0, tsv(name("n"), n)).when(k % 4 == 1, tsv(n, name("m"), screen)).when(k % 4 == 2, F.lit("duck")).otherwise(tsv(F.lit(" "), name("wrong"), n))
    rows = t("customer").select(name("c").alias("path"), F.lit(1).cast("long").alias("line_no"), text.alias("line"))
    of = F.substring("path", 2, 9).cast("int") % 4
    header = F.when(of == 0, "sample\tsegments_pass").when(of == 1, "segments_pass\tsample_id\th5n1_screen").when(of == 2, "host").otherwise("sample_id\tsample\tcoverage_segments")
    found = tables.table_rows(with_header(rows, header), ["sample_id", "sample", "segments_pass", "coverage_segments", "h5n1_screen"]).drop("line_no")
    expected = t("customer").where("c_mktsegment != 'BUILDING'").select(name("c").alias("sample_id"))
    return samples.current_columns(samples.recovered_ids(found, expected, "path")).select("sample_id", "pass_segments", "coverage_segments", "h5n1_screen", "state")


@query("""WITH c AS (SELECT o_custkey AS sample, o_orderpriority AS segment, count(*) AS length, CASE WHEN min(o_orderstatus) = 'F' THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM orders GROUP BY ALL),
w AS (SELECT sample, segment, CASE WHEN sample % 5 = 0 THEN 'FAILED' WHEN sample % 5 = 1 THEN 'SKIPPED_QC' WHEN sample % 5 = 2 THEN 'SUCCESS' ELSE 'NOT_RECORDED' END AS v, CASE WHEN sample % 5 < 3 THEN 'SUCCESS · IRMA FALLBACK' ELSE 'NOT RECORDED' END AS s FROM c),
a AS (SELECT o_custkey AS sample, o_orderpriority AS segment, min(o_orderkey) FILTER (o_orderstatus = 'F') AS f, min(o_orderkey) FILTER (o_orderstatus = 'O' AND o_orderkey % 3 > 0) AS vcf FROM orders GROUP BY ALL)
SELECT sample, segment, length, overall_status, CASE WHEN v = 'NOT_RECORDED' THEN v ELSE 'SUCCESS' END AS inference_status, s AS consensus, coalesce('f' || f, 'Not available') AS consensus_file, v AS variant_status,
 CASE WHEN v IN ('SUCCESS', 'NOT_RECORDED') AND vcf IS NOT NULL THEN vcf % 3 || CASE WHEN vcf % 3 = 1 THEN ' variant' ELSE ' variants' END WHEN v = 'FAILED' THEN v WHEN v = 'SKIPPED_QC' OR overall_status <> 'PASS' THEN 'Skipped: segment QC' ELSE 'No VCF produced' END AS variants,
 CASE WHEN v IN ('SUCCESS', 'NOT_RECORDED') AND vcf IS NOT NULL THEN 'v' || vcf ELSE 'Not generated' END AS variant_file FROM c JOIN w USING (sample, segment) LEFT JOIN a USING (sample, segment)""")
def files_table(t):
    key = F.col("o_orderkey")
    o = t("orders").select(F.col("o_custkey").alias("sample"), F.col("o_orderpriority").alias("segment"), "o_orderstatus", "o_orderkey")
    coverage = o.groupBy("sample", "segment").agg(F.count("*").alias("length"), F.when(F.min("o_orderstatus") == "F", "PASS").otherwise("FAIL").alias("overall_status"))
    kind = F.when(F.col("o_orderstatus") == "F", "consensus").when(F.col("o_orderstatus") == "O", "vcf").otherwise("bam")
    # numbers of one width, so that the first path is that of the smallest number
    path = F.concat(F.when(kind == "vcf", "v").otherwise("f"), F.lpad(key.cast("string"), 18, "0"))
    size = F.when(kind == "vcf", key % 3).otherwise(1)
    artifacts = o.select("sample", "segment", kind.alias("kind"), path.alias("path"), size.alias("bytes"), (key % 3).alias("records"))
    done = F.when(F.col("sample") % 5 == 0, "FAILED").when(F.col("sample") % 5 == 1, "SKIPPED_QC").otherwise("SUCCESS")
    wide = coverage.where("sample % 5 < 3").select("sample", "segment", F.lit("SUCCESS").alias("inference_status"), F.lit("SUCCESS").alias("consensus_status"), F.lit("IRMA_FALLBACK").alias("consensus_source"), done.alias("variant_status"))
    out = samples.files_table(coverage, wide, artifacts, ["sample", "segment"])
    return out.withColumns({c: F.regexp_replace(c, "^([fv])0+(?=[0-9])", "$1") for c in ("consensus_file", "variant_file")})


SEGMENT_ROWS = """g AS (SELECT c_custkey, p.s FROM customer, (SELECT DISTINCT o_orderpriority AS s FROM orders) p), o AS (SELECT o_custkey AS c_custkey, o_orderpriority AS s, count(*) AS n, max(o_totalprice) AS top, min(o_orderstatus) AS st FROM orders GROUP BY ALL)"""


@query(f"""WITH {SEGMENT_ROWS} SELECT c_custkey, s AS segment, CASE WHEN st = 'F' THEN 'o' || c_custkey WHEN n IS NOT NULL THEN 'm' || c_custkey ELSE 'NA' END AS contig, CASE WHEN n > 0 THEN coalesce(CASE WHEN st = 'F' THEN floor(top)::BIGINT::VARCHAR END, n::VARCHAR) ELSE '0' END AS length,
 coalesce(CASE WHEN st = 'F' THEN 'PASS' END, CASE WHEN n IS NOT NULL AND c_custkey % 2 = 0 THEN 'FAIL' END, 'MISSING') AS overall_status, coalesce(n, 0) AS candidate_count, CASE WHEN n > 1 THEN 'MULTIPLE_CANDIDATES' WHEN n = 1 THEN 'UNIQUE' ELSE 'MISSING' END AS selection_status,
 CASE WHEN n IS NULL THEN 'MISSING' ELSE 'READY' END AS assembly_status FROM g LEFT JOIN o USING (c_custkey, s)""")
def segment_table(t):
    keys = ["c_custkey", "segment"]
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("segment")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"), F.min("o_orderstatus").alias("st"))
    manifest = o.select(*keys, F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("contig"), F.col("n").alias("fasta_length"), F.lit("READY").alias("status"), F.col("n").alias("candidate_count"), F.lit("").alias("selection_status"), F.lit("").alias("selection_reason"))
    stats = o.where("st = 'F'").select(*keys, F.concat(F.lit(" o"), F.col("c_custkey").cast("string")).alias("contig"), F.floor("top").alias("consensus_length"), F.lit("PASS").alias("status"))
    flags = o.where("c_custkey % 2 = 0").select(*keys, F.lit("FAIL").alias("flag"))
    grid = rollup.segment_grid(t("customer").select("c_custkey"), t("orders").select(F.col("o_orderpriority").alias("segment")).distinct())
    return rollup.segment_table(grid, manifest, stats, flags, keys).select(*keys, "contig", "length", "overall_status", "candidate_count", "selection_status", "assembly_status")


@query("""WITH a AS (SELECT o_custkey AS sample, o_orderpriority AS contig, CASE o_orderstatus WHEN 'F' THEN 'fasta' WHEN 'O' THEN 'bam' ELSE 'coverage' END AS kind, 'p' || o_orderkey AS path, o_totalprice AS bytes FROM orders)
SELECT sample, contig, min(path) FILTER (kind = 'fasta') AS fasta_path, arg_min(bytes, path) FILTER (kind = 'fasta') AS fasta_bytes, min(path) FILTER (kind = 'bam') AS bam_path, arg_min(bytes, path) FILTER (kind = 'bam') AS bam_bytes,
 min(path) FILTER (kind = 'coverage') AS coverage_path, arg_min(bytes, path) FILTER (kind = 'coverage') AS coverage_bytes FROM a GROUP BY ALL""")
def pair_artifacts(t):
    kind = F.when(F.col("o_orderstatus") == "F", "fasta").when(F.col("o_orderstatus") == "O", "bam").otherwise("coverage")
    return rollup.pair_artifacts(t("orders").select(F.col("o_custkey").alias("sample"), F.col("o_orderpriority").alias("contig"), kind.alias("kind"), F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("path"), F.col("o_totalprice").alias("bytes")))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def qc_gate(t):
    flags = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("FAIL").alias("flag"))
    return rollup.qc_gate(t("lineitem"), flags, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN p_brand WHEN p_partkey % 4 = 2 THEN 'Unknown' ELSE p_name END AS alias, CASE WHEN p_partkey % 3 <> 0 THEN 'https://x/' || replace(replace(p_brand, '#', '%23'), ' ', '+') END AS link,
 CASE WHEN p_size % 9 = 0 THEN 'fluA-seg9' WHEN p_size % 9 > 8 THEN '' ELSE ['PB2', 'PB1', 'PA', 'HA', 'NP', 'NA', 'MP', 'NS'][p_size % 9] END AS segment FROM part""")
def display_names(t):
    k = F.col("p_partkey") % 4
    first = F.when(k == 1, " unknown ").when(k == 2, "").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    second = F.when(k == 2, "UNKNOWN").otherwise(F.col("p_brand"))
    target = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise(F.element_at(F.array(F.lit("NO_HIT"), F.lit(" na"), F.lit("")), (F.col("p_partkey") % 2 + 1).cast("int")))
    group = F.concat(F.lit("fluA-seg"), F.when(F.col("p_size") % 9 == 0, 9).otherwise(F.col("p_size") % 9).cast("string"))
    return t("part").select("p_partkey", E.display_alias(first, second).alias("alias"), E.link(target, "https://x/").alias("link"), E.segment_of_group(group).alias("segment"))


__all__ = ["QUERIES", "SQL"]
