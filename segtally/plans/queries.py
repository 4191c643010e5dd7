"""Registered queries: each operator over the given tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segtally.functions import expr as E
from segtally.operators import depth, ranking, reads, reports, rollup, samples, stages
from segtally.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c, name):
    return F.round(c, 6).alias(name)


DEPTH = """SELECT l_suppkey, count(l_quantity) AS positions, median(l_quantity) AS median_depth, round(avg(l_quantity), 6) AS mean_depth, min(l_quantity) AS min_depth,
 max(l_quantity) AS max_depth, round(avg((l_quantity >= 25)::INT), 6) AS breadth_covered FROM lineitem GROUP BY 1"""


@query(DEPTH)
def depth_stats(t):
    d = depth.depth_stats(t("lineitem"), ["l_suppkey"], "l_quantity", 25)
    return d.withColumn("mean_depth", F.round("mean_depth", 6)).withColumn("breadth_covered", F.round("breadth_covered", 6))


@query(f"""WITH s AS ({DEPTH}), g AS (SELECT s_suppkey, s_suppkey % 11 = 0 AS gone, s_suppkey % 13 = 0 AS broken, s_suppkey % 17 = 0 AS no_depth, coalesce(positions, 0) = 0 AS bare,
 CASE WHEN median_depth >= 25.5 AND breadth_covered >= 0.52 THEN 'PASS' ELSE 'FAIL' END AS cov, CASE WHEN length(s_name) < 10 THEN 'FAIL' WHEN length(s_name) > 12 + s_nationkey % 9 THEN 'WARNING' ELSE 'PASS' END AS len,
 FROM supplier LEFT JOIN s ON s_suppkey = l_suppkey)
SELECT s_suppkey, CASE WHEN gone AND NOT broken THEN 'MISSING' WHEN broken THEN 'NA' WHEN no_depth THEN 'ERROR' WHEN bare THEN 'MISSING' ELSE cov END AS coverage_status,
 CASE WHEN gone AND NOT broken THEN 'MISSING' WHEN broken THEN 'ERROR' ELSE len END AS length_status, CASE WHEN gone AND NOT broken THEN 'MISSING' WHEN broken THEN 'ERROR' WHEN no_depth THEN 'ERROR' WHEN bare THEN 'MISSING'
 WHEN cov = 'PASS' AND len <> 'FAIL' THEN 'PASS' ELSE 'FAIL' END AS status FROM g""")
def segment_qc(t):
    key = F.col("s_suppkey")
    s = t("supplier").select("s_suppkey", F.when((key % 11 != 0) & (key % 13 != 0), F.col("s_name")).alias("sequence"), F.when(key % 13 == 0, "broken").alias("error"))
    stats = depth.depth_stats(t("lineitem"), ["l_suppkey"], "l_quantity", 25).withColumnRenamed("l_suppkey", "s_suppkey")
    failed = t("supplier").where(key % 17 == 0).select("s_suppkey", F.lit("unreadable").alias("depth_error"))
    bounds = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.lit(10).alias("lo"), (12 + F.col("n_nationkey") % 9).alias("hi"))
    out = depth.segment_qc(t("supplier").select("s_suppkey", "s_nationkey"), s, stats.join(failed, "s_suppkey", "full"), bounds, ["s_suppkey"], 25.5, 0.52, 0.5, "s_nationkey")
    return out.select("s_suppkey", "coverage_status", "length_status", "status")


RUNS = """e AS (SELECT l_suppkey % 10 AS contig, l_partkey AS p, 1 AS d FROM lineitem UNION ALL SELECT l_suppkey % 10, l_partkey + l_quantity::BIGINT, -1 FROM lineitem
 UNION ALL SELECT l_suppkey % 10, 1, 0 FROM lineitem UNION ALL SELECT l_suppkey % 10, max(l_partkey) + 52, 0 FROM lineitem GROUP BY 1),
s AS (SELECT contig, p, sum(d) AS d FROM e GROUP BY ALL), r AS (SELECT contig, p AS "start", lead(p) OVER w AS "end", sum(d) OVER w AS depth FROM s WINDOW w AS (PARTITION BY contig ORDER BY p))"""


def _runs(t):
    li = t("lineitem").select((F.col("l_suppkey") % 10).alias("contig"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"))
    return depth.depth_runs(li, li.groupBy("contig").agg((F.max("start") + 51).alias("length")))


@query(f'WITH {RUNS} SELECT contig, "start", "end", depth::BIGINT AS depth FROM r WHERE "end" IS NOT NULL')
def depth_runs(t):
    return _runs(t)


@query(f"""WITH {RUNS}, x AS (SELECT contig, depth, "end" - "start" AS n FROM r WHERE "end" IS NOT NULL), y AS (SELECT contig, depth::DOUBLE AS depth FROM x, range(x.n))
SELECT contig, count(*) AS positions, median(depth) AS median_depth, round(avg(depth), 6) AS mean_depth, round(avg((depth >= 5)::INT), 6) AS breadth_covered FROM y GROUP BY 1""")
def depth_run_stats(t):
    return depth.depth_run_stats(_runs(t), "contig", 5).withColumn("mean_depth", F.round("mean_depth", 6)).withColumn("breadth_covered", F.round("breadth_covered", 6))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, b."start" AS "start", b."end" AS "end" FROM lineitem,
 (SELECT unnest([0, 1]) AS k), LATERAL (SELECT CASE k WHEN 0 THEN l_partkey ELSE l_partkey + l_quantity::BIGINT + l_linenumber END AS "start",
 CASE k WHEN 0 THEN l_partkey + l_quantity::BIGINT ELSE l_partkey + l_quantity::BIGINT + l_linenumber + 7 END AS "end") b""")
def alignment_blocks(t):
    li = t("lineitem").withColumn("cigar", F.format_string("3S%dM%dD2I7M4H", F.col("l_quantity").cast("int"), F.col("l_linenumber"))).select("l_orderkey", "l_linenumber", "l_suppkey", "cigar", F.col("l_partkey").alias("pos"))
    return depth.alignment_blocks(li).select("l_orderkey", "l_linenumber", "l_suppkey", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""SELECT o_custkey, o_orderpriority, o_orderkey, candidate_count, CASE WHEN candidate_count > 1 THEN 'MULTIPLE_CANDIDATES' ELSE 'UNIQUE' END AS selection_status FROM
 (SELECT *, count(*) OVER w AS candidate_count FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey) = 1)""")
def select_candidate(t):
    return ranking.select_candidate(t("orders"), ["o_custkey", "o_orderpriority"], [F.desc("o_totalprice"), F.desc("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderkey", "candidate_count", "selection_status")


HIT = "l_extendedprice DESC, l_discount, l_quantity DESC, l_partkey, l_suppkey, l_linenumber"


def _hit_order():
    return [F.desc("l_extendedprice"), F.asc("l_discount"), F.desc("l_quantity"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_linenumber")]


@query(f"""WITH h AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY {HIT}) <= 1),
a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {HIT}) AS r FROM h), b AS (SELECT *, min(r) OVER (PARTITION BY l_orderkey, l_suppkey) AS b FROM a)
SELECT l_orderkey, l_suppkey, l_extendedprice FROM b QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY b) <= 3""")
def limit_hits(t):
    return ranking.limit_hits(t("lineitem"), ["l_orderkey"], "l_suppkey", _hit_order(), 1, 3).select("l_orderkey", "l_suppkey", "l_extendedprice")


@query(f"""WITH h AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {HIT}) = 1)
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'SKIPPED_QC' WHEN l_orderkey IS NULL THEN 'NO_HIT' WHEN l_quantity >= 20 AND 100.0 * l_quantity / 50 >= 60 THEN 'HIGH_CONFIDENCE' ELSE 'LOW_CONFIDENCE' END AS hit_status
FROM orders LEFT JOIN h ON o_orderkey = l_orderkey""")
def summarize_hits(t):
    grid = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("FAIL").alias("flag"))
    top = ranking.first_by(t("lineitem"), ["l_orderkey"], _hit_order()).select("l_orderkey", "l_suppkey", "l_quantity")
    return rollup.summarize_hits(grid, ["l_orderkey"], "flag", top, "l_suppkey", "l_quantity", E.query_coverage(F.col("l_quantity"), F.lit(50)), 20, 60).select(F.col("l_orderkey").alias("o_orderkey"), "hit_status")


@query("""SELECT c_custkey, p.o_orderpriority, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'MISSING' ELSE 'READY' END AS status FROM customer CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
 LEFT JOIN (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) o ON o_custkey = c_custkey AND o.o_orderpriority = p.o_orderpriority""")
def segment_grid(t):
    grid = rollup.segment_grid(t("customer").select("c_custkey"), t("orders").select("o_orderpriority").distinct())
    n = t("orders").groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").agg(F.count("*").alias("n"))
    return rollup.coverage_table(grid, ["c_custkey", "o_orderpriority"], n).select("c_custkey", "o_orderpriority", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "MISSING").otherwise("READY").alias("status"))


@query("""WITH g AS (SELECT user_id, coalesce(max((event_type = 'purchase' AND value >= 5)::INT), 0) AS a, coalesce(max((event_type = 'error' AND value >= 5)::INT), 0) AS b,
 coalesce(max((event_type = 'purchase' AND value >= 20)::INT), 0) AS c, coalesce(max((event_type = 'error' AND value >= 20)::INT), 0) AS d FROM events GROUP BY 1)
SELECT user_id, CASE WHEN a = 0 OR b = 0 THEN 'INDETERMINATE' WHEN c = 1 AND d = 1 THEN 'DETECTED' ELSE 'NOT_DETECTED' END AS screen,
 concat_ws(';', CASE WHEN a = 0 THEN 'purchase not informative' END, CASE WHEN b = 0 THEN 'error not informative' END) AS reason FROM g""")
def screen_pair(t):
    return rollup.screen_pair(t("events"), "user_id", "event_type", "purchase", "error", F.col("value") >= 5, F.col("value") >= 20)


@query("""SELECT user_id, """ + ", ".join(f"coalesce(max(upper(props)) FILTER (event_type = '{s}'), 'NOT_RECORDED') AS \"{s}\"" for s in ("view", "click", "error")) + " FROM events GROUP BY 1")
def stage_wide(t):
    return rollup.stage_wide(t("events"), "user_id", "event_type", ["view", "click", "error"], F.col("props"))


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'FAIL' WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE 'PASS' END AS f, CASE WHEN o_totalprice < 50000 THEN 'FAILED' WHEN o_totalprice < 90000 THEN 'SKIPPED_QC' ELSE 'SUCCESS' END AS i, o_totalprice >= 150000 AS ok FROM orders),
p AS (SELECT *, coalesce(f, '') <> 'PASS' AS skipped FROM s)
SELECT o_orderkey, CASE WHEN skipped OR i = 'SKIPPED_QC' THEN 'SKIPPED_QC' WHEN i = 'FAILED' THEN 'FAILED' WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS status,
 CASE WHEN skipped OR i = 'SKIPPED_QC' THEN 'NONE' WHEN i = 'SUCCESS' AND ok THEN 'MEDAKA' ELSE 'IRMA_FALLBACK' END AS source,
 CASE WHEN skipped THEN 'segment_qc_failed' WHEN i = 'SKIPPED_QC' THEN 'inference_skipped_qc' WHEN i = 'FAILED' THEN 'medaka_inference_failed' WHEN ok THEN 'polishing_completed' ELSE 'medaka_consensus_failed' END AS reason FROM p""")
def stage_status_machine(t):
    return t("orders").select("o_orderkey", *stages.consensus_status(_flag(), _inference(), F.col("o_totalprice") >= 150000))


def _flag():
    key = F.col("o_orderkey")
    return F.when(F.col("o_orderstatus") == "P", "FAIL").when(key % 7 == 0, None).when(key % 11 == 0, "").otherwise("PASS")


def _inference():
    price = F.col("o_totalprice")
    return F.when(price < 50000, "FAILED").when(price < 90000, "SKIPPED_QC").otherwise("SUCCESS")


ROLLUP = """SELECT o_custkey, count(*) FILTER (s = 'PASS') AS pass_n, count(*) FILTER (s = 'FAIL') AS fail_n, count(*) FILTER (s = 'MISSING') AS missing_n, count(*) FILTER (s <> 'MISSING') AS detected,
 coalesce(string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (s = 'PASS'), 'NONE') AS pass_names, coalesce(string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (s = 'FAIL'), 'NONE') AS fail_names,
 coalesce(string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) FILTER (s = 'MISSING'), 'NONE') AS missing_names
 FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'FAIL' ELSE 'MISSING' END AS s FROM orders) GROUP BY 1"""


def _rollup(t):
    s = F.when(F.col("o_orderstatus") == "F", "PASS").when(F.col("o_orderstatus") == "O", "FAIL").otherwise("MISSING")
    return rollup.segment_rollup(t("orders").withColumn("s", s), "o_custkey", "o_orderpriority", "s")


@query(ROLLUP)
def segment_rollup(t):
    return _rollup(t)


@query(f"""WITH r AS ({ROLLUP}) SELECT o_custkey, CASE WHEN pass_n >= 8 THEN 'Complete' WHEN pass_n >= 6 THEN 'Near-complete' WHEN pass_n >= 1 THEN 'Partial' ELSE 'Failed' END AS genome_status,
 coalesce(nullif(concat_ws(';', CASE WHEN pass_n < 8 THEN 'fewer_than_8_pass_segments' END, CASE WHEN fail_n > 0 THEN 'coverage_failures' END, CASE WHEN detected = 0 THEN 'no_consensus_segments' END), ''), 'NONE') AS review_flags FROM r""")
def review_flags(t):
    r = _rollup(t)
    return r.select("o_custkey", E.genome_status(F.col("pass_n")).alias("genome_status"), E.review_flags(F.col("pass_n"), F.lit("NOT_DETECTED"), F.col("fail_n"), F.col("detected"), F.lit(0)).alias("review_flags"))


@query(f"""WITH r AS ({ROLLUP}), b AS (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1), o AS (SELECT o_custkey AS k, round(sum(q), 6) AS bases FROM orders JOIN b ON o_orderkey = l_orderkey GROUP BY 1)
SELECT c_custkey, n_name, coalesce(bases, 0) AS bases, coalesce(pass_n, 0) AS pass_n, coalesce(pass_names, 'NONE') AS pass_names FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN r ON c_custkey = o_custkey LEFT JOIN o ON c_custkey = k""")
def sample_summary(t):
    b = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    bases = t("orders").join(b, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("q"), 6).alias("bases"))
    j = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    j = j.join(_rollup(t).withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").join(bases, "c_custkey", "left")
    return j.select("c_custkey", "n_name", F.coalesce("bases", F.lit(0.0)).alias("bases"), F.coalesce("pass_n", F.lit(0)).alias("pass_n"), F.coalesce("pass_names", F.lit("NONE")).alias("pass_names"))


@query("""WITH l AS (SELECT * FROM (VALUES ('view'), ('click'), ('refund'), ('error')) v(event_type)), c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), j AS (SELECT event_type, coalesce(n, 0) AS n FROM l LEFT JOIN c USING (event_type))
SELECT event_type, n, round(n / sum(n) OVER (), 6) AS fraction FROM j""")
def zero_filled_counts(t):
    e = t("events")
    levels = e.sparkSession.createDataFrame([(x,) for x in ("view", "click", "refund", "error")], "event_type string")
    return rollup.count_categories(e, "event_type", levels).withColumn("fraction", F.round("fraction", 6))


@query("""WITH n AS (SELECT least(floor(p_retailprice / 100), 25)::BIGINT AS b, count(*) AS n FROM part GROUP BY 1) SELECT r.range AS bin, coalesce(n, 0) AS n FROM range(26) r LEFT JOIN n ON b = r.range""")
def histogram(t):
    return rollup.histogram(t("part"), "p_retailprice", 100, 25)


@query(f"""WITH r AS ({ROLLUP}), s AS (SELECT CASE WHEN pass_n >= 8 THEN 'Complete' WHEN pass_n >= 6 THEN 'Near-complete' WHEN pass_n >= 1 THEN 'Partial' ELSE 'Failed' END AS g FROM r), l(status) AS (VALUES ('Complete'), ('Near-complete'), ('Partial'), ('Failed'))
SELECT (SELECT count(*) FROM s) AS samples, status, (SELECT count(*) FROM s WHERE g = status) AS n, round((SELECT count(*) FROM s WHERE g = status) / (SELECT count(*) FROM s), 6) AS share FROM l""")
def genome_status_overview(t):
    r = _rollup(t).select(E.genome_status(F.col("pass_n")).alias("g"))
    return rollup.overview(r, "g", ["Complete", "Near-complete", "Partial", "Failed"]).withColumn("share", F.round("share", 6))


@query("SELECT d.doc_id, quality, toxic, CASE WHEN l.doc_id IS NULL THEN 'MISSING' ELSE 'COMPLETE' END AS metadata_status FROM documents d LEFT JOIN labels l USING (doc_id)")
def conform_metadata(t):
    return rollup.conform_metadata(t("labels"), t("documents").select("doc_id"), "doc_id", ["quality", "toxic"])


@query("SELECT 'left' AS side, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'right', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def unmatched_keys(t):
    return rollup.unmatched(t("documents"), t("labels"), "doc_id")


@query("""SELECT doc_id, 'ERROR' AS level, 'short text' AS message FROM documents WHERE n_chars < 500 UNION ALL SELECT doc_id, 'WARNING', 'unexpected language' FROM documents WHERE NOT regexp_matches(lang, '^(en|fr)$')""")
def validate_metadata_issues(t):
    return rollup.validation_issues(t("documents"), "doc_id", [("ERROR", "short text", F.col("n_chars") >= 500), ("WARNING", "unexpected language", F.col("lang").rlike("^(en|fr)$"))])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER w > 1 AS duplicate FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice)""")
def duplicate_keys(t):
    return ranking.flag_duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"], [F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]).select("l_orderkey", "l_linenumber", "l_partkey", "duplicate")


@query(r"""SELECT p_partkey, nullif(upper(regexp_extract(p_brand, '(?is)^.*(d#?[0-9]+)', 1)), '') AS subtype, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS name, coalesce(nullif(regexp_extract(p_type, '(?:^|_)(HA|NA)$', 1), ''), p_type) AS token FROM part""")
def extract_names(t):
    return t("part").select("p_partkey", E.extract_subtype(F.col("p_brand"), "d#?").alias("subtype"), E.normalize_name(F.col("p_name")).alias("name"), E.segment_of_token(F.col("p_type")).alias("token"))


READS = "WITH f AS (SELECT *, CASE WHEN lang = 'es' THEN 'low_quality' WHEN n_chars < 800 THEN 'too_short' ELSE 'passed' END AS reason FROM documents)"


def _reads(t):
    return reads.filter_reads(t("documents"), F.when(F.col("lang") == "es", 5).otherwise(30), F.col("n_chars"), 10, 800)


@query(READS + " SELECT doc_id, reason FROM f")
def filter_reads(t):
    return _reads(t).select("doc_id", "reason")


@query(READS + """ SELECT lang, count(*) AS reads_before, sum(n_chars)::BIGINT AS bases_before, count(*) FILTER (reason = 'passed') AS reads_after, coalesce(sum(n_chars) FILTER (reason = 'passed'), 0)::BIGINT AS bases_after,
 count(*) FILTER (reason = 'low_quality') AS low_quality, count(*) FILTER (reason = 'too_short') AS too_short FROM f GROUP BY 1""")
def read_qc_summary(t):
    return reads.read_qc_summary(_reads(t), ["lang"], "n_chars")


@query("""WITH w AS (SELECT lang, n_chars, sum(n_chars) OVER (PARTITION BY lang ORDER BY n_chars DESC) AS run, sum(n_chars) OVER (PARTITION BY lang) AS tot FROM documents), n AS (SELECT lang, max(n_chars) AS n50 FROM w WHERE 2 * run >= tot GROUP BY 1)
SELECT lang, count(*) AS reads, sum(n_chars)::BIGINT AS bases, round(avg(n_chars), 6) AS mean_length, median(n_chars) AS median_length, round(stddev(n_chars), 6) AS sd_length, max(n_chars) AS max_length, any_value(n50) AS n50 FROM documents JOIN n USING (lang) GROUP BY 1""")
def read_set_stats(t):
    s = reads.read_set_stats(t("documents"), ["lang"], "n_chars").join(ranking.n50(t("documents"), ["lang"], "n_chars"), "lang")
    return s.withColumn("mean_length", F.round("mean_length", 6)).withColumn("sd_length", F.round("sd_length", 6))


@query(READS + " SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS read_no FROM f WHERE reason = 'passed'")
def renumber_reads(t):
    return ranking.renumber(_reads(t).where("reason = 'passed'"), ["lang"], ["doc_id"]).select("lang", "doc_id", "read_no")


@query("""WITH e AS (SELECT 'start' AS side, left(text, 4) AS kmer FROM conversations UNION ALL SELECT 'end', right(text, 4) FROM conversations), n AS (SELECT side, kmer, count(*) AS n FROM e WHERE length(kmer) = 4 GROUP BY ALL)
SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY side ORDER BY n DESC, kmer) <= 20""")
def end_kmers(t):
    return reads.end_kmers(t("conversations"), F.col("text"), 4, 20)


@query("""WITH q AS (SELECT DISTINCT item_id, substr(text, i::INT, 24) AS kmer FROM (SELECT item_id, text, unnest(range(1, greatest(length(text) - 23, 1) + 1)) AS i FROM benchmark WHERE length(text) >= 24)),
d AS (SELECT DISTINCT doc_id, substr(text, i::INT, 24) AS kmer FROM (SELECT doc_id, text, unnest(range(1, greatest(length(text) - 23, 1) + 1)) AS i FROM documents WHERE length(text) >= 24)),
n AS (SELECT item_id, count(*) AS t FROM q GROUP BY 1), m AS (SELECT item_id, doc_id, count(*) AS shared FROM q JOIN d USING (kmer) GROUP BY ALL HAVING count(*) >= 5)
SELECT item_id, doc_id, shared, round(shared / t, 6) AS containment FROM m JOIN n USING (item_id) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) <= 5""")
def kmer_candidates(t):
    return reads.kmer_candidates(t("benchmark"), t("documents"), "item_id", "doc_id", "text", 24, 5, 5).withColumn("containment", F.round("containment", 6))


@query("""WITH h AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 2)
SELECT user_id, count(DISTINCT event_type) AS distinct_values, min(event_type) AS value, count(event_type) AS records, CASE count(DISTINCT event_type) WHEN 1 THEN 'OK' WHEN 0 THEN 'NONE' ELSE 'SEVERAL' END AS status FROM h GROUP BY 1""")
def single_value_check(t):
    return ranking.single_value(ranking.head_per_group(t("events"), ["user_id"], [F.asc("ts"), F.asc("event_id")], 2), ["user_id"], "event_type").drop("by_value")


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256(t):
    return t("documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("SELECT l_returnflag, count(*) - count(*) FILTER (l_quantity >= 25) AS removed, round(count(*) FILTER (l_quantity >= 25) / count(*), 6) AS retained FROM lineitem GROUP BY 1")
def retention(t):
    g = t("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("b"), F.count_if(F.col("l_quantity") >= 25).alias("a"))
    return g.select("l_returnflag", *E.retention(F.col("b"), F.col("a"))).withColumn("retained", F.round("retained", 6))


@query("""SELECT c_custkey, 'C Name' AS field, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'C Nationkey', c_nationkey::VARCHAR FROM customer""")
def metadata_long(t):
    return rollup.metadata_long(t("customer"), "c_custkey", ["c_name", "c_nationkey"])


@query("SELECT s_suppkey AS key, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def union_versions(t):
    s = t("supplier").select(F.col("s_suppkey").alias("key"), rollup.versioned_column(t("supplier"), ["c_acctbal", "s_acctbal"]).alias("acctbal"))
    return rollup.union_versions(s, t("customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")))


@query("""WITH s AS (SELECT user_id, max((event_type = 'error')::INT) AS f FROM events WHERE event_type IN ('view', 'error') GROUP BY 1), a AS (SELECT user_id, count(*) AS alerts, count(*) FILTER (value >= 20) AS fatal_alerts FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT user_id, CASE f WHEN 1 THEN 'FAIL' WHEN 0 THEN 'PASS' ELSE 'REVIEW' END AS status, coalesce(alerts, 0) AS alerts, coalesce(fatal_alerts, 0) AS fatal_alerts FROM s FULL JOIN a USING (user_id)""")
def annotation_summary(t):
    e = t("events")
    kind = lambda k: e.where(F.col("event_type") == k)
    return rollup.annotation_summary(kind("view"), kind("error"), kind("click").withColumn("fatal", F.col("value") >= 20), "user_id")


@query("""SELECT c_nationkey, '{"format":"run-document","version":1,"run":{"name":"' || c_nationkey || '"},"sample_count":' || count(*) || ',"samples":{' || string_agg('"' || c_custkey || '":{"c_mktsegment":"' || c_mktsegment || '"}', ',' ORDER BY c_custkey::VARCHAR) || '}}' AS document FROM customer GROUP BY 1""")
def run_document(t):
    return rollup.run_document(t("customer"), "c_nationkey", F.struct("c_mktsegment"), "c_custkey")


@query("""SELECT p_brand AS path, sum(p_partkey % 5 + 1)::BIGINT AS sequences, sum(p_partkey % 5 + 1 - (p_partkey % 3 = 0)::INT)::BIGINT AS passed, sum((p_partkey % 3 = 0)::INT)::BIGINT AS failed FROM part GROUP BY 1""")
def annotation_totals(t):
    k, failed = F.col("p_partkey").cast("long"), (F.col("p_partkey") % 3 == 0).cast("long")
    line = F.format_string(" %d  M%d  fluA-seg%d  H%dN1  %d  %d  %d", k, k, k % 9, k % 7, k % 5 + 1, k % 5 + 1 - failed, failed)
    return reports.annotation_totals(reports.annotation_models(t("part").select(F.col("p_brand").alias("path"), line.alias("line"))))


@query("""SELECT user_id AS path, event_type AS alert, event_id % 2 = 0 AS failure_causing, count(*) AS lines, sum(event_id % 11)::BIGINT AS cases FROM events GROUP BY ALL""")
def annotation_alerts(t):
    i = F.col("event_id").cast("long")
    line = F.concat(i, F.lit(" "), "event_type", F.when(i % 2 == 0, " yes*").otherwise(" no"), F.lit(" low_similarity sequence "), i % 11, F.lit(" 1 what it says"))
    a = reports.annotation_alerts(t("events").select(F.col("user_id").alias("path"), line.alias("line")))
    return a.groupBy("path", "alert", "failure_causing").agg(F.count("*").alias("lines"), F.sum("cases").alias("cases"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'Not run' ELSE o_orderstatus END AS status, CASE o_orderstatus WHEN 'P' THEN 'not run: the screen was INDETERMINATE' ELSE o_orderpriority END AS reason,
 CASE WHEN o_orderstatus <> 'P' THEN (o_custkey % 9)::INT END AS matched_segments, CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS ha FROM orders""")
def genotype_report(t):
    text = F.concat(
        F.lit("pident_threshold: 98.0\nconsensus Genotype --> "), "o_orderstatus", F.lit(": "), "o_orderpriority", F.lit("\nOnly "), F.col("o_custkey") % 9,
        F.lit(" segments >98.0% match found of total 8 segments\nsegments in input file: ha: "), "o_custkey", F.lit(", NA:x at percent identity\n"))
    gate = F.lit("sample\tstatus\ns1\tH5N1_INDETERMINATE\n")
    parts = {c: v for c, v in zip(("status", "reason", "threshold", "matched", "inputs", "calls"), reports.parse_genotype_report(F.col("_text")))}
    d = t("orders").withColumn("_text", F.when(F.col("o_orderstatus") == "P", gate).otherwise(text))
    return d.select("o_orderkey", parts["status"], parts["reason"], parts["matched"], parts["calls"]["HA"].alias("ha"))


@query("""SELECT s_suppkey, 'who.name' AS field, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 'who.at.nation', s_nationkey::VARCHAR FROM supplier UNION ALL SELECT s_suppkey, 'id', s_suppkey::VARCHAR FROM supplier""")
def flatten_json(t):
    at = F.struct(F.col("s_nationkey").alias("nation"))
    nested = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("name"), at.alias("at")).alias("who")))
    return reports.flatten_json(t("supplier").withColumn("_json", nested), "s_suppkey", "_json")


@query("""SELECT c_nationkey, c_custkey::VARCHAR AS sample, '{"c_mktsegment":"' || c_mktsegment || '"}' AS payload FROM customer""")
def read_run_documents(t):
    docs = rollup.run_document(t("customer"), "c_nationkey", F.struct("c_mktsegment"), "c_custkey")
    return reports.read_run_documents(docs, "c_nationkey")[0]


@query("SELECT l_suppkey, median(l_quantity) FILTER (l_returnflag <> 'R') AS coverage_median FROM lineitem GROUP BY 1")
def coverage_median(t):
    depth_text = F.when(F.col("l_returnflag") == "R", "NA").otherwise(F.col("l_quantity").cast("string"))
    return reports.coverage_median(t("lineitem").select("l_suppkey", F.lit("x").alias("Depth (text)"), depth_text.alias("Coverage Depth")), ["l_suppkey"])


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS c, l_partkey BETWEEN 950 AND 1050 AS n, l_linenumber % 2 = 0 AS mp, l_discount <= 0.05 AS d FROM lineitem),
 q AS (SELECT l_orderkey, l_linenumber, CASE WHEN c THEN 'PASS' ELSE 'FAIL' END AS c, CASE WHEN NOT mp THEN 'REVIEW' WHEN n THEN 'PASS' ELSE 'FAIL' END AS length_status, CASE WHEN d THEN 'PASS' ELSE 'FAIL' END AS n_content_status FROM s)
SELECT l_orderkey, l_linenumber, length_status, n_content_status, CASE WHEN c = 'PASS' AND length_status = 'PASS' AND n_content_status = 'PASS' THEN 'PASS' WHEN length_status = 'REVIEW' THEN 'REVIEW' ELSE 'FAIL' END AS overall_status FROM q""")
def backfill_qc(t):
    segment = F.when(F.col("l_linenumber") % 2 == 0, "MP").otherwise("other")
    old = t("lineitem").select("l_orderkey", "l_linenumber", segment.alias("segment"), F.col("l_partkey").alias("length"), F.col("l_discount").alias("n_fraction"),
                               F.when(F.col("l_returnflag") == "R", "pass").otherwise("fail").alias("coverage_status"), F.lit("NA").alias("length_status"))
    return reports.backfill_qc(old, 0.05).select("l_orderkey", "l_linenumber", "length_status", "n_content_status", "overall_status")


@query(f"""WITH r AS ({ROLLUP}), f AS (SELECT *, concat_ws('; ', CASE WHEN pass_n < 8 THEN 'fewer_than_8_pass_segments' END, CASE WHEN fail_n > 0 THEN 'coverage_failures' END, CASE WHEN detected = 0 THEN 'no_consensus_segments' END,
 CASE WHEN fail_n > 0 OR missing_n > 0 THEN 'Medaka: ' || fail_n || ' failed segment(s); ' || missing_n || ' IRMA fallback segment(s)' END) AS t FROM r)
SELECT o_custkey, t <> '' AS review_required, nullif(t, '') AS review_reason FROM f""")
def derive_review(t):
    r = _rollup(t)
    flags = E.review_flags(F.col("pass_n"), F.lit("NOT_DETECTED"), F.col("fail_n"), F.col("detected"), F.lit(0))
    r = r.select("o_custkey", "fail_n", "missing_n", F.col("pass_n").alias("pass_segments"), E.genome_status(F.col("pass_n")).alias("genome_status"), flags.alias("review_flags"))
    return reports.merge_reason(reports.derive_review(r), "fail_n", "missing_n").select("o_custkey", "review_required", "review_reason")


@query("""SELECT p_partkey, 'Name' AS metric, p_name AS value FROM part UNION ALL SELECT p_partkey, 'Subtype', upper(p_brand) FROM part""")
def metric_table(t):
    return reports.metric_table(t("part"), "p_partkey", {"Name": F.col("p_name"), "Subtype": F.upper("p_brand")})


@query("""SELECT o_orderkey, CASE WHEN f IS DISTINCT FROM 'PASS' THEN 'SKIPPED_QC' WHEN i <> 'SUCCESS' THEN i WHEN o_totalprice >= 150000 AND o_orderkey % 3 > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
 CASE WHEN f IS DISTINCT FROM 'PASS' THEN 'segment_qc_failed' WHEN i = 'SKIPPED_QC' THEN 'inference_skipped_qc' WHEN i = 'FAILED' THEN 'medaka_inference_failed' WHEN o_totalprice < 150000 THEN 'medaka_vcf_failed' WHEN o_orderkey % 3 > 0 THEN 'vcf_generated' ELSE 'medaka_vcf_empty_output' END AS reason
 FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'FAIL' WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '' ELSE 'PASS' END AS f, CASE WHEN o_totalprice < 50000 THEN 'FAILED' WHEN o_totalprice < 90000 THEN 'SKIPPED_QC' ELSE 'SUCCESS' END AS i FROM orders)""")
def variant_status(t):
    status, _, reason = stages.variant_status(_flag(), _inference(), F.col("o_totalprice") >= 150000, F.col("o_orderkey") % 3 > 0)
    return t("orders").select("o_orderkey", status, reason)


STAGES = """o AS (SELECT o_custkey AS c, o_orderpriority AS p, o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN 'SKIPPED_QC' WHEN o_totalprice < 50000 THEN 'FAILED' ELSE 'SUCCESS' END AS i FROM orders WHERE o_orderkey % 4 > 0
 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1),
w AS (SELECT c_custkey, pr AS p, coalesce(i, 'NOT_RECORDED') AS inference_status, CASE WHEN k % 3 = 0 THEN 'NOT_RECORDED' ELSE coalesce(i, 'NOT_RECORDED') END AS consensus_status,
 CASE WHEN k IS NULL OR k % 3 = 0 THEN 'NOT_RECORDED' WHEN i = 'FAILED' THEN 'IRMA_FALLBACK' WHEN i = 'SUCCESS' THEN 'MEDAKA' ELSE 'NONE' END AS consensus_source, CASE WHEN k % 5 = 0 THEN i ELSE 'NOT_RECORDED' END AS variant_status
 FROM customer CROSS JOIN (SELECT DISTINCT o_orderpriority AS pr FROM orders) LEFT JOIN o ON c = c_custkey AND p = pr)"""


def _wide(t):
    first = ranking.first_by(t("orders").where("o_orderkey % 4 > 0"), ["o_custkey", "o_orderpriority"], [F.asc("o_orderkey")])
    status = F.when(F.col("o_orderstatus") == "P", "skipped_qc").when(F.col("o_totalprice") < 50000, "failed").otherwise(" success")
    source = F.when(status == "failed", "IRMA_FALLBACK").when(status == " success", "medaka").otherwise("NONE")
    rows = first.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("p"), "o_orderkey", status.alias("status"), source.alias("source"), F.lit("why").alias("reason"))
    long = rows.withColumn("stage", F.lit("inference")).unionByName(rows.where("o_orderkey % 3 > 0").withColumn("stage", F.lit("consensus"))).unionByName(rows.where("o_orderkey % 5 = 0").withColumn("stage", F.lit("variant")))
    grid = rollup.segment_grid(t("customer").select("c_custkey"), t("orders").select(F.col("o_orderpriority").alias("p")).distinct())
    return rollup.stage_status_wide(grid, long, ["c_custkey", "p"], "stage", ["inference", "consensus", "variant"], ["status", "source", "reason"])


@query(f"WITH {STAGES} SELECT * FROM w")
def stage_status_wide(t):
    return _wide(t).select("c_custkey", "p", "inference_status", "consensus_status", "consensus_source", "variant_status")


ROLLED = """SELECT c_custkey, count(*) FILTER (inference_status <> 'NOT_RECORDED') AS status_records, count(*) FILTER (consensus_status = 'SUCCESS') AS polished_segments, count(*) FILTER (consensus_source = 'IRMA_FALLBACK') AS fallback_segments,
 count(*) FILTER (inference_status = 'FAILED') AS failed_segments, count(*) FILTER (inference_status = 'SKIPPED_QC') AS skipped_qc_segments, count(*) FILTER (variant_status = 'FAILED') AS variant_failed_segments FROM w GROUP BY 1"""


@query(f"WITH {STAGES} {ROLLED}")
def stage_rollup(t):
    return rollup.stage_rollup(_wide(t), "c_custkey")


SEGMENT_OF = "['HA', 'NA', 'PB2', 'PB1', 'PA', 'NP', 'MP', 'NS', 'XX'][(l_partkey % 9 + 1)::INT]"


def _segment():
    return F.element_at(F.array(*map(F.lit, [*E.SEGMENTS, "XX"])), (F.col("l_partkey") % 9 + 1).cast("int"))


@query(f"""WITH m AS (SELECT l_orderkey, {SEGMENT_OF} AS s, l_returnflag = 'R' AND l_linenumber % 4 > 0 AS ok FROM lineitem), d AS (SELECT DISTINCT l_orderkey, s FROM m WHERE ok AND s <> 'XX')
SELECT l_orderkey, count(s) AS ready_n, coalesce(string_agg(s, ',' ORDER BY list_position(['HA', 'NA', 'PB2', 'PB1', 'PA', 'NP', 'MP', 'NS'], s)), 'NONE') AS ready_names FROM (SELECT DISTINCT l_orderkey FROM m) LEFT JOIN d USING (l_orderkey) GROUP BY 1""")
def ready_segments(t):
    status = F.when(F.col("l_returnflag") == "R", "READY").otherwise("FASTA_ONLY")
    return stages.ready_segments(t("lineitem").select("l_orderkey", _segment().alias("segment"), status.alias("status"), F.lit(9).alias("fasta_bytes"), (F.col("l_linenumber") % 4).alias("bam_bytes")), "l_orderkey")


@query(f"""WITH a AS (SELECT l_suppkey AS sample, {SEGMENT_OF} AS segment, 'A_' || {SEGMENT_OF} || '_' || l_partkey % 7 AS contig, ['fasta', 'bam', 'coverage'][(l_linenumber % 3 + 1)::INT] AS kind, l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS path, l_quantity::BIGINT AS bytes, round(l_discount * 100) AS m, l_partkey AS len FROM lineitem WHERE l_partkey % 9 < 8),
c AS (SELECT sample, segment, contig, min(path) FILTER (kind = 'fasta') AS f, min(path) FILTER (kind = 'bam') AS b, min_by(bytes, path) FILTER (kind = 'bam') AS size, coalesce(min_by(len, path) FILTER (kind = 'fasta'), 0) AS len, min_by(m, path) FILTER (kind = 'coverage') AS m FROM a GROUP BY ALL),
r AS (SELECT *, count(*) OVER (PARTITION BY sample, segment) AS n, row_number() OVER (PARTITION BY sample, segment ORDER BY (f IS NOT NULL AND b IS NOT NULL) DESC, (m IS NOT NULL) DESC, coalesce(m, -1) DESC, coalesce(size, 0) DESC, len DESC, contig) AS k FROM c),
g AS (SELECT s_suppkey AS sample, unnest(['HA', 'NA', 'PB2', 'PB1', 'PA', 'NP', 'MP', 'NS']) AS segment FROM supplier)
SELECT sample, segment, CASE WHEN f IS NOT NULL AND b IS NOT NULL THEN 'READY' WHEN f IS NOT NULL THEN 'FASTA_ONLY' WHEN b IS NOT NULL THEN 'BAM_ONLY' ELSE 'MISSING' END AS status, contig, coalesce(len, 0) AS fasta_length, m AS coverage_median, coalesce(n, 0) AS candidate_count,
 CASE WHEN n IS NULL THEN 'MISSING' WHEN n > 1 THEN 'MULTIPLE_CANDIDATES' ELSE 'UNIQUE' END AS selection_status FROM g LEFT JOIN (SELECT * FROM r WHERE k = 1) USING (sample, segment)""")
def normalize_assembly(t):
    li = t("lineitem").where("l_partkey % 9 < 8")
    path = F.concat_ws("/", *(F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    kind = F.element_at(F.array(*map(F.lit, ("fasta", "bam", "coverage"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    a = li.select(F.col("l_suppkey").alias("sample"), F.concat(F.lit("A_"), _segment(), F.lit("_"), (F.col("l_partkey") % 7).cast("string")).alias("contig"), _segment().alias("segment"), kind.alias("kind"), path.alias("path"), F.col("l_quantity").cast("long").alias("bytes"))
    medians = li.select(path.alias("path"), F.round(F.col("l_discount") * 100).alias("coverage_median"))
    m = stages.normalize_assembly(a, medians, li.select(path.alias("path"), F.col("l_partkey").alias("fasta_length")), t("supplier").select(F.col("s_suppkey").alias("sample")))
    return m.select("sample", "segment", "status", "contig", "fasta_length", "coverage_median", "candidate_count", "selection_status")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_comment2 WHEN o_orderstatus = 'F' THEN o_orderpriority END AS sequence, CASE WHEN o_orderstatus = 'P' THEN 'IRMA_FALLBACK' ELSE 'MEDAKA' END AS source
 FROM (SELECT *, 'draft' || o_orderkey AS o_comment2 FROM orders) WHERE o_orderstatus IN ('P', 'F') AND o_orderkey % 5 > 0""")
def consensus_set(t):
    o = t("orders")
    draft = o.select("o_orderkey", F.concat(F.lit("draft"), F.col("o_orderkey").cast("string")).alias("sequence"))
    status = o.where("o_orderkey % 5 > 0").select("o_orderkey", F.lit("any").alias("status"), F.when(F.col("o_orderstatus") == "P", "IRMA_FALLBACK").when(F.col("o_orderstatus") == "F", "MEDAKA").otherwise("NONE").alias("source"))
    return stages.consensus_set(draft, o.select("o_orderkey", F.col("o_orderpriority").alias("sequence")), status, ["o_orderkey"])


@query("""SELECT o_orderkey, o_clerk_model AS model, 'FASTQ metadata' AS model_source, CASE WHEN o_clerk_model = '' THEN 'FAILED' ELSE 'RESOLVED' END AS model_status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS o_clerk_model FROM orders)""")
def resolve_model(t):
    header = F.concat(F.lit("@r1 x=1 basecall_model="), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.replace("o_orderpriority", F.lit(" "), F.lit("~"))))
    found = F.replace(E.header_value(header, "basecall_model"), F.lit("~"), F.lit(" "))
    return t("orders").select("o_orderkey", *stages.resolve_model(found, None))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'H5N1_NOT_DETECTED' WHEN 'O' THEN 'H5N1_INDETERMINATE' ELSE 'GENOTYPE' END AS genotype_status FROM orders""")
def route_by_screen(t):
    screen = t("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "NOT_DETECTED").when(F.col("o_orderstatus") == "O", "INDETERMINATE").otherwise("DETECTED").alias("screen"))
    go, other = stages.route_by_screen(screen)
    return go.select("o_orderkey", F.lit("GENOTYPE").alias("genotype_status")).unionByName(other.select("o_orderkey", "genotype_status"))


SUMMARY = f"""cov AS (SELECT l_orderkey AS k, {SEGMENT_OF} AS s, CASE WHEN l_returnflag = 'R' THEN 'PASS' WHEN l_returnflag = 'A' THEN 'FAIL' ELSE 'MISSING' END AS f, 'A_' || {SEGMENT_OF} || '_H' || l_linenumber AS contig, l_linenumber % 3 AS n FROM lineitem WHERE l_partkey % 9 < 8),
x AS (SELECT k, count(*) FILTER (f <> 'MISSING') AS segments_detected, count(*) FILTER (f = 'PASS') AS segments_pass, count(*) FILTER (f = 'FAIL') AS failed, count(*) FILTER (n > 1) AS several, greatest(max(n), 1) AS most, min(contig) FILTER (s = 'HA') AS ha FROM cov GROUP BY 1),
p AS (SELECT k, string_agg(s, ',' ORDER BY list_position(['HA', 'NA', 'PB2', 'PB1', 'PA', 'NP', 'MP', 'NS'], s)) AS names FROM (SELECT DISTINCT k, s FROM cov WHERE f = 'PASS') GROUP BY 1),
c AS (SELECT l_orderkey AS k, count(*) AS consensus FROM lineitem WHERE l_linenumber > 5 GROUP BY 1),
y AS (SELECT o_orderkey AS sample, o_orderpriority AS host, o_orderstatus AS metadata_h5n1_screen, CASE o_orderstatus WHEN 'F' THEN 'NOT_DETECTED' WHEN 'O' THEN 'DETECTED' ELSE 'INDETERMINATE' END AS h5n1_screen, coalesce(segments_detected, 0) AS segments_detected, coalesce(segments_pass, 0) AS segments_pass,
 coalesce(names, 'NONE') AS pass_segment_names, coalesce(ha, 'NA') AS ha_contig, coalesce(consensus, 0) AS consensus_segments, coalesce(several, 0) AS several, coalesce(most, 1) AS max_irma_candidate_count, coalesce(failed, 0) AS failed FROM orders LEFT JOIN x ON x.k = o_orderkey LEFT JOIN p ON p.k = o_orderkey LEFT JOIN c ON c.k = o_orderkey),
z AS (SELECT *, concat_ws(';', CASE WHEN segments_pass < 8 THEN 'fewer_than_8_pass_segments' END, CASE h5n1_screen WHEN 'DETECTED' THEN 'h5n1_screen_detected' WHEN 'INDETERMINATE' THEN 'h5n1_screen_indeterminate' END, CASE WHEN failed > 0 THEN 'coverage_failures' END,
 CASE WHEN consensus_segments = 0 THEN 'no_consensus_segments' END, CASE WHEN several > 0 THEN 'multiple_irma_candidates' END) AS flags FROM y)"""


def _summary(t):
    li, o = t("lineitem"), t("orders")
    key = F.col("l_orderkey").alias("sample")
    flag = F.when(F.col("l_returnflag") == "R", "PASS").when(F.col("l_returnflag") == "A", "FAIL").otherwise("MISSING")
    contig = F.concat(F.lit("A_"), _segment(), F.lit("_H"), F.col("l_linenumber").cast("string"))
    coverage = li.where("l_partkey % 9 < 8").select(key, _segment().alias("segment"), flag.alias("coverage_flag"), contig.alias("contig"), F.col("l_quantity").alias("median_depth"), (F.col("l_linenumber") % 3).cast("string").alias("candidate_count"))
    sample = F.col("o_orderkey").alias("sample")
    screen = o.select(sample, F.when(F.col("o_orderstatus") == "F", "not_detected").when(F.col("o_orderstatus") == "O", " PASS").otherwise("fail").alias("screen"))
    read_qc = o.select(sample, *(F.lit("NA").alias(n) for n in files.READ_QC_FIELDS))
    metadata = o.select(sample, F.col("o_orderpriority").alias("host"), F.col("o_orderstatus").alias("h5n1_screen"))
    hits = li.where("l_linenumber = 1").select(key, F.lit("HA").alias("segment"), F.col("l_suppkey").alias("top_hit"))
    genotype = o.select(sample, samples.genotype_status(F.lit("sample\tstatus\ns\tDONE\n")).alias("genoflu_status"))
    return samples.sample_summary(o.select(sample), metadata, read_qc, coverage, hits, screen, genotype, li.where("l_linenumber > 5").select(key))


@query(f"""WITH {SUMMARY} SELECT sample, host, metadata_h5n1_screen, h5n1_screen, segments_detected, segments_pass, pass_segment_names, ha_contig, consensus_segments, several AS multiple_irma_candidate_count, max_irma_candidate_count, coalesce(nullif(flags, ''), 'NONE') AS review_flags, 'DONE' AS genoflu_status FROM z""")
def sample_summary_table(t):
    return _summary(t).select("sample", "host", "metadata_h5n1_screen", "h5n1_screen", "segments_detected", "segments_pass", "pass_segment_names", "ha_contig", "consensus_segments", "multiple_irma_candidate_count", "max_irma_candidate_count", "review_flags", "genoflu_status")


@query(f"""WITH {SUMMARY}, v AS (SELECT sample, flags, segments_pass, CASE WHEN sample % 3 = 0 THEN 2 ELSE 0 END AS failed_segments, CASE WHEN sample % 3 = 0 THEN 1 ELSE 0 END AS fallback_segments, coalesce(nullif(regexp_extract(ha_contig, '^.*(H[0-9]+)', 1), ''), 'Unknown') AS ha_call FROM z)
SELECT sample AS sample_id, CASE WHEN segments_pass >= 8 THEN 'Complete' WHEN segments_pass >= 6 THEN 'Near-complete' WHEN segments_pass >= 1 THEN 'Partial' ELSE 'Failed' END AS genome_status, ha_call, failed_segments, fallback_segments, flags <> '' OR failed_segments > 0 AS review_required,
 nullif(concat_ws('; ', nullif(replace(flags, ';', '; '), ''), CASE WHEN failed_segments > 0 THEN 'Medaka: 2 failed segment(s); 1 IRMA fallback segment(s)' END), '') AS review_reason FROM v""")
def run_summary(t):
    rolled = t("orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("sample_id"), F.lit(2).alias("failed_segments"), F.lit(1).alias("fallback_segments"))
    s = _summary(t)
    old = s.where("sample % 2 = 0").drop("na_contig")
    return samples.run_summary([s.where("sample % 2 = 1"), old], rolled).select("sample_id", "genome_status", "ha_call", "failed_segments", "fallback_segments", "review_required", "review_reason")


@query("""WITH e AS (SELECT doc_id FROM documents), m AS (SELECT doc_id, quality FROM labels)
SELECT * FROM (VALUES ('expected', (SELECT count(*) FROM e)), ('rows', (SELECT count(*) FROM m)), ('matched', (SELECT count(*) FROM e JOIN m USING (doc_id))), ('missing', (SELECT count(*) FROM e ANTI JOIN m USING (doc_id))),
 ('warnings', (SELECT count(*) FROM m ANTI JOIN e USING (doc_id)) + (SELECT (count(*) > 0)::INT FROM e ANTI JOIN m USING (doc_id))), ('errors', (SELECT count(*) FROM m WHERE quality = 0))) v(name, value)""")
def validate_metadata(t):
    meta = t("labels").select("doc_id", F.col("doc_id").alias("line"), F.when(F.col("quality") == 0, "2026-02-30").otherwise("2026-02-28").alias("collected"))
    return samples.validate_metadata(meta, t("documents").select("doc_id"), ["collected"], "doc_id", dates=("collected",))[2]


@query("""SELECT o_custkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) THEN 'both' ELSE 'left' END AS side FROM (SELECT DISTINCT o_custkey FROM orders)
 UNION ALL SELECT c_custkey, 'right' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def key_sets(t):
    return samples.key_sets(t("orders"), t("customer").where("c_custkey % 2 = 0").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")


@query("""WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders), c AS (SELECT least(floor((o_totalprice - lo) / (hi - lo) * 30) + 1, 30)::BIGINT AS bin, count(*) AS n FROM orders, e GROUP BY 1)
SELECT r.range AS bin, coalesce(n, 0) AS n FROM range(1, 31) r LEFT JOIN c ON c.bin = r.range""")
def equal_bins(t):
    return samples.equal_bins(t("orders"), "o_totalprice").select("bin", "n")


@query("SELECT string_agg(x, ', ' ORDER BY x) AS \"values\" FROM (SELECT DISTINCT c_mktsegment AS x FROM customer)")
def populated_values(t):
    return samples.populated_values(t("customer").withColumn("empty", F.lit(" unknown ")), ["absent", "empty", "c_mktsegment", "c_name"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def order_by_count(t):
    return ranking.order_by_count(t("events"), "event_type")


@query("SELECT user_id, min_by(props, event_id) FILTER (event_type = 'error') AS props FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'error' AND props IS NOT NULL) > 0")
def first_match(t):
    return ranking.first_match(t("events").withColumn("props", F.when(F.col("event_type") == "error", F.col("props"))), ["user_id"], ["event_id"], "props")


@query("""SELECT l_orderkey, '{"thresholds":{"depth":50.0},"segments":[' || string_agg('{"segment":"' || s || '","q":' || q || '}', ',' ORDER BY list_position(['PB2', 'PB1', 'PA', 'HA', 'NP', 'NA', 'MP', 'NS'], s)) || ']}' AS payload
 FROM (SELECT l_orderkey, ['PB2', 'PB1', 'PA', 'HA', 'NP', 'NA', 'MP', 'NS'][l_linenumber::INT] AS s, l_quantity::BIGINT AS q FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1) GROUP BY 1""")
def segment_payload(t):
    segment = F.element_at(F.array(*map(F.lit, E.REPORT_ORDER)), F.col("l_linenumber").cast("int"))
    one = ranking.first_by(t("lineitem"), ["l_orderkey", "l_linenumber"], [F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_quantity")])
    return samples.segment_payload(one.select("l_orderkey", segment.alias("segment"), F.col("l_quantity").cast("long").alias("q")), "l_orderkey", {"depth": 50.0}, ["q"])


@query("""SELECT s_suppkey, '{"parameters":{"name":"' || s_name || '","q":30},"files":' || f || ',"database":null}' AS document FROM supplier JOIN
 (SELECT ps AS k, '{' || string_agg('"' || name || '":{"sha256":"' || sha256(name) || '","checksum_status":"MATCH"}', ',' ORDER BY name) || '}' AS f FROM (SELECT DISTINCT l_suppkey AS ps, l_shipdate::VARCHAR AS name FROM lineitem WHERE l_linenumber = 1) GROUP BY 1) ON k = s_suppkey""")
def provenance(t):
    f = t("lineitem").where("l_linenumber = 1").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").cast("string").alias("name")).distinct()
    f = f.select("s_suppkey", "name", F.sha2("name", 256).alias("sha256"), F.lit("MATCH").alias("checksum_status"))
    params = t("supplier").join(f.select("s_suppkey").distinct(), "s_suppkey").select("s_suppkey", F.col("s_name").alias("name"), F.lit(30).alias("q"))
    return samples.provenance(params, f, t("supplier").where("false").select("s_suppkey", F.lit("v").alias("version")), "s_suppkey")


@query("""WITH v AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'SKIPPED_QC' END AS v, CASE WHEN o_orderkey % 2 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS i FROM orders), c AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY 1)
SELECT o_orderkey, CASE v WHEN 'SUCCESS' THEN CASE WHEN n IS NULL THEN 'No variants called' ELSE n || ' variant(s)' END WHEN 'SKIPPED_QC' THEN 'Not run: segment QC' ELSE CASE i WHEN 'FAILED' THEN 'Failed: inference' ELSE 'Failed: variant calling' END END AS variants FROM v LEFT JOIN c ON l_orderkey = o_orderkey""")
def variant_table(t):
    wide = t("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "FAILED").otherwise("SKIPPED_QC").alias("variant_status"),
        F.when(F.col("o_orderkey") % 2 == 0, "FAILED").otherwise("SUCCESS").alias("inference_status"), F.lit("MEDAKA").alias("consensus_source"), F.lit("").alias("variant_reason"))
    counts = samples.record_counts(t("lineitem").where("l_linenumber > 2").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return samples.variant_table(wide, counts, ["o_orderkey"]).select("o_orderkey", "variants")
