"""How many shuffles a plan has."""

from pyspark.sql import functions as F

from segtally.operators import ranking, stages


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_limit_hits_is_dealt_once(spark):
    hits = spark.range(100).select((F.col("id") % 7).alias("q"), (F.col("id") % 5).alias("s"), "id")
    assert exchanges(ranking.limit_hits(hits, ["q"], "s", [F.desc("id")], 1, 3)) == 1


def test_an_assembly_is_not_joined_to_itself(spark):
    a = spark.range(40).selectExpr("concat('s', id % 3) AS sample", "concat('c', id % 5) AS contig", "'HA' AS segment", "'bam' AS kind", "cast(id AS string) AS path", "id AS bytes", "cast(id AS double) AS coverage_median", "id AS fasta_length")
    plan = stages.normalize_assembly(a, None, None, a.select("sample"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1  # the grid of all segments
