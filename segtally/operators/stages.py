"""Stages of polishing and calling: their status by what came before, and the sequences that stand in the end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segtally.functions import expr as E

Case = tuple[Column, str, str, str]


def _pick(cases: list[Case], last: tuple[str, str, str], soft: bool) -> list[Column]:
    """status, source, reason of the first case that holds, else of ``last``; without soft a FAILED raises its reason."""
    pick = lambda i: F.coalesce(*(F.when(c[0], c[1 + i]) for c in cases), F.lit(last[i]))
    status = pick(0) if soft else F.when(pick(0) == "FAILED", F.raise_error(pick(2))).otherwise(pick(0))
    return [status.alias("status"), pick(1).alias("source"), pick(2).alias("reason")]


def gate(flag: Column) -> Column:
    """Whether a segment may go on: its flag is PASS and nothing else, not even null."""
    return F.coalesce(flag, F.lit("")) == "PASS"


def resolve_model(detected: Column, override: str | None) -> list[Column]:
    """model, model_source and model_status: the configured model, else the one found in the reads; FAILED without either."""
    model = F.lit(override) if override else E.clean(detected)
    source = "config override" if override else "FASTQ metadata"
    return [model.alias("model"), F.lit(source).alias("model_source"), F.when(model == "", "FAILED").otherwise("RESOLVED").alias("model_status")]


def inference_status(flag: Column, ok: Column, soft: bool = True) -> list[Column]:
    """ok: the tool ended well and its output is not empty."""
    cases = [(~gate(flag), "SKIPPED_QC", "NONE", "segment_qc_failed"), (F.coalesce(ok, F.lit(False)), "SUCCESS", "NONE", "inference_completed")]
    return _pick(cases, ("FAILED", "NONE", "medaka_inference_failed"), soft)


def consensus_status(flag: Column, inference: Column, ok: Column, soft: bool = True, features: Column | None = None) -> list[Column]:
    """What polishing ends with; a failure falls back to the draft. features: whether the inference left any (as a success does)."""
    ran = (inference == "SUCCESS") & (F.lit(True) if features is None else F.coalesce(features, F.lit(False)))
    cases = [
        (~gate(flag), "SKIPPED_QC", "NONE", "segment_qc_failed"), (inference == "SKIPPED_QC", "SKIPPED_QC", "NONE", "inference_skipped_qc"),
        (inference == "FAILED", "FAILED", "IRMA_FALLBACK", "medaka_inference_failed"), (ran & F.coalesce(ok, F.lit(False)), "SUCCESS", "MEDAKA", "polishing_completed"),
        (ran, "FAILED", "IRMA_FALLBACK", "medaka_consensus_failed"),
    ]
    return _pick(cases, ("FAILED", "IRMA_FALLBACK", "invalid_inference_state"), soft)


def variant_status(flag: Column, inference: Column, ran_well: Column, found: Column, soft: bool = True, features: Column | None = None) -> list[Column]:
    """ran_well: the caller ended well; found: it left a variant file that is not empty. A failed inference is passed on and raises nothing here."""
    ran = (inference == "SUCCESS") & (F.lit(True) if features is None else F.coalesce(features, F.lit(False)))
    well, some = F.coalesce(ran_well, F.lit(False)), F.coalesce(found, F.lit(False))
    before = [
        (~gate(flag), "SKIPPED_QC", "NONE", "segment_qc_failed"), (inference == "SKIPPED_QC", "SKIPPED_QC", "NONE", "inference_skipped_qc"),
        (inference == "FAILED", "FAILED", "NONE", "medaka_inference_failed"), (ran & well & some, "SUCCESS", "NONE", "vcf_generated"),
    ]
    last = F.when(ran & well, "medaka_vcf_empty_output").when(ran, "medaka_vcf_failed").otherwise("invalid_inference_output")
    status, source, reason = _pick(before, ("FAILED", "NONE", ""), True)
    reason = F.coalesce(F.nullif(reason, F.lit("")), last)
    own_failure = (status == "FAILED") & ~F.coalesce(inference == "FAILED", F.lit(False))
    status = status if soft else F.when(own_failure, F.raise_error(reason)).otherwise(status)
    return [status.alias("status"), source.alias("source"), reason.alias("reason")]


def variant_display(variant: Column, inference: Column, records: Column) -> Column:
    """What a sample report shows for the variants of a segment."""
    n = F.coalesce(records, F.lit(0))
    return (
        F.when(variant == "SUCCESS", F.when(n == 0, "No variants called").otherwise(F.concat(n.cast("string"), F.lit(" variant(s)"))))
        .when(variant == "SKIPPED_QC", "Not run: segment QC").when((variant == "FAILED") & (inference == "FAILED"), "Failed: inference").when(variant == "FAILED", "Failed: variant calling").otherwise("Not recorded")
    )


def consensus_set(draft: DataFrame, polished: DataFrame, status: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sequence, source: of what passed QC the polished sequence, or the draft where polishing fell back; empty ones are left out.

    draft and polished: keys, sequence; status: keys, status, source.
    """
    s = status.where("source in ('MEDAKA', 'IRMA_FALLBACK')").select(*keys, "source")
    j = s.join(draft.select(*keys, F.col("sequence").alias("_draft")), keys, "left").join(polished.select(*keys, F.col("sequence").alias("_polished")), keys, "left")
    sequence = F.when(F.col("source") == "MEDAKA", F.col("_polished")).otherwise(F.col("_draft"))
    return j.select(*keys, sequence.alias("sequence"), "source").where("sequence != ''")


def route_by_screen(screen: DataFrame, status: str = "screen") -> tuple[DataFrame, DataFrame]:
    """Samples that go on to genotyping, and the others with their ``genotype_status``; an unknown status raises."""
    known = F.when(F.col(status).isin("DETECTED", "NOT_DETECTED", "INDETERMINATE"), F.col(status)).otherwise(F.raise_error(F.concat(F.lit("unexpected screen status: "), F.coalesce(status, F.lit("null")))))
    rows = screen.withColumn(status, known)
    return rows.where(F.col(status) == "DETECTED"), rows.where(F.col(status) != "DETECTED").withColumn("genotype_status", F.concat(F.lit("H5N1_"), status))


def ready_segments(manifest: DataFrame, key: str = "sample") -> DataFrame:
    """key, ready_n and ready_names (in canonical order, NONE without any) of every sample of a manifest (segment, status, fasta_bytes, bam_bytes)."""
    names = F.array(*map(F.lit, E.SEGMENTS))
    ready = (F.col("status") == "READY") & F.col("segment").isin(E.SEGMENTS) & (F.coalesce("fasta_bytes", F.lit(0)) > 0) & (F.coalesce("bam_bytes", F.lit(0)) > 0)
    g = manifest.groupBy(key).agg(F.collect_set(F.when(ready, F.col("segment"))).alias("_s"))  # eight at most
    return g.select(key, F.size("_s").cast("long").alias("ready_n"), E.first_nonempty(F.array_join(F.array_intersect(names, F.col("_s")), ","), F.lit("NONE")).alias("ready_names"))


def ordered(df: DataFrame, segment: str = "segment", report: bool = False, name: str = "ord") -> DataFrame:
    """df with the place of its segment in the pipeline's or the report's order; 99 for unknown ones."""
    order = E.REPORT_ORDER if report else E.SEGMENTS
    at = F.array_position(F.array(*map(F.lit, order)), F.coalesce(F.col(segment), F.lit("")))
    return df.withColumn(name, F.when(at > 0, at).otherwise(99).cast("int"))


def normalize_assembly(artifacts: DataFrame, medians: DataFrame | None, lengths: DataFrame | None, samples: DataFrame) -> DataFrame:
    """The manifest: one row for each sample and segment, with the chosen candidate.

    artifacts: sample, contig, segment, kind (fasta, bam, coverage), path, bytes;
    medians: path, coverage_median; lengths: path, fasta_length; each may be None where
    the artifacts carry its column already, which spares a join by path; samples: sample.
    Of files of one contig and kind the first path counts, the others are alternates.
    """
    a = reduce(lambda x, y: x.join(y, "path", "left"), (x for x in (medians, lengths) if x is not None), artifacts)
    of = lambda kind, c: F.min_by(F.when(F.col("kind") == kind, F.col(c)), F.when(F.col("kind") == kind, F.col("path")))
    first = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("path")))
    c = a.groupBy("sample", "segment", "contig").agg(
        first("fasta").alias("fasta"), first("bam").alias("bam"), first("coverage").alias("coverage_table"), of("bam", "bytes").alias("bam_bytes"), of("fasta", "bytes").alias("fasta_bytes"),
        F.coalesce(of("fasta", "fasta_length"), F.lit(0)).cast("long").alias("fasta_length"), of("coverage", "coverage_median").alias("coverage_median"), F.array_sort(F.collect_list("path")).alias("_paths"))
    c = c.withColumn("alternates", F.filter("_paths", lambda p: ~F.coalesce(p.eqNullSafe(F.col("fasta")) | p.eqNullSafe(F.col("bam")) | p.eqNullSafe(F.col("coverage_table")), F.lit(False)))).drop("_paths")
    has = lambda x: F.col(x).isNotNull()
    # descending numbers are negated, so that one minimum takes the best candidate and, of equal ones, the first contig
    rank = F.struct(
        ~(has("fasta") & has("bam")), F.col("coverage_median").isNull(), -F.coalesce("coverage_median", F.lit(-1.0)), -F.coalesce("bam_bytes", F.lit(0)), -F.col("fasta_length"), F.col("contig"))
    everything = F.struct(*(x for x in c.columns if x not in ("sample", "segment")))
    chosen = c.groupBy("sample", "segment").agg(F.count("*").alias("candidate_count"), F.min_by(everything, rank).alias("c"))
    grid = samples.select("sample").distinct().withColumn("segment", F.explode(F.array(*map(F.lit, E.SEGMENTS))))
    m = grid.join(chosen, ["sample", "segment"], "left").select("sample", "segment", F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"), "c.*")
    n = F.col("candidate_count")
    status = F.when(has("fasta") & has("bam"), "READY").when(has("fasta"), "FASTA_ONLY").when(has("bam"), "BAM_ONLY").otherwise("MISSING")
    reason = F.when(n == 0, "no segment-specific FASTA or BAM found").otherwise(E.selection_reason(n.cast("string"), has("fasta"), has("bam"), F.col("coverage_median")))
    return m.withColumns({
        "status": status, "selection_status": F.when(n == 0, "MISSING").when(n > 1, "MULTIPLE_CANDIDATES").otherwise("UNIQUE"), "selection_reason": reason, "fasta_length": F.coalesce("fasta_length", F.lit(0).cast("long")),
    })
