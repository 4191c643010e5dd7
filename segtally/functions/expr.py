"""Column helpers: all native expressions, no UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The closed vocabularies of sequencing-run QC.
SEGMENTS = ["HA", "NA", "PB2", "PB1", "PA", "NP", "MP", "NS"]
REPORT_ORDER = ["PB2", "PB1", "PA", "HA", "NP", "NA", "MP", "NS"]
TRUE_WORDS = ["true", "yes", "y", "1", "on"]
UNKNOWN_WORDS = ["", "NA", "N/A", "NONE", "NO_HIT", "UNDETERMINED"]


def strip(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def parse_bool(c: Column, run_level: bool = False) -> Column:
    """Whether the text is a word for true; run tables know ``t`` too."""
    return F.lower(clean(c)).isin([*TRUE_WORDS, "t"] if run_level else TRUE_WORDS)


def first_nonempty(*cs: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cs), F.lit(""))


def valid_iso_date(c: Column) -> Column:
    c = clean(c)
    return (c == "") | (c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull())


def valid_coordinate(c: Column, lo: float, hi: float) -> Column:
    c = clean(c)
    number = F.when(c.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), c.try_cast("double"))
    return (c == "") | F.coalesce(number.between(lo, hi), F.lit(False))


def normalize_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def segment_of_contig(c: Column) -> Column:
    return F.nullif(F.coalesce(F.nullif(F.regexp_extract(c, r"^A_(HA|NA)", 1), F.lit("")), F.regexp_extract(c, r"^A_(PB2|PB1|PA|NP|MP|NS)(?:_.*)?$", 1)), F.lit(""))


def segment_of_token(c: Column) -> Column:
    return first_nonempty(F.regexp_extract(c, rf"(?:^|_)({'|'.join(SEGMENTS)})$", 1), c)


def segment_of_group(c: Column) -> Column:
    names = F.create_map(*(F.lit(x) for i, s in enumerate(["PB2", "PB1", "PA", "HA", "NP", "NA", "MP", "NS"], 1) for x in (f"fluA-seg{i}", s)))
    return F.coalesce(names[c], c)


def seq_stats(seq: Column) -> list[Column]:
    n = F.regexp_count(seq, F.lit("N"))
    return [F.length(seq).alias("consensus_length"), n.alias("n_count"), F.coalesce(F.try_divide(n, F.length(seq)), F.lit(0.0)).alias("n_fraction")]


def length_status(n: Column, lo: Column, hi: Column) -> Column:
    return F.when(n < lo, "FAIL").when(n > hi, "WARNING").otherwise("PASS")


def n_status(fraction: Column, most: float) -> Column:
    return F.when(fraction <= most, "PASS").otherwise("FAIL")


def coverage_status(median: Column, breadth: Column, depth: float, least: float) -> Column:
    return F.when((median >= depth) & (breadth >= least), "PASS").otherwise("FAIL")


def segment_states(present: Column, error: Column, depth_error: Column, positions: Column, coverage: Column, length: Column, n: Column) -> dict[str, Column]:
    """The four statuses of a segment. Inputs that are not there, then a broken sequence, then broken depths, then no positions decide before the measures do."""
    no_depth = F.coalesce(positions, F.lit(0)) == 0
    good = (coverage == "PASS") & length.isin("PASS", "WARNING") & (n == "PASS")
    either = lambda measured: F.when(~present, "MISSING").when(error, "ERROR").otherwise(measured)
    return {
        "coverage_status": F.when(~present, "MISSING").when(error, "NA").when(depth_error, "ERROR").when(no_depth, "MISSING").otherwise(coverage),
        "length_status": either(length), "n_content_status": either(n),
        "status": either(F.when(depth_error, "ERROR").when(no_depth, "MISSING").when(good, "PASS").otherwise("FAIL")),
    }


def segment_status(present: Column, error: Column, positions: Column, coverage: Column, length: Column, n: Column) -> Column:
    return segment_states(present, error, F.lit(False), positions, coverage, length, n)["status"]


def query_coverage(aligned: Column, query: Column) -> Column:
    return F.when(query <= 0, F.raise_error(F.lit("query length must be positive"))).otherwise(100.0 * aligned / query)


def hit_status(identity: Column, coverage: Column, least_identity: float, least_coverage: float) -> Column:
    return F.when((identity >= least_identity) & (coverage >= least_coverage), "HIGH_CONFIDENCE").otherwise("LOW_CONFIDENCE")


def normalize_screen(c: Column, strict: bool = False) -> Column:
    c = F.upper(clean(c))
    known = F.when(c == "PASS", "DETECTED").when(c == "FAIL", "INDETERMINATE").when(c.isin("DETECTED", "NOT_DETECTED", "INDETERMINATE"), c)
    return F.coalesce(known, F.lit("INDETERMINATE") if strict else F.when(c == "", "MISSING").otherwise(c))


def normalize_unknown(c: Column) -> Column:
    return F.when(F.upper(clean(c)).isin(UNKNOWN_WORDS), "Unknown").otherwise(strip(c))


def extract_subtype(c: Column, prefix: str) -> Column:
    return F.nullif(F.upper(F.regexp_extract(c, rf"(?is)^.*({prefix}[0-9]+)", 1)), F.lit(""))


def compose_subtype(h: Column, n: Column) -> Column:
    return F.coalesce(F.concat(h, n), h, n, F.lit("Undetermined"))


def genome_status(n: Column, full: int = 8) -> Column:
    return F.when(n >= full, "Complete").when(n >= full - 2, "Near-complete").when(n >= 1, "Partial").otherwise("Failed")


def display_alias(*cs: Column) -> Column:
    return F.coalesce(*(F.when(~F.upper(clean(c)).isin("", "UNKNOWN"), strip(c)) for c in cs), F.lit("Unknown"))


def review_flags(pass_n: Column, screen: Column, failed: Column, consensus: Column, multiple: Column) -> Column:
    flags = F.array(
        F.when(pass_n < 8, "fewer_than_8_pass_segments"), F.when(screen == "DETECTED", "h5n1_screen_detected"), F.when(screen == "INDETERMINATE", "h5n1_screen_indeterminate"),
        F.when(failed > 0, "coverage_failures"), F.when(consensus == 0, "no_consensus_segments"), F.when(multiple > 0, "multiple_irma_candidates"),
    )
    return first_nonempty(F.array_join(F.array_compact(flags), ";"), F.lit("NONE"))


def selectors(model: Column) -> list[Column]:
    """The consensus and variant selectors of a model; null without one."""
    return [F.concat(model, F.lit(f":{kind}")).alias(f"{kind}_selector") for kind in ("consensus", "variant")]


def header_value(c: Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf"(?:^|\s){key}=(\S+)", 1), F.lit(""))


def retention_changes(before: Column, after: Column, rate_before: Column, rate_after: Column, adapters: Column) -> list[Column]:
    """Change of a rate in percentage points, and the share of reads with adapters (null if unknown)."""
    return [*retention(before, after), (100 * (rate_after - rate_before)).alias("rate_points"), F.try_divide(adapters, before).alias("adapter_fraction")]


def retention(before: Column, after: Column) -> list[Column]:
    return [F.greatest(before - after, F.lit(0)).alias("removed"), F.coalesce(F.try_divide(after, before), F.lit(0.0)).alias("retained")]


def link(c: Column, base: str) -> Column:
    return F.when(F.upper(clean(c)).isin("", "NO_HIT", "NONE", "NA"), None).otherwise(F.concat(F.lit(base), F.url_encode(c)))


def format_fixed(c: Column, digits: int) -> Column:
    """Text with fixed decimals, for sinks only."""
    return F.format_string(f"%.{digits}f", c.cast("double"))


def format_general(c: Column, digits: int = 6) -> Column:
    """Text with ``digits`` significant digits, the shorter of fixed and scientific form, for sinks only."""
    x = c.cast("double")
    science = F.format_string(f"%.{digits - 1}e", x)
    power = F.regexp_extract(science, r"e([+-]\d+)$", 1).cast("int")
    fixed = reduce(lambda out, k: out.when(power == k, F.format_string(f"%.{digits - 1 - k}f", x)), range(-3, digits), F.when(power == -4, F.format_string(f"%.{digits + 3}f", x)))
    short = F.coalesce(fixed, science)
    return F.when(x == 0, "0").otherwise(F.regexp_replace(F.regexp_replace(short, r"(\.\d*?)0+(?=e|$)", "$1"), r"\.(?=e|$)", ""))


def mean_quality(quality: Column) -> Column:
    """Arithmetic mean of Phred+33 values."""
    total = F.aggregate(F.transform(F.filter(F.split(quality, ""), lambda x: x != ""), lambda x: F.ascii(x) - 33), F.lit(0), lambda a, x: a + x)
    return F.try_divide(total, F.length(quality))


def matches(c: Column, pattern: str) -> Column:
    """Whether the whole text matches, upper or lower case."""
    return c.rlike(f"(?i)^(?:{pattern})$")


def segment_of_path(path: Column, suffix: str) -> Column:
    """File name without the suffix, or without its last extension where it has another."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(name.endswith(suffix), F.regexp_replace(name, rf"\Q{suffix}\E$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def min_nullsafe(a: Column, b: Column) -> Column:
    return F.least(a, b)


def selection_reason(count: Column, fasta: Column, bam: Column, median: Column) -> Column:
    have = F.when(fasta & bam, "FASTA+BAM pair available").when(fasta, "FASTA only").when(bam, "BAM only")
    depth = F.coalesce(F.concat(F.lit("median depth="), F.regexp_replace(median.cast("string"), r"\.0$", "")), F.lit("no parseable coverage table"))
    return F.concat_ws("; ", F.concat(F.lit("selected from "), count, F.lit(" candidate(s)")), have, depth)


def qc_reason(status: Column, depth: float, breadth: float, most_n: float) -> Column:
    """Why a segment has its status."""
    rule = f"PASS asks for median depth >= {depth:.2f}, breadth >= {breadth:.3f}, N fraction <= {most_n:.4f} and a length in its bounds"
    return F.when(status == "MISSING", "inputs or reference positions are missing").when(status == "ERROR", "an input could not be read").otherwise(rule)


def screen_reason(name: str, flag: Column, contig: Column) -> Column:
    """Why one side of a screen says nothing; null if it does."""
    bad = F.coalesce(flag, F.lit("MISSING"))
    return F.when(bad != "PASS", F.concat(F.lit(f"{name} QC="), bad)).when(F.upper(clean(contig)).isin("", "NA", "MISSING"), f"{name} contig unavailable")
