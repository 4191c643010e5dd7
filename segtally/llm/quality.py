"""Quality classifier by importance resampling.

Two kinds of raw text stand against the target text: documents labelled of low
quality, and toxic ones. Each of the three is a generative model of hashed
n-grams: words and runs of signs, pairs of them, beginnings of words of 4, 6 and 8
letters (a word family is seen by its stem), the share of words that only repeat the
one before, and the share of words in capitals. A document's log weight is the sum over its distinct n-grams of
log target/raw, the smaller of the two. Ratios are pulled to 0 by ``SURE``
standard errors and left out under ``LEAST``, so n-grams seen a few times say
nothing. A margin is added, the same for every length: the least that keeps ``KEEP``
of the good labelled documents, each weighed by models fitted without its fold;
copies of a text are one document there.
The documents kept are the Gumbel top-k of the log weights, k being the number of
documents whose weight is over 1. Keys carry the noise of a hash of the id at full
scale, so reruns agree; rows of one id and text are drawn alike.

The models are fitted on at most ``sample`` labelled documents (a documented
bound; the smallest hashes of their ids are taken) and hold 2^19 buckets; all
documents are scored by their whole text. The k-th key is found by narrowing
histograms, never by sorting all rows in one task.

Defined cases: null and "" have no n-grams and weigh as the labels' odds do;
labels that are null or contradict each other count as the worst of them; without
labels of one kind that kind's models say nothing; rows with the key of the last
one selected are selected with it; repeated rows are scored alike; a text of any
length is one row of one task, which holds about forty times its bytes; an empty
table gives an empty table; other columns come through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import _ALNUM, _LOWER, _WS, _spans, blocks, cut, free_name, hashes, mix

BITS = 20
BEGINNINGS = (4, 6, 8)
SURE, LEAST = 2.5, 1.5
#: Labelled documents that the models are fitted on, at most.
SAMPLE = 20_000
#: Good labelled documents that the margin keeps, and folds that it is found on.
KEEP, FOLDS = 0.99, 4
TEMPERATURE = 1.0


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each distinct n-gram of each row."""
    low = _LOWER[raw]
    word = _ALNUM[low]
    a, b = _spans(word, offsets), _spans(~word & ~_WS[low], offsets)
    s, e = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(s, kind="stable")
    s, e = s[order], e[order]
    row = np.searchsorted(offsets, s, "right") - 1
    h = hashes(low, s, e)
    same = row[:-1] == row[1:]
    pair = mix(h[:-1] * np.uint64(3) + h[1:])
    n = len(offsets) - 1
    repeats = np.bincount(row[:-1][same & (h[:-1] == h[1:])], minlength=n)
    large = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    capitals = np.bincount(row[large[e] - large[s] > 1], minlength=n)
    grams, rows = [h, pair[same]], [row, row[:-1][same]]
    for seed, count in ((77, repeats), (177, capitals)):
        share = -(-8 * count // np.maximum(1, np.bincount(row, minlength=n)))
        grams.append(mix(share[share > 0].astype(np.uint64) + np.uint64(seed)))
        rows.append(np.flatnonzero(share))
    for k in BEGINNINGS:
        long = np.flatnonzero(e - s >= k)
        grams.append(mix(hashes(low, s[long], s[long] + k) + np.uint64(k)))
        rows.append(row[long])
    u = np.sort((np.concatenate(rows).astype(np.int64) << BITS) | (np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64))
    u = u[np.concatenate([[True], u[1:] != u[:-1]])] if len(u) else u
    return u >> BITS, u & ((1 << BITS) - 1)


def ratios_of(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log ratios of some buckets, 2 x their number, from their counts by kind and the documents of each kind."""
    seen = counts + 0.5
    ratios = np.zeros((2, counts.shape[1]), np.float32)
    for k in (1, 2):
        if n[0] and n[k]:
            r = np.log(seen[0] / n[0]) - np.log(seen[k] / n[k])
            r = np.sign(r) * np.maximum(0, np.abs(r) - SURE * np.sqrt(1 / seen[0] + 1 / seen[k]))
            ratios[k - 1] = np.where(np.abs(r) < LEAST, 0, r)
    return ratios


def odds_of(n: np.ndarray) -> np.ndarray:
    """Log odds of the labels, 2."""
    return np.array([np.log(n[0] / n[k]) if n[0] and n[k] else 50.0 for k in (1, 2)])


def dense(model: tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ratios, 2 x 2^BITS, and odds of a model that holds (row, buckets, ratios that are not 0)."""
    ratios = np.zeros((2, 1 << BITS), np.float32)
    for row, at, r in model[0]:
        ratios[row, at] = r
    return ratios, model[1]


def weigh(row: np.ndarray, bucket: np.ndarray, n_rows: int, ratios: np.ndarray, odds: np.ndarray) -> np.ndarray:
    return np.min([np.bincount(row, weights=ratios[k][bucket], minlength=n_rows) + odds[k] for k in (0, 1)], axis=0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
    """The log ratios that are not 0 (row, buckets, ratios), and the log odds of the labels with the margin, 2."""
    worst = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    chosen = worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", F.when(F.col("t") == 1, 2).when(F.col("q") == 1, 0).otherwise(1).alias("kind"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    # copies count once, and stand in one fold: a group of them would make its rare words look sure
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("kind", F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int").alias("fold"), text.alias("same"), "text").dropDuplicates(["kind", "same"]).select("kind", "fold", "text")
    chunk = BITS - 4

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((3 * FOLDS, 1 << BITS), np.int32), np.zeros(3 * FOLDS, np.int64)
        for batch, raw, offsets in blocks(batches):
            kind = batch.column("kind").to_numpy() * FOLDS + batch.column("fold").to_numpy()
            row, bucket = features(raw, offsets)
            for k in np.unique(kind):
                n[k] += (kind == k).sum()
                total[k] += np.bincount(bucket[kind[row] == k], minlength=1 << BITS).astype(np.int32)
        out = []
        for k in np.flatnonzero(n):
            at = np.flatnonzero(total[k]).astype(np.int32)
            for c in range(16):
                part = at[(at >> chunk) == c]
                out.append((c, k, part.tobytes(), total[k][part].tobytes(), n[k]))
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out) if out else [()] * 5, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], ["part", "k", "at", "n", "docs"])

    # the counts stay a table, a sixteenth of the buckets a part; only ratios that are not 0 come to the driver
    parts = cut(labelled.mapInArrow(count, "part int, k int, at binary, n binary, docs long"))
    n = np.zeros(3 * FOLDS)
    for r in parts.where("part = 0").groupBy("k").agg(F.sum("docs").alias("docs")).collect():
        n[r.k] = r.docs
    n = n.reshape(3, FOLDS)
    left = [n.sum(axis=1), *(n.sum(axis=1) - n[:, f] for f in range(FOLDS))]  # documents of all folds, and of all but one

    def fitted(t: pa.Table) -> pa.Table:
        total = np.zeros((3 * FOLDS, 1 << chunk), np.int32)
        for k, at, m in zip(t["k"].to_pylist(), t["at"], t["n"]):
            total[k, np.frombuffer(at.as_py(), np.int32) & ((1 << chunk) - 1)] += np.frombuffer(m.as_py(), np.int32)
        total, first, out = total.reshape(3, FOLDS, -1), t["part"][0].as_py() << chunk, []
        whole = total.sum(axis=1, dtype=np.int32)
        for model, docs in enumerate(left):
            ratios = ratios_of(whole - total[:, model - 1] if model else whole, docs)
            for row in (0, 1):
                at = np.flatnonzero(ratios[row])
                out.append((model, row, (at + first).astype(np.int32).tobytes(), ratios[row, at].tobytes()))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["model", "row", "at", "ratios"])

    models = [([], odds_of(docs)) for docs in left]
    for r in parts.groupBy("part").applyInArrow(fitted, "model int, row int, at binary, ratios binary").toLocalIterator():
        models[r.model][0].append((r.row, np.frombuffer(r.at, np.int32), np.frombuffer(r.ratios, np.float32)))
    whole, odds = models[0]
    if not left[0][0]:
        return whole, odds
    without = docs.sparkSession.sparkContext.broadcast(models[1:])

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds = [dense(m) for m in without.value]
        for batch, raw, offsets in blocks(batches):
            row, bucket = features(raw, offsets)
            w = np.array([weigh(row, bucket, batch.num_rows, *model) for model in folds])
            yield pa.RecordBatch.from_arrays([pa.array(w[batch.column("fold").to_numpy(), np.arange(batch.num_rows)])], ["w"])

    weights = labelled.where("kind = 0").mapInArrow(held_out, "w double").toArrow()["w"].to_numpy()  # a number a document of the sample
    without.unpersist()
    return whole, odds + max(0.0, -np.quantile(weights, 1 - KEEP))


def kth_largest(rows: DataFrame, key: str, k: int, bins: int = 1024, small: int = 50_000) -> float | None:
    """The k-th largest value of key; None if k is 0 or there are fewer. Rows are read several times: cut them before."""
    col, (lo, hi, n) = F.col(key), rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not 0 < k <= n:
        return None
    inside, need = F.lit(True), k
    while n > small and hi > lo:
        bin_: Column = F.least(F.floor((col - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1))
        found = {r.b: r for r in rows.where(inside).groupBy(bin_.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}  # one row a bin
        at = next(b for b in sorted(found, reverse=True) if (need := need - found[b].n) <= 0)
        need, inside = need + found[at].n, inside & (col >= found[at].lo) & (col <= found[at].hi)
        if (found[at].lo, found[at].hi, found[at].n) == (lo, hi, n):
            break  # values a rounding apart
        lo, hi, n = found[at].lo, found[at].hi, found[at].n
    if hi == lo or n > small:
        return lo
    return rows.where(inside).orderBy(F.desc(key)).limit(need).agg(F.min(key)).first()[0]


def top_k(rows: DataFrame, key: str, k: int, bins: int = 1024, small: int = 50_000) -> DataFrame:
    """rows with ``selected`` for the k largest keys, and for all that equal the last of them."""
    last = kth_largest(rows, key, min(k, rows.count()), bins, small)
    return rows.withColumn("selected", F.lit(False) if last is None else F.coalesce(F.col(key) >= F.lit(last), F.lit(False)))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text_hash, n_grams, log_weight, gumbel_key of every row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, o = dense(model.value)
        for batch, raw, offsets in blocks(batches):
            row, bucket = features(raw, offsets)
            n = np.bincount(row, minlength=len(offsets) - 1)
            w = weigh(row, bucket, len(n), r, o)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(w)], ["doc_id", "text_hash", "n_grams", "log_weight"])

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").mapInArrow(run, f"doc_id {kind}, text_hash long, n_grams long, log_weight double")
    u = (F.xxhash64(F.col("doc_id"), F.lit("gumbel")).bitwiseAND((1 << 52) - 1).cast("double") + 0.5) / float(1 << 52)
    return scored.withColumn("gumbel_key", F.col("log_weight") - TEMPERATURE * F.log(-F.log(u)))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """score() with ``selected``: the Gumbel top-k."""
    rows = cut(score(docs, labels, sample).drop("text_hash"))
    return top_k(rows, "gumbel_key", rows.where("log_weight > 0").count())


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are selected, with all their columns; rows of one id stand or fall by their own texts."""
    key, text, own = (free_name(n, docs.columns) for n in ("_key", "_text", "_own"))
    rows = docs.withColumn(text, F.xxhash64(F.coalesce("text", F.lit(""))))
    scored = cut(score(docs, labels, sample))
    out = top_k(scored, "gumbel_key", scored.where("log_weight > 0").count()).where("selected").select(F.col("doc_id").alias(key), F.col("text_hash").alias(own)).distinct()
    return rows.join(out, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(text) == F.col(own)), "left_semi").drop(text)
