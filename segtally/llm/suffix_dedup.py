"""Suffix-array dedup: every byte of a repeated 100-byte string but its first place goes.

The index is sparse: of all suffixes only anchors are indexed. An anchor is the
place of the smallest hash of ``CORE`` bytes in some 100-byte window, so equal
windows have their anchor at the same place, and every window has one: no match
of 100 bytes can miss the index. Each block of documents gets its own sorted array
of anchors, the lowest level of the index; the levels of all blocks are then
merged and scanned bucket by bucket. A corpus that is there as a whole is one
batch, so all lowest levels meet in one merge, where a growing corpus would merge
levels of equal size one after the other.

An anchor's span is the text of all windows that chose it. The merge tells, for
each anchor, that its span stands earlier (all its windows are repeats), that
nothing shares its core (none is), or that spans of one core differ: only there,
at the edges of matches, single windows are compared in a second merge.

Cores and spans are hashed by 64 bits each, single windows by both their halves, so
two texts are taken for equal by 128 bits; no range is over 150 bytes long, too short
for sums of powers to cancel. Blocks keep only the first of equal entries, so a passage that
a third of all documents hold is one entry of each block. The blocks are written
once, bucketed by units of a few megabytes, and the answers of a unit come to it without
moving the text again.

Defined cases: null is ""; texts under 100 bytes keep all; equal ids come in the
order of their blocks, so of repeated rows one keeps its text; a null id comes
last; ids are integers; a text of any length is one block of one task, which holds
about seventy times its bytes; an empty table gives an empty table; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, by_bucket, cut, free_name, in_units, mix, n_units, powers, with_answers

LENGTH, CORE = 100, 50
BLOCK = 1 << 19
BUCKET_BYTES = 10 << 20
LAST = np.iinfo(np.int64).max


class Block:
    """The windows of a block of documents, by anchor."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray):
        self.raw, self.offsets, self.ids = raw, offsets, ids
        up, self.down = powers(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.total[1:])
        begin, end = offsets[:-1], offsets[1:] - LENGTH + 1
        ok = end > begin
        step = np.zeros(len(raw) + 2, np.int8)
        step[begin[ok]] += 1
        step[end[ok]] -= 1
        p = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))  # starts of windows
        if not len(p):
            self.low = self.high = self.doc = np.zeros(0, np.int64)
            self.core = self.span = self.cores = np.zeros(0, np.uint64)
            return
        low = mix((self.total[CORE:] - self.total[:-CORE]) * self.down[: len(raw) + 1 - CORE])
        self.cores = low
        at, wide, width = np.arange(len(low), dtype=np.int32), 1, LENGTH - CORE + 1
        best = low
        while wide < width:  # leftmost smallest core of each width
            s = min(wide, width - wide)
            right = best[s:] < best[:-s]
            best, at = np.where(right, best[s:], best[:-s]), np.where(right, at[s:], at[:-s])
            wide += s
        anchor = at[p]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)]))
        self.low, self.high = p[new], p[np.append(new[1:], len(p)) - 1]
        self.core, self.span = low[anchor[new]], self.hash(self.low, self.high + LENGTH)
        self.doc = np.searchsorted(offsets, self.low, "right") - 1

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))

    def halves(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of both halves of windows."""
        return self.cores[start], self.cores[start + CORE]

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and document of each window of some runs."""
        n = self.high[runs] - self.low[runs] + 1
        start = np.repeat(self.low[runs] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return start, np.repeat(self.doc[runs], n)


def firsts(ids: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether an entry is the first, by id and then place, of those with equal keys."""
    order = np.lexsort((ids, *keys))
    new = np.ones(len(ids), bool)
    same = np.logical_and.reduce([k[order[1:]] == k[order[:-1]] for k in keys])
    new[order[1:][same]] = False
    return new


def _send(rows: list, unit: int, block: int, n_buckets: int, ids: np.ndarray, *keys: np.ndarray) -> None:
    """Adds packed entries, in their order, to the rows for each bucket."""
    order, found, cuts = by_bucket(keys[0], n_buckets)
    for k, i, j in zip(found, cuts[:-1], cuts[1:]):
        sel = order[i:j]
        rows.append((unit, block, int(k), ids[sel].tobytes(), *(x[sel].tobytes() for x in keys)))


def _told(answers: list, kind: int, n_buckets: int, keys: np.ndarray) -> np.ndarray:
    """What the merges say of the entries with these keys, in the order in which they were sent."""
    out = np.zeros(len(keys), np.uint8)
    order, found, cuts = by_bucket(keys, n_buckets)
    at = {int(k): (i, j) for k, i, j in zip(found, cuts[:-1], cuts[1:])}
    for a in answers or ():
        if a["kind"] == kind:
            i, j = at[a["bucket"]]
            out[order[i:j]] = np.frombuffer(a["said"], np.uint8)
    return out


def _batch(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names)


def _merge(kind: int):
    """0: anchors, whose spans may differ (2) or stand earlier (1); 1: single windows, by both halves, which stand earlier or not."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("unit", "ascending"), ("block", "ascending")])
        get = lambda c, k: np.concatenate([np.frombuffer(x.as_py(), k) for x in t[c]])
        ids, a, b = get("ids", np.int64), get("a", np.uint64), get("b", np.uint64)
        said = np.zeros(len(a), np.uint8)
        order = np.argsort(a, kind="stable")
        same = a[order[1:]] == a[order[:-1]]
        many = np.zeros(len(a), bool)
        many[order[1:][same]] = many[order[:-1][same]] = True
        at = np.flatnonzero(many)
        first = firsts(ids[at], b[at], a[at])
        said[at[~first]] = 1
        if kind == 0:
            core, n = np.unique(a[at[first]], return_counts=True)
            said[at[first]] = np.where(n[np.searchsorted(core, a[at[first]])] > 1, 2, 0)
        ends = np.cumsum([len(x.as_py()) // 8 for x in t["ids"]])
        parts = np.split(said, ends[:-1])
        keep = [i for i, x in enumerate(parts) if x.any()]
        t = t.take(pa.array(keep, pa.int64()))
        return pa.table({"unit": t["unit"], "block": t["block"], "kind": pa.array([kind] * len(keep), pa.int32()), "bucket": t["bucket"], "said": pa.array([parts[i].tobytes() for i in keep], pa.binary())})

    return run


SAID = "unit long, block long, kind int, bucket long, said binary"


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (pairs of byte offsets, packed as int64) of every row of docs."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), "text")
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = int(max(16, total // BUCKET_BYTES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, k, batch, raw, offsets in in_units(batches, BLOCK):
            ids = batch.column("doc_id")
            yield _batch([(unit, k, pa.compute.fill_null(ids, LAST).to_numpy(zero_copy_only=False).tobytes(), offsets.astype(np.int64).tobytes(), raw.tobytes())], ["unit", "block", "ids", "offsets", "raw"], [pa.int64()] * 2 + [pa.binary()] * 3)

    name = f"segtally_blocks_{uuid.uuid4().hex}"
    n = n_units(spark, total)

    @contextmanager
    def stored_blocks():
        """The table of blocks goes at the end, also after a failure."""
        try:
            yield
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    try:
        d.mapInArrow(pack, "unit long, block long, ids binary, offsets binary, raw binary").write.bucketBy(n, "unit").format("parquet").saveAsTable(name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    stored = spark.table(name)

    def opened(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Block, list]]:
        for r in range(batch.num_rows):
            x = {c: batch.column(c)[r] for c in batch.schema.names}
            raw, offsets, ids = (np.frombuffer(x[c].as_py(), t) for c, t in (("raw", np.uint8), ("offsets", np.int64), ("ids", np.int64)))
            yield x["unit"].as_py(), x["block"].as_py(), Block(raw, offsets, ids), x["answers"].as_py() if "answers" in x else []
        pa.default_memory_pool().release_unused()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, block, b, _ in opened(batch):
                rows: list = []
                first = firsts(b.ids[b.doc], b.span, b.core) if len(b.low) else np.zeros(0, bool)
                _send(rows, unit, block, n_buckets, b.ids[b.doc][first], b.core[first], b.span[first])
                yield _batch(rows, ["unit", "block", "bucket", "ids", "a", "b"], [pa.int64()] * 3 + [pa.binary()] * 3)

    def states(b: Block, answers: list) -> np.ndarray:
        first = firsts(b.ids[b.doc], b.span, b.core) if len(b.low) else np.zeros(0, bool)
        out = np.ones(len(b.low), np.uint8)
        out[first] = _told(answers, 0, n_buckets, b.core[first])
        return out

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, block, b, answers in opened(batch):
                start, doc = b.windows(np.flatnonzero(states(b, answers) == 2))
                h, h2 = b.halves(start)
                rows: list = []
                if len(h):
                    first = firsts(b.ids[doc], h2, h)
                    _send(rows, unit, block, n_buckets, b.ids[doc][first], h[first], h2[first])
                yield _batch(rows, ["unit", "block", "bucket", "ids", "a", "b"], [pa.int64()] * 3 + [pa.binary()] * 3)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, b, answers in opened(batch):
                state = states(b, answers)
                start, doc = b.windows(np.flatnonzero(state == 2))
                h, h2 = b.halves(start)
                again = np.ones(len(h), np.uint8)
                if len(h):
                    first = firsts(b.ids[doc], h2, h)
                    again[first] = _told(answers, 1, n_buckets, h[first])
                step = np.zeros(len(b.raw) + 1, np.int64)
                lo, hi = (np.concatenate([x[state == 1], start[again == 1]]) for x in (b.low, b.high))
                np.add.at(step, lo, 1)
                np.add.at(step, hi + LENGTH, -1)
                gone = np.cumsum(step[:-1]) > 0
                rows = []
                for i, (p, q) in enumerate(zip(b.offsets[:-1], b.offsets[1:])):
                    g = gone[p:q]
                    ends = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                    kept = b.raw[p:q][~g].tobytes() if len(ends) else b.raw[p:q].tobytes()
                    rows.append((None if b.ids[i] == LAST else int(b.ids[i]), int(q - p), int(g.sum()), len(ends) // 2, hashlib.sha256(kept).hexdigest(), ends.astype(np.int64).tobytes()))
                yield _batch(rows, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"], [pa.int64()] * 4 + [pa.string(), pa.binary()])

    def met(said: DataFrame) -> DataFrame:
        return with_answers(stored, said, n, "kind", "bucket", "said")

    with stored_blocks(), arrow_rows(spark, 8):
        first = stored.mapInArrow(anchors, "unit long, block long, bucket long, ids binary, a binary, b binary")
        said = cut(first.groupBy("bucket").applyInArrow(_merge(0), SAID))
        second = met(said).mapInArrow(edges, "unit long, block long, bucket long, ids binary, a binary, b binary")
        said = cut(said.union(second.groupBy("bucket").applyInArrow(_merge(1), SAID)))
        out = cut(met(said).mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed binary"))
    return out


def texts(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes of text taken out; a character that loses some of its bytes is read as U+FFFD. Rows of equal id and length are treated alike."""
    gone, size, same, own = (free_name(n, docs.columns) for n in ("_removed", "_bytes", "_same", "_own"))
    found = spans(docs).groupBy(F.col("doc_id").alias(own), F.col("n_bytes").alias(same)).agg(F.max("removed").alias(gone))
    d = docs.withColumn(size, F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    joined = d.join(found, d["doc_id"].cast("long").eqNullSafe(F.col(own)) & (F.col(size) == F.col(same)), "left").select(*(d[f"`{c}`"] for c in docs.columns), gone)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x, removed in zip(b.column(at), b.column(gone)):
                raw, ends = (x.as_py() or "").encode(), np.frombuffer(removed.as_py() or b"", np.int64)
                cuts = [0, *ends.tolist(), len(raw)]
                out.append(b"".join(raw[i:j] for i, j in zip(cuts[::2], cuts[1::2])).decode("utf-8", "replace"))
            columns = list(b.columns[:-1])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
