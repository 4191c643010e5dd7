"""LM scoring with a log-frequency Bloom filter.

N-grams (words with their ends, pairs and triples) are counted over all training texts.
The filter holds an n-gram of quantised log count q as q keys (n-gram, 1..q); a
count is read by probing 1, 2, ... until a key is missing. It is built in
segments, one per bucket of the n-gram hashes, by the tasks that sum the bucket's
counts; every n-gram goes in, at every size, so the filter grows with the input. It
is not broadcast: the probes come to the segments.

Texts are stored in blocks. Each block sends its distinct n-grams once, by bucket, with
their counts in its training texts; a bucket sums the counts of all blocks, builds its
segment, probes it for every list that was sent and answers each block, for words also
with the exact counts that the base score needs. Blocks are stored once, bucketed by units
of a few megabytes, and the answers of a unit come to it, where its blocks are scored. An n-gram is as smooth as its context is rare: each order is mixed with
the one below in proportion to the count of its context (a Dirichlet prior), so that
the probabilities of all words after a context sum to one but for quantisation.

Lists travel as packed arrays in binary columns, a few rows per block and bucket:
words as 64-bit hashes, pairs and triples as the 32 bits of theirs that the bucket does
not tell. A frequent n-gram is one entry of each block, so no bucket is hot, and the
number of buckets follows the input.

Defined cases: null is "" and has one token, its end; a null id counts as the text
"" in the split; rows that repeat both id and text are scored alike, and count as
often as they stand in the table; an empty training set gives every token the
probability of the smoothing alone; a text of any length is one block of one task,
which holds about thirty times its bytes; an empty table gives an empty table; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, by_bucket, cut, flat, hashes, in_units, mix, n_units, with_answers, words

END = np.uint64(0xE4D)
ADD = 0.1
#: Counts by which the order below is weighed in pairs and triples.
PAIR_PRIOR, TRIPLE_PRIOR = 500.0, 10.0
BITS_PER_KEY, PROBES = 14, 7
BUCKET_BYTES, BLOCK = 4 << 20, 5 << 19


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, word hash, pair hash and triple hash of every token; a text starts after two ends, and of its first token the triple is left out (0)."""
    low, s, e, at = words(raw, offsets)
    n = np.diff(at) + 1
    row = np.repeat(np.arange(len(n)), n)
    last = np.cumsum(n) - 1
    h = np.full(len(row), END, np.uint64)
    inner = np.ones(len(row), bool)
    inner[last] = False
    h[inner] = hashes(low, s, e)
    pair = mix(np.concatenate([[END], h[:-1]]).astype(np.uint64) * np.uint64(3) + h + np.uint64(11))
    triple = mix(np.concatenate([[END], pair[:-1]]).astype(np.uint64) * np.uint64(5) + h + np.uint64(29))
    triple[np.concatenate([[0], last[:-1] + 1])[: len(n)]] = 0
    return row, h, pair, triple


def level(count: np.ndarray) -> np.ndarray:
    """Quantised log count: half powers of two from 1; 0 for none."""
    return np.where(count > 0, 1 + np.floor(2 * np.log2(np.maximum(count, 1)) + 1e-9), 0).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts that have a level; 0 for none."""
    return np.where(levels == 0, 0.0, np.where(levels <= 3, np.maximum(levels - 1, 1), 2.0 ** ((levels - 1) / 2) * 2**0.25))


def places(h: np.ndarray, j: int, bits: np.uint64) -> Iterator[np.ndarray]:
    a, b = mix(h + np.uint64(2 * j + 1)), mix(h ^ np.uint64(0xA5A5A5A5 + j)) | np.uint64(1)
    for k in range(PROBES):
        yield ((a + np.uint64(k) * b) % bits).astype(np.int64)


class Filter:
    """A segment: counts by levels, in ``BITS_PER_KEY`` bits a key."""

    def __init__(self, h: np.ndarray, levels: np.ndarray):
        self.bits = np.uint64(max(64, int(levels.sum()) * BITS_PER_KEY))
        self.seen = np.zeros(int(self.bits), bool)
        for j in range(1, int(levels.max(initial=0)) + 1):
            for p in places(h[levels >= j], j, self.bits):
                self.seen[p] = True

    def levels(self, h: np.ndarray) -> np.ndarray:
        out, live, j = np.zeros(len(h), np.int64), np.arange(len(h)), 1
        while len(live):
            ok = np.ones(len(live), bool)
            for p in places(h[live], j, self.bits):
                ok &= self.seen[p]
            live = live[ok]
            out[live] = j
            j += 1
        return out


def planes(x: np.ndarray) -> bytes:
    """Values, first bytes first, so that the bytes they share are pressed in a shuffle."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind)[:, 0] if data else np.zeros(0, kind)


def press(data: bytes) -> bytes:
    """Compressed, behind its length in eight bytes; checkpoints press nothing themselves."""
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def opened(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], n, codec="zstd", asbytes=True) if n else b""


def _packed(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else [()] * len(names), kinds)], names)


#: Columns of a list: of words, pairs and triples what names them and how often they stand in the block's training texts.
SENT = ["w", "wc", "p", "pc", "t", "tc"]
KINDS = [np.uint64, np.int32, np.uint32, np.int32, np.uint32, np.int32]


def short(h: np.ndarray) -> np.ndarray:
    """The 32 bits of a hash that stand for an n-gram within its bucket."""
    return (h >> np.uint64(32)).astype(np.uint32)


def distinct(x: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in the order of lists: by bucket, then by value; their buckets, where each begins, and the place of every x."""
    u, at = np.unique(x, return_inverse=True)
    order, found, cuts = by_bucket(u, n_buckets)
    back = np.empty(len(u), np.int64)
    back[order] = np.arange(len(u))
    return u[order], found, cuts, back[at]


def score(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    split = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    d = docs.select("doc_id", "text", split.alias("held_out"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(8, total // bucket_bytes)

    def bodies_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, number, batch, _, _ in in_units(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield _packed([(unit, number, sink.getvalue().to_pybytes())], ["unit", "block", "body"], [pa.int64(), pa.int64(), pa.binary()])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, number, body in ((x, y, z) for b in batches for x, y, z in zip(b["unit"], b["block"], b["body"])):
            table = pa.ipc.open_stream(body.as_py()).read_all()
            row, h, pair, triple = grams(*flat(table["text"]))
            train = ~np.array(table["held_out"].to_pylist(), bool)[row]
            made: dict[int, list] = {}
            for k, x in enumerate((h, pair, triple[triple != 0])):
                mine = train if k < 2 else train[triple != 0]
                u, found, cuts, at = distinct(x, n_buckets)
                c = np.bincount(at, weights=mine, minlength=len(u)).astype(np.int32)
                name = u if k == 0 else short(u)
                for b, i, j in zip(found, cuts[:-1], cuts[1:]):
                    made.setdefault(int(b), [b""] * 6)[2 * k : 2 * k + 2] = planes(name[i:j]), planes(c[i:j])
            rows = [(unit.as_py(), number.as_py(), b, *x) for b, x in made.items()]
            pa.default_memory_pool().release_unused()
            for i in range(0, len(rows), 64):
                yield _packed(rows[i : i + 64], ["unit", "block", "bucket", *SENT], [pa.int64()] * 3 + [pa.binary()] * 6)

    def answer(t: pa.Table) -> pa.Table:
        known, keys, levels = [], [], []
        for k in range(3):
            parts = [from_planes(x.as_py(), KINDS[2 * k]) for x in t[SENT[2 * k]]]
            counts = np.concatenate([from_planes(x.as_py(), np.int32) for x in t[SENT[2 * k + 1]]])
            u, at = np.unique(np.concatenate(parts), return_inverse=True)
            n = np.bincount(at, weights=counts, minlength=len(u)).astype(np.int64)
            known.append((at, n, np.cumsum([0, *map(len, parts)])))
            keys.append(mix(u.astype(np.uint64) + np.uint64(k << 62)))
            levels.append(level(n))
        segment = Filter(np.concatenate(keys), np.concatenate(levels))
        probed = [segment.levels(x).astype(np.uint8) for x in keys]
        probed[0] = np.where(known[0][1] > 0, probed[0], 0).astype(np.uint8)  # words are known exactly
        told = [tuple(press(v[at[i:j]].tobytes()) for i, j in zip(cuts[:-1], cuts[1:])) for v, (at, _, cuts) in zip(probed, known)]
        at, n, cuts = known[0]
        exact = [press(planes(n[at[i:j]])) for i, j in zip(cuts[:-1], cuts[1:])]
        del keys, levels, segment
        first = [1] + [0] * (t.num_rows - 1)  # the bucket's totals stand in one of its rows
        totals = [int((n > 0).sum()), int(n.sum())]
        return pa.table({"unit": t["unit"], "block": t["block"], "bucket": t["bucket"], "wc": pa.array(exact, pa.binary()), **{c: pa.array(x, pa.binary()) for c, x in zip(("wl", "pl", "tl"), told)}, "words": [totals[0] * f for f in first], "tokens": [totals[1] * f for f in first]})

    name = f"segtally_texts_{uuid.uuid4().hex}"
    units = n_units(spark, total)
    try:
        d.mapInArrow(bodies_of, "unit long, block long, body binary").write.bucketBy(units, "unit").format("parquet").saveAsTable(name)
        stored = spark.table(name)
        with arrow_rows(spark, 2):
            sent = stored.mapInArrow(lists, "unit long, block long, bucket long, " + ", ".join(f"{c} binary" for c in SENT))
            answers = cut(sent.groupBy("bucket").applyInArrow(answer, "unit long, block long, bucket long, wc binary, wl binary, pl binary, tl binary, words long, tokens long"))
        v, n = (x or 0 for x in answers.agg(F.sum("words"), F.sum("tokens")).first())
        with arrow_rows(spark, 1):
            return _met(with_answers(stored, answers, units, "bucket", "wc", "wl", "pl", "tl").select("body", "answers"), kind, n_buckets, v, n)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _met(blocks_: DataFrame, kind: str, n_buckets: int, v: int, n: int) -> DataFrame:
    """The scores of the documents of blocks (body, answers), from the totals of the training texts: v distinct tokens of n."""
    whole = np.log10(n + ADD * (v + 1))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for body, answers in zip(b["body"], b["answers"]):
                yield one(pa.ipc.open_stream(body.as_py()).read_all().combine_chunks(), sorted(answers.as_py() or [], key=lambda a: a["bucket"]))

    def one(batch: pa.Table, answers: list[dict]) -> pa.RecordBatch:
        raw, offsets = flat(batch["text"])
        row, h, pair, triple = grams(raw, offsets)
        m = len(offsets) - 1
        joined = lambda c: np.frombuffer(b"".join(opened(x[c]) for x in answers), np.uint8)
        inner = triple != 0
        at_w, at_p, at_t = (distinct(x, n_buckets)[3] for x in (h, pair, triple[inner]))
        c = np.concatenate([np.zeros(0, np.int64), *(from_planes(opened(x["wc"]), np.int64) for x in answers)])[at_w]
        single, pairs = count_of(joined("wl"))[at_w], count_of(joined("pl"))[at_p]
        triples = np.zeros(len(h))
        triples[inner] = count_of(joined("tl"))[at_t]
        ends = single[h == END][0] if len(h) else 0.0
        before = np.where(inner, np.concatenate([[0.0], single[:-1]]), ends)  # of the word before; a text starts after an end
        before2 = np.where(inner, np.concatenate([[0.0], pairs[:-1]]), 0.0)
        p = (single + ADD) / (n + ADD * (v + 1))
        p = (np.minimum(pairs, before) + PAIR_PRIOR * p) / (before + PAIR_PRIOR)
        p = np.where(inner, (np.minimum(triples, before2) + TRIPLE_PRIOR * p) / (before2 + TRIPLE_PRIOR), p)
        known = np.bincount(row, weights=c > 0, minlength=m).astype(np.int64)
        base = np.bincount(row, weights=np.log10(c + ADD) - whole, minlength=m)
        score_ = np.bincount(row, weights=np.log10(np.minimum(p, 1.0)), minlength=m)
        columns = [batch["doc_id"].combine_chunks(), batch["held_out"].combine_chunks(), pa.array(np.bincount(row, minlength=m)), pa.array(known), pa.array(base), pa.array(score_)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    met = cut(blocks_.mapInArrow(meet, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return met.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
