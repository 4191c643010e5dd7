"""Benchmark decontamination with training suffix arrays.

Every block of training text becomes a suffix array over words: the positions
that can start a match, sorted by the words that follow. Every suffix of every
benchmark item is searched in it by bisection, one word deeper at a time, down to a
window; windows that go on in the item and in the text alike make the longest matches,
with their places. A window that is matched whole marks its words as hit. The search
needs no shuffle: shards are the tasks of the scan.

The benchmark comes in parts of at most ``PART_BYTES`` of text, each broadcast
by itself; more parts mean more searches in the same scan, so no broadcast grows
with the benchmark. Words are searched by 64-bit hashes; of every window found, the
bytes of the words are compared.

Defined cases: null or wordless texts have no words and hit nothing; items of
fewer than ten words are one window; items of equal id are one item; an item
without an id marks words but is not listed; repeated rows are judged alike;
empty tables give no hits; a text of any length is one row of one task, which holds
about twenty times its bytes; all columns of docs come through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import blocks, flat, free_name, hashes, words

WINDOW = 10
PART_BYTES = 4 << 20


class Part:
    """Windows of some items: ranks of their words in the part's vocabulary, their sizes and where they stand."""

    def __init__(self, rows: list, size: int):
        self.items = sorted({r[0] for r in rows if r[0] is not None})
        number = {x: i for i, x in enumerate(self.items)}
        low, s, e, at = words(*flat(pa.array([r[1] for r in rows], pa.string())), alnum=True)
        h = hashes(low, s, e)
        self.vocabulary = np.unique(h)
        rank = np.searchsorted(self.vocabulary, h)
        n = np.diff(at)
        count = np.where(n > 0, np.maximum(1, n - size + 1), 0)  # windows of each row
        row = np.repeat(np.arange(len(rows)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start, long = at[row] + place, np.minimum(n[row], size)
        w = np.full((len(row), size), -1, np.int64)
        for k in range(size):
            ok = long > k
            w[ok, k] = rank[start[ok] + k]
        self.words, which = np.unique(w, axis=0, return_inverse=True) if len(w) else (w, np.zeros(0, np.int64))
        self.sizes = (self.words >= 0).sum(1)
        order = np.argsort(which, kind="stable")
        self.owner_cuts = np.searchsorted(which[order], np.arange(len(self.words) + 1))
        #: Item (-1: without id) and place of every occurrence of a window, window by window; text keeps apart rows of one item.
        self.owner, self.place, self.text = np.array([number.get(r[0], -1) for r in rows], np.int64)[row[order]], place[order], row[order]
        self.spelled = [low[x:y].tobytes() for x, y in zip(s, e)]
        self.first = start[order][self.owner_cuts[:-1]]  # a word of the part at which each window stands

    def search(self, h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start words of the block and windows that stand there. rows: n+1 offsets of rows into words."""
        none = np.zeros(0, np.int64)
        if not len(self.sizes) or not len(h):
            return none, none
        depth, base = self.words.shape[1], len(self.vocabulary) + 2
        rank = np.searchsorted(self.vocabulary, h)
        rank = np.where(self.vocabulary[np.minimum(rank, base - 3)] == h, rank, -1)
        run = _runs(rank, rows)
        start = np.flatnonzero(run >= self.sizes.min())
        if not len(start):
            return none, none
        columns = np.full((depth, len(start)), -1, np.int64)
        for k in range(depth):
            ok = run[start] > k
            columns[k, ok] = rank[start[ok] + k]
        order = np.lexsort(columns[::-1])
        array, columns = start[order], columns[:, order]  # the suffix array and its first words
        group, mine = np.zeros(len(array), np.int64), np.zeros(len(self.sizes), np.int64)
        found_at, found_w = [], []
        for k in range(depth):
            keys = group * base + columns[k] + 1
            left = np.searchsorted(keys, mine * base + self.words[:, k] + 1, "left")
            right = np.searchsorted(keys, mine * base + self.words[:, k] + 1, "right")
            alive = (mine >= 0) & (self.sizes > k) & (right > left)
            done = np.flatnonzero(alive & (self.sizes == k + 1))
            n = (right - left)[done]
            found_at.append(array[np.repeat(left[done] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else none, n) + np.arange(n.sum())])
            found_w.append(np.repeat(done, n))
            group = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
            mine = np.where(alive, group[np.minimum(left, len(group) - 1)], -1)
        return np.concatenate(found_at), np.concatenate(found_w)


def longest(part: Part, row: np.ndarray, at: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Maximal matches as columns row, item, item_at, at, length: runs of windows that go on in item and document alike."""
    n = part.owner_cuts[w + 1] - part.owner_cuts[w]
    k = np.repeat(part.owner_cuts[w] - np.cumsum(n) + n, n) + np.arange(n.sum())
    row, at, size = np.repeat(row, n), np.repeat(at, n), np.repeat(part.sizes[w], n)
    text, place, item = part.text[k], part.place[k], part.owner[k]
    o = np.lexsort((at, at - place, text, row))
    row, at, size, text, place, item = (x[o] for x in (row, at, size, text, place, item))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (text[1:] != text[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(row))) - 1 + size[first]
    out = np.stack([row[first], item[first], place[first], at[first], length], 1) if len(first) else np.zeros((0, 5), np.int64)
    return np.unique(out[out[:, 1] >= 0], axis=0)


def _runs(rank: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many known words stand in a row from each position on, within its row."""
    n = len(rank)
    ends = np.zeros(n + 1, bool)
    ends[rows[1:]] = True
    ends[:-1] |= rank < 0
    at = np.flatnonzero(ends)
    return at[np.searchsorted(at, np.arange(n) + (rank >= 0))] * (rank >= 0) - np.arange(n) * (rank >= 0)


def parts(benchmark: DataFrame, size: int, part_bytes: int) -> Iterator[Part]:
    b = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null").distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // part_bytes)
    for k in range(n):
        yield Part(b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect(), size)


def mark(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, part_bytes: int = PART_BYTES, name: str = "_hits") -> DataFrame:
    """docs with a last column ``name``: struct of n_words, n_hit, items (ids as strings, sorted) and matches.

    matches: the longest verbatim matches of at least a window as item, item_at, at and
    length, in words from 0, in order of at.
    """
    sc = docs.sparkSession.sparkContext
    names = docs.columns
    docs = out = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumnRenamed(f"c{names.index('text')}", "text")
    match = "struct<item:string,item_at:long,at:long,length:long>"
    state = T.StructType.fromDDL(f"n_words long, n_hit long, mask binary, items array<string>, matches array<{match}>")
    kind = pa.list_(pa.struct([("item", pa.string()), ("item_at", pa.int64()), ("at", pa.int64()), ("length", pa.int64())]))

    def step(first: bool, part):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = part.value
            for batch, raw, offsets in blocks(batches):
                low, s, e, rows = words(raw, offsets, alnum=True)
                at, w = p.search(hashes(low, s, e), rows)
                same = np.array([all(low[s[i + k] : e[i + k]].tobytes() == p.spelled[p.first[j] + k] for k in range(p.sizes[j])) for i, j in zip(at, w)], bool)
                at, w = at[same], w[same]  # what decides is bytes
                n = len(offsets) - 1
                step_ = np.zeros(len(s) + 1, np.int64)
                np.add.at(step_, at, 1)
                np.add.at(step_, at + p.sizes[w], -1)
                hit = np.cumsum(step_[:-1]) > 0
                row = np.searchsorted(rows, at, "right") - 1
                items: list[set] = [set() for _ in range(n)]
                matches: list[list] = [[] for _ in range(n)]
                for r, i, item_at, here, length in longest(p, row, at - rows[row], w).tolist():
                    items[r].add(p.items[i])
                    matches[r].append({"item": p.items[i], "item_at": item_at, "at": here, "length": length})
                masks, hits = [b""] * n, [0] * n
                touched = set(row.tolist())
                old = None if first else batch.column("mask")
                for r in range(n):
                    mask = old[r].as_py() if old is not None else b""
                    if r in touched:
                        new = np.packbits(hit[rows[r] : rows[r + 1]])
                        mask = (new | np.frombuffer(mask, np.uint8)).tobytes() if mask else new.tobytes()
                    masks[r], hits[r] = mask, int.from_bytes(mask, "big").bit_count()
                if not first:
                    items = [x.union(y.as_py()) for x, y in zip(items, batch.column("items"))]
                    matches = [x + y.as_py() for x, y in zip(matches, batch.column("matches"))]
                columns = dict(zip(batch.schema.names, batch.columns))
                columns |= {"n_words": pa.array(np.diff(rows)), "n_hit": pa.array(hits, pa.int64()), "mask": pa.array(masks, pa.binary()), "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())), "matches": pa.array(matches, kind)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return run

    first = True
    for part in parts(benchmark, size, part_bytes):
        out = out.mapInArrow(step(first, sc.broadcast(part)), T.StructType(docs.schema.fields + state.fields))
        first = False
    if first:
        out = docs.mapInArrow(step(True, sc.broadcast(Part([], size))), T.StructType(docs.schema.fields + state.fields))
    return out.select(*(F.col(c).alias(o) for c, o in zip(docs.columns, names)), F.struct("n_words", "n_hit", F.array_sort("items").alias("items"), F.array_sort("matches", lambda a, b: F.when(F.struct(a["at"], a["item"], a["item_at"]) < F.struct(b["at"], b["item"], b["item_at"]), -1).otherwise(1)).alias("matches")).alias(name))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of docs."""
    h = F.col("_hits")
    return mark(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", h.n_words.alias("n_words"), h.n_hit.alias("n_hit"), F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"), (h.n_hit > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a hit, with all their columns."""
    name = free_name("_hits", docs.columns)
    return mark(docs, benchmark, name=name).where(F.col(name)["n_hit"] == 0).drop(name)
