"""Alignment of two tokenizers over every text, and how often ids are linked corpus-wide.

Both tokenizers turn space + text into tokens whose bytes, joined, are those bytes
again. Where a token of each ends at the same byte, a group ends. Groups are found by
diagonal run skipping: while tokens end together the shift between the two indices
stays as it is, so slices of the end arrays are compared at this shift, doubled as long
as they are equal and then halved, and a whole one-to-one stretch is jumped at once;
where ends differ, the side that is behind goes on until both meet, and the shift is
set anew. Every pair of ids that shares a group is linked.

Texts are cut into chunks that neither tokenizer joins with what follows (they begin at
white space behind something else), so both end a token where a chunk ends. The chunks
that a worker has not seen yet are encoded and laid end to end, and their groups are found
in one run; the groups of a text are those of its chunks. Distinct pairs of each text
are stored once; their counts are summed by task and then by pair. Counts go
to all workers if there are at most ``most_pairs`` of them; beyond that, pairs and counts
meet in a join that is salted by row.

Defined cases: a text that is null or empty, or whose token bytes differ from space +
text (it holds U+2581, say), has no tokens: zeros and ''. Repeated rows count as
documents of their own; an empty table gives an empty table; a long text is
aligned in segments; rows without an id keep null; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Scratch, blocks
from .packing import _Filled, byte_letters

MARK = "▁"
#: Chunks (and characters in them) whose ids a worker keeps.
KEEP_CHUNKS, KEEP_LETTERS, KEEP_PARTS = 300_000, 4_000_000, 300_000
#: Characters of one text that are aligned at a time.
SEGMENT = 1 << 20
#: So many distinct pairs are sent to every worker, 13 bytes each; more are joined.
MOST_PAIRS = 4_000_000
#: Distinct pairs that a task sums up before it hands them on.
HELD_PAIRS = 3_000_000
SALT = 16
#: Leading white space, then what follows up to a space or line feed behind something else.
CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
#: Fixed value: how byte-level vocabularies split ASCII.
ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


class Pair:
    """Both tokenizers, their token lengths in bytes, and the ids of chunks: (A's, B's) or None where bytes differ."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        spec = json.loads(self.a.to_str())
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("the first tokenizer must be byte-level, without a normaliser")
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.letters = letters
        self.a_bytes = [bytes(byte_of[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("a piece of the second tokenizer goes over a space or line feed; chunks would not be its own")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.mark = self.b.piece_to_id(MARK)
        self.parts = _Filled(self._part)
        self.forget()
        #: How an id stands in the text of groups: A's before "," and "|", B's before "," and ";".
        self.written = [b"%d%c" % (i, s) for t, marks in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for s in marks for i in range(len(t))]

    @property
    def pair_type(self) -> str:
        return "<u4" if len(self.a_bytes) * len(self.b_bytes) < 1 << 32 else "<u8"

    def _part(self, part: str) -> tuple[int, ...]:
        """Printing ASCII stands for itself, but for spaces."""
        if part.isprintable():
            word = part.replace(" ", self.letters[32])
        else:
            word = "".join(map(self.letters.__getitem__, part.encode()))
        return tuple([t.id for t in self.a.model.tokenize(word)])

    def _encode_a(self, chunks: list[str]) -> list[list[int]]:
        out: list = [None] * len(chunks)
        other = [i for i, c in enumerate(chunks) if not c.isascii()]
        for i, e in zip(other, self.a.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        part = self.parts.__getitem__
        return [[i for p in ASCII_PARTS.findall(c) for i in part(p)] if x is None else x for c, x in zip(chunks, out)]

    def _encode_b(self, chunks: list[str]) -> list[list[int]]:
        """Behind a space the mark that the tokenizer adds is that space; elsewhere it is taken off again."""
        ids = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return [([self.mark] if c == " " else x) if c[0] == " " else (x[1:] if x[:1] == [self.mark] else []) for c, x in zip(chunks, ids)]

    def forget(self) -> None:
        #: The number of each chunk, -1 where bytes differ; by number its measures, the text of its groups and where its pairs begin.
        self.numbers: dict[str, int] = {}
        self.measures = np.zeros((0, 4), np.int64)
        self.texts: list[bytes] = []
        self.pairs, self.times, self.pairs_at = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.kept = 0

    def room(self) -> None:
        if len(self.numbers) > KEEP_CHUNKS or self.kept > KEEP_LETTERS:
            self.forget()
        if len(self.parts) > KEEP_PARTS:
            self.parts.clear()

    def learn(self, chunks: set[str]) -> None:
        todo = list(chunks.difference(self.numbers))
        if not todo:
            return
        self.kept += sum(map(len, todo))
        size, good, sides = np.array([len(c.encode()) for c in todo]), np.ones(len(todo), bool), []
        for ids, length in ((self._encode_a(todo), self.a_len), (self._encode_b(todo), self.b_len)):
            at = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(at[-1]))
            good &= np.diff(np.concatenate([[0], np.cumsum(length[flat])])[at]) == size
            sides.append((flat, at))
        (_, _), (flat, at) = sides
        for i, c in enumerate(todo):  # both cut the text itself into tokens; only the mark reads otherwise than it is written
            if not c.isascii() and good[i]:
                good[i] = MARK not in c and b"".join(map(self.b_bytes.__getitem__, flat[at[i] : at[i + 1]].tolist())) == c.encode()
        number = np.where(good, np.cumsum(good) - 1 + len(self.texts), -1)
        self.numbers.update(zip(todo, number.tolist()))
        if good.any():
            (a, a_at), (b, b_at) = ((flat[np.repeat(good, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at)[good])])) for flat, at in sides)
            measures, texts, pairs, times, pairs_at = _aligned(a, a_at, b, b_at, self)
            self.measures = np.concatenate([self.measures, measures])
            self.texts += texts
            self.pairs_at = np.concatenate([self.pairs_at, len(self.pairs) + pairs_at[1:]])
            self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])


@lru_cache(maxsize=2)
def pair_of(a_file: str, b_file: str) -> Pair:
    return Pair(a_file, b_file)


def group_ends(ea: list[int], eb: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as indices behind their last tokens, from the ends of two token lists over the same bytes."""
    first_a: list[int] = []
    first_b: list[int] = []
    count: list[int] = []
    i = j = 0
    n = len(ea)
    while i < n:
        x, y = ea[i], eb[j]
        while x != y:  # irregular: whoever is behind goes on
            if x < y:
                i += 1
                x = ea[i]
            else:
                j += 1
                y = eb[j]
        shift, i = j - i, i + 1
        first_a.append(i)
        first_b.append(i + shift)
        at = i
        if at < n and ea[at] == eb[at + shift]:
            at += 1
            width = 2
            while (part := ea[at : at + width]) and part == eb[at + shift : at + shift + width]:
                at += len(part)
                width *= 2
            while width > 1:
                width >>= 1
                part = ea[at : at + width]
                if part and part == eb[at + shift : at + shift + width]:
                    at += len(part)
        count.append(at - i + 1)
        i, j = at, at + shift
    n_runs = np.array(count, np.int64)
    more = np.arange(int(n_runs.sum())) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
    return tuple(np.repeat(np.array(f, np.int64), n_runs) + more for f in (first_a, first_b))


def _linked(a: np.ndarray, b: np.ndarray, a0: np.ndarray, b0: np.ndarray, na: np.ndarray, nb: np.ndarray, doc: np.ndarray, p: Pair) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (document of the block, pair of ids) and how many links each has."""
    width, all_pairs = len(p.b_bytes), len(p.a_bytes) * len(p.b_bytes)
    wide = na * nb > 4096
    keys, times = [], []
    for g in np.flatnonzero(wide):  # the ids of a large group are few: count them first
        ua, ca = np.unique(a[a0[g] : a0[g] + na[g]], return_counts=True)
        ub, cb = np.unique(b[b0[g] : b0[g] + nb[g]], return_counts=True)
        keys.append((doc[g] * all_pairs + ua[:, None].astype(np.int64) * width + ub).ravel())
        times.append((ca[:, None] * cb).ravel())
    g = np.flatnonzero(~wide)
    n = na[g] * nb[g]
    which = np.repeat(g, n)
    r = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    one = nb[which]
    keys.append(doc[which] * all_pairs + a[a0[which] + r // one].astype(np.int64) * width + b[b0[which] + r % one])
    times.append(np.ones(len(which), np.int64))
    k, t = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(k, kind="stable")
    k, t = k[order], t[order]
    first = np.flatnonzero(np.diff(k, prepend=-1))
    return k[first], np.add.reduceat(t, first) if len(first) else t


def _aligned(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, p: Pair) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Of texts whose ids stand end to end: n_a, n_b, n_groups and n_links of each, the text of its groups, distinct pairs and their links, and where the pairs of each begin."""
    n, all_pairs = len(a_at) - 1, len(p.a_bytes) * len(p.b_bytes)
    ga, gb = group_ends(np.cumsum(p.a_len[a]).tolist(), np.cumsum(p.b_len[b]).tolist())
    a0, b0 = np.concatenate([[0], ga[:-1]]), np.concatenate([[0], gb[:-1]])
    na, nb = ga - a0, gb - b0
    g_at = np.searchsorted(ga, a_at, "right")
    keys, times = _linked(a, b, a0, b0, na, nb, np.repeat(np.arange(n), np.diff(g_at)), p)
    links = np.concatenate([[0], np.cumsum(na * nb)])
    group = np.arange(len(ga))
    code = np.empty(len(a) + len(b), np.int64)
    last = np.zeros(len(a), bool)
    last[ga - 1] = True
    code[np.arange(len(a)) + b0[np.repeat(group, na)]] = a + last * len(p.a_bytes)
    last = np.zeros(len(b), bool)
    last[gb - 1] = True
    code[np.arange(len(b)) + ga[np.repeat(group, nb)]] = b + 2 * len(p.a_bytes) + last * len(p.b_bytes)
    written, ends = list(map(p.written.__getitem__, code.tolist())), (a_at + b_at).tolist()
    texts = [b"".join(written[i:j])[:-1] for i, j in zip(ends, ends[1:])]
    return np.stack([np.diff(a_at), np.diff(b_at), np.diff(g_at), np.diff(links[g_at])], 1), texts, keys % all_pairs, times, np.searchsorted(keys, np.arange(n + 1) * all_pairs)


NOTHING = (0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _summed(chunks: list[list[str]], p: Pair) -> list[tuple]:
    """n_a, n_b, n_groups, n_links, text of the groups, distinct pairs and their links of each list of chunks."""
    p.room()
    p.learn(set().union(*chunks))
    number = p.numbers.__getitem__
    numbers = [list(map(number, c)) for c in chunks]
    good = [k for k, x in enumerate(numbers) if x and min(x) >= 0]
    out: list = [NOTHING] * len(chunks)
    if not good:
        return out
    size = np.array([len(numbers[k]) for k in good])
    at = np.concatenate([[0], np.cumsum(size)])
    of = np.fromiter(chain.from_iterable(numbers[k] for k in good), np.int64, int(at[-1]))
    sums = np.add.reduceat(p.measures[of], at[:-1]).tolist()
    n, all_pairs = len(p.texts), len(p.a_bytes) * len(p.b_bytes)
    key, times = np.unique(np.repeat(np.arange(len(good)), size) * n + of, return_counts=True)
    doc, chunk = key // n, key % n
    first, many = p.pairs_at[chunk], np.diff(p.pairs_at)[chunk]
    place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - first, many)
    key, links = np.repeat(doc, many) * all_pairs + p.pairs[place], np.repeat(times, many) * p.times[place]
    order = np.argsort(key)
    key, links = key[order], links[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    key, links = key[new], np.add.reduceat(links, new)
    ends = np.searchsorted(key, np.arange(len(good) + 1) * all_pairs)
    key %= all_pairs
    text = p.texts.__getitem__
    for i, k in enumerate(good):
        out[k] = (*sums[i], b";".join(map(text, numbers[k])), key[ends[i] : ends[i + 1]], links[ends[i] : ends[i + 1]])
    return out


def _long(text: str, p: Pair) -> tuple:
    """The same for one long text, in segments of whole chunks; the text of its groups comes as its hash."""
    sums, sha, held, pairs, times = np.zeros(4, np.int64), hashlib.sha256(), b"", [], []

    def segments() -> Iterator[list[str]]:
        part, size = [], 0
        for m in CHUNK.finditer(" " + text):
            part.append(m[0])
            size += len(m[0])
            if size > SEGMENT:
                yield part
                part, size = [], 0
        if part:
            yield part

    for chunks in segments():
        ((*n, written, k, t),) = _summed([chunks], p)
        if not n[0]:
            return NOTHING
        sums += n
        sha.update(held + written)
        held = b";"
        pairs.append(k)
        times.append(t)
    k, back = np.unique(np.concatenate(pairs), return_inverse=True)
    return (*sums.tolist(), sha.hexdigest(), k, np.bincount(back, np.concatenate(times), len(k)).astype(np.int64))


def _measured(texts: list[str], p: Pair) -> list[tuple]:
    out = [_long(x, p) if len(x) > SEGMENT else NOTHING for x in texts]
    short = [i for i, x in enumerate(texts) if 0 < len(x) <= SEGMENT]
    for i, x in zip(short, _summed([CHUNK.findall(" " + texts[i]) for i in short], p)):
        out[i] = x
    return out


def groups(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """doc_id and the groups of each text as ``a1,a2|b1;a3|b2,b3``: ids of both tokenizers between common ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair_of(a_file, b_file)
        for batch, *_ in blocks(batches):
            rows = [x[4].decode() for x in _summed([CHUNK.findall(" " + x) if x else [] for x in batch.column("text").to_pylist()], p)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())], ["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.select('doc_id').schema[0].dataType.simpleString()}, groups string")


def _store(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """A row of each document: measures, a row number of its own, distinct pairs and their links as packed numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, row = pair_of(a_file, b_file), TaskContext.get().partitionId() << 33
        for batch, *_ in blocks(batches):
            out = _measured([x or "" for x in batch.column("text").to_pylist()], p)
            n = [pa.array([x[i] for x in out], pa.int64()) for i in range(4)]
            sha = pa.array(["" if not x[0] else x[4] if isinstance(x[4], str) else hashlib.sha256(x[4]).hexdigest() for x in out], pa.string())
            pairs, times = (pa.array([x[i].astype(t).tobytes() for x in out], pa.binary()) for i, t in ((5, p.pair_type), (6, "<u4")))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(out))), batch.column("doc_id"), *n, sha, pairs, times], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
            row += len(out)

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")


def _packed(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of packed numbers, and the n+1 offsets of its rows into them."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = np.dtype(kind).itemsize
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind) if data and at[-1] > at[0] else np.zeros(0, kind)), (at - at[0]) // size


def pair_counts(stored: DataFrame, kind: str, n_b: int) -> DataFrame:
    """pair, a document count n of each, and whether no pair of the same A id has a higher one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(keys), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 18)]), pa.array(n[i : i + (1 << 18)])], ["pair", "n"])

        for batch in batches:
            at = 0
            values, _ = _packed(batch.column("pairs"), kind)
            while at < len(values):
                k, c = np.unique(values[at : at + HELD_PAIRS], return_counts=True)
                at += HELD_PAIRS
                all_keys = np.concatenate([keys, k.astype(np.int64)])
                keys, back = np.unique(all_keys, return_inverse=True)
                n = np.bincount(back, np.concatenate([n, c]), len(keys)).astype(np.int64)
                if len(keys) > HELD_PAIRS:
                    yield from rows(keys, n)
                    keys, n = keys[:0], n[:0]
        yield from rows(keys, n)

    summed = stored.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {n_b}"))
    return summed.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def align(docs: DataFrame, a_file: str, b_file: str, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs.

    An id pair counts the documents of docs that hold it linked; n_best are the links whose
    count is the highest of their A id, count_sum adds the counts of all links.
    """
    p, spark = pair_of(a_file, b_file), docs.sparkSession
    kind, scratch = p.pair_type, Scratch(spark)
    stored = scratch.keep(_store(docs, a_file, b_file))
    counts = scratch.keep(pair_counts(stored, kind, len(p.b_bytes)))
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    if counts.count() <= most_pairs:
        known = counts.toArrow().combine_chunks().sort_by("pair")
        sent = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))
        scratch.drop(counts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, n, best = sent.value
            for batch in batches:
                pairs, at = _packed(batch.column("pairs"), kind)
                times = _packed(batch.column("times"), "<u4")[0].astype(np.int64)
                i = np.searchsorted(keys, pairs)
                sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[i])])[at]) if len(i) else np.zeros(len(at) - 1, np.int64) for x in (best, n)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *map(pa.array, sums), batch.column("groups_sha256")], [*own, "n_best", "count_sum", "groups_sha256"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.select(*own).schema)
        return stored.select(*own, "groups_sha256", "pairs", "times").mapInArrow(run, f"{kinds}, n_best long, count_sum long, groups_sha256 string")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (pairs, at), (times, _) = _packed(batch.column("pairs"), kind), _packed(batch.column("times"), "<u4")
            row = np.repeat(batch.column("row").to_numpy(), np.diff(at))
            for i in range(0, len(pairs), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 18)].astype(np.int64)) for x in (row, pairs, times)], ["row", "pair", "times"])

    links = stored.select("row", "pairs", "times").mapInArrow(unpack, "row long, pair long, times long").withColumn("salt", F.pmod(F.hash("row"), F.lit(SALT)))
    spread = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    sums = links.join(spread, ["pair", "salt"]).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return stored.drop("pairs", "times").join(sums, "row", "left").select(*own, zero("n_best"), zero("count_sum"), "groups_sha256")
