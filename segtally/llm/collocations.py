"""Phrase collocations of every language, counted in weighted acyclic automata.

Every word starts a path: itself and up to three words that follow in its piece. Each
shard of the text sorts its paths and builds an automaton from them, a row of states for
each depth in the order of their paths, with the weight of each path at its last state.
Shards are cut by prefix: the states below one range of (mixed) prefixes are a part of
their own, and parts of one range are united in one task, which sums the weights. What
passes a state is the count of the phrase that leads to it. The counts of a candidate's parts
come from a second composition: the parts asked for form an automaton that is walked
along the automaton of counts, depth by depth.

A word or phrase under ``least`` is in no candidate, so paths stop at rarer words, whose
counts a first pass has made exact. Words in paths are numbers from a list of the at
most ``MOST_WORDS`` most frequent ones, which all workers get; words beyond it keep their
hash, and then paths do not stop. A prefix so frequent that its range would be too large
is cut one word deeper; the counts of phrases that are cut so are summed over ranges. Which
prefixes are frequent comes from every 61st path; it moves work and changes no count.

Arithmetic on counts is done in integers of 64 bits and decimals of 38 digits. Words are
told apart by hashes of 63 bits.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count again;
an empty table gives an empty table; a text of any length is one run of bytes;
phrases with the same figures are ranked by their bytes; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import _LOWER, _P, Scratch, _spans, arrow_rows, blocks, hashes, mix

LONGEST = 4
#: So many words at most are numbered and sent to every worker, 16 bytes each.
MOST_WORDS = 4_000_000
#: Frequent prefixes of one length that every worker gets at most.
MOST_HOT = 1 << 20
#: Positions of one shard, and about so many of one range of prefixes.
SHARD, RANGE = 600_000, 1_200_000
#: One path of so many is looked at to find frequent prefixes.
EVERY = 61
#: Words that a task counts before it hands the counts on.
HELD_WORDS = 250_000
SALT = 8
#: Texts that go to Python at a time.
TEXTS = 500

_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
# The bytes that end a piece.
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2
_RAW = np.uint64(1 << 63)


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max))


def summed(paths: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct paths in order, with the sums of their weights; a path is a number for each depth, 0 behind its end."""
    if not len(weights):
        return paths, weights
    if max(int(p.max()) for p in paths) < 1 << 32:
        half = np.uint64(32)
        keys = [paths[0] << half | paths[1], paths[2] << half | paths[3]]
    else:
        keys = paths
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [p[order[first]] for p in paths], np.add.reduceat(weights[order], first)


class Automaton:
    """Weighted acyclic automaton of paths: for each depth the word into each state, the state before it, and the weight of the path that ends there."""

    def __init__(self, words: list[np.ndarray], parents: list[np.ndarray], final: list[np.ndarray]):
        self.words, self.parents, self.final = words, parents, final

    @classmethod
    def build(cls, paths: list[np.ndarray], weights: np.ndarray) -> Automaton:
        """From distinct paths in order: a path adds states only behind what it shares with the one before."""
        words, parents, final = [], [], []
        n = len(weights)
        new, state = np.zeros(n, bool), np.zeros(n, np.int64)
        new[:1] = True
        for depth in range(LONGEST):
            w = paths[depth]
            new[1:] |= w[1:] != w[:-1]
            there = new & (w != 0)
            words.append(w[there])
            parents.append(state[there])
            state = np.cumsum(there) - 1
            ends = w != 0
            if depth + 1 < LONGEST:
                ends &= paths[depth + 1] == 0
            f = np.zeros(int(there.sum()), np.int64)
            f[state[ends]] = weights[ends]
            final.append(f)
        return cls(words, parents, final)

    def children(self, depth: int) -> np.ndarray:
        """Where the children of each state of a depth begin among those of the next, with the end behind."""
        return np.searchsorted(self.parents[depth + 1], np.arange(len(self.words[depth]) + 1))

    def through(self) -> list[np.ndarray]:
        """Weight of all paths that pass each state."""
        out = [self.final[-1]]
        for depth in range(LONGEST - 2, -1, -1):
            total = np.concatenate([[0], np.cumsum(out[0])])[self.children(depth)]
            out.insert(0, self.final[depth] + np.diff(total))
        return out

    def prefixes(self, depth: int) -> list[np.ndarray]:
        """The words that lead to each state of a depth, the first word first."""
        out, state = [], np.arange(len(self.words[depth]))
        for d in range(depth, -1, -1):
            out.insert(0, self.words[d][state])
            state = self.parents[d][state]
        return out

    def paths(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The paths that have a weight, by depth of their ends."""
        columns: list[list[np.ndarray]] = [[] for _ in range(LONGEST)]
        weights = []
        for depth in range(LONGEST):
            ends = self.final[depth] > 0
            here = self.prefixes(depth)
            for d in range(LONGEST):
                columns[d].append(here[d][ends] if d <= depth else np.zeros(int(ends.sum()), np.uint64))
            weights.append(self.final[depth][ends])
        return [np.concatenate(c) for c in columns], np.concatenate(weights)

    @classmethod
    def union(cls, parts: list[Automaton]) -> Automaton:
        """All paths of the parts, the weights of equal ones summed."""
        paths, weights = zip(*(p.paths() for p in parts))
        return cls.build(*summed([np.concatenate([p[d] for p in paths]) for d in range(LONGEST)], np.concatenate(weights)))

    def compose(self, asked: list[np.ndarray]) -> np.ndarray:
        """The weight at the end of each path asked for, 0 where it leads nowhere; all are walked at once, depth by depth."""
        state, out = np.zeros(len(asked[0]), np.int64), np.zeros(len(asked[0]), np.int64)
        alive = np.arange(len(asked[0]))
        for depth in range(LONGEST):
            alive = alive[asked[depth][alive] != 0]
            seen = np.unique(self.words[depth])
            if not len(alive) or not len(seen):
                break
            arcs = self.parents[depth] * len(seen) + np.searchsorted(seen, self.words[depth])
            w = asked[depth][alive]
            code = np.minimum(np.searchsorted(seen, w), len(seen) - 1)
            want = state[alive] * len(seen) + code
            at = np.minimum(np.searchsorted(arcs, want), len(arcs) - 1)
            found = (seen[code] == w) & (arcs[at] == want)
            out[alive[~found]] = 0
            alive, at = alive[found], at[found]
            state[alive], out[alive] = at, self.final[depth][at]
        return out

    def pack(self) -> bytes:
        parts = []
        for depth in range(LONGEST):
            above = len(self.words[depth - 1]) if depth else 1
            for x in (self.words[depth], np.bincount(self.parents[depth], minlength=above), self.final[depth]):
                x = _small(x)
                parts += [b"%d %d " % (len(x), x.itemsize), x.tobytes()]
        return pa.compress(b"".join(parts), "zstd", asbytes=True), sum(map(len, parts))

    @classmethod
    def unpack(cls, packed: bytes, size: int) -> Automaton:
        raw, at, out = pa.decompress(packed, size, "zstd", asbytes=True), 0, ([], [], [])
        for k in range(3 * LONGEST):
            head = raw[at : at + 24].split(b" ", 2)
            n, width = int(head[0]), int(head[1])
            at += len(head[0]) + len(head[1]) + 2
            x = np.frombuffer(raw, f"<u{width}", n, at)
            at += n * width
            out[k % 3].append(np.repeat(np.arange(n), x) if k % 3 == 1 else x.astype(np.int64 if k % 3 else np.uint64))
        return cls(*out)


def tokens(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one block: lower-cased bytes, word starts and ends, 63-bit hashes of (language, word), whether the next word goes on in the same piece, and words before each row."""
    low = _LOWER[raw]
    kind = _KIND[low]
    starts, ends, of_row = _spans(kind == 0, offsets)
    langs = batch.column("lang").dictionary_encode()
    salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs.dictionary.to_pylist()], np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(of_row))
    h = hashes(low, starts, ends)
    if len(h):
        h = np.maximum(mix(h ^ salt[langs.indices.to_numpy()][row]) >> np.uint64(1), np.uint64(1))
    breaks = np.cumsum(kind == 2, dtype=np.int64)[starts]
    on = np.zeros(len(starts), bool)
    on[:-1] = (breaks[1:] == breaks[:-1]) & (row[1:] == row[:-1])
    return low, starts, ends, h, on, of_row


def paths_of(words: np.ndarray, on: np.ndarray) -> list[np.ndarray]:
    """For each depth the word there, of the paths that all words start."""
    out, alive = [words], np.ones(len(words), bool)
    for depth in range(1, LONGEST):
        w = np.zeros_like(words)
        alive = alive[: len(alive) - 1] & on[depth - 1 :][: max(len(alive) - 1, 0)]
        w[: len(alive)][alive] = words[depth:][alive]
        out.append(w)
    return out


def _prefix_hashes(paths: list[np.ndarray]) -> list[np.ndarray]:
    out = [mix(paths[0])]
    for w in paths[1:]:
        out.append(mix(out[-1] * np.uint64(_P) + w))
    return out


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def vocabulary(docs: DataFrame) -> DataFrame:
    """lang, word, kind, h, n: of each word (kind 1) its count, of each language (0) all its words; of every 61st path its prefixes of two and three words (2, 3)."""
    schema = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = seen = 0

        def rows() -> Iterator[pa.RecordBatch]:
            all_rows = pa.concat_tables(held).group_by(["kind", "lang", "word", "h"]).aggregate([("n", "sum")]).rename_columns(["kind", "lang", "word", "h", "n"])
            yield from all_rows.select(schema.names).cast(schema).to_batches(1 << 18)

        for block, raw, offsets in blocks(batches):
            low, starts, ends, h, on, of_row = tokens(block, raw, offsets)
            if not len(h):
                continue
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            row = np.searchsorted(of_row, first, "right") - 1
            data = low.tobytes()
            word = pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())], pa.string())
            langs = block.column("lang")
            held.append(pa.table([pa.array(np.ones(len(u), np.int32)), langs.take(pa.array(row)), word, pa.array(u.astype(np.int64)), pa.array(n)], schema=schema))
            totals = pa.table([langs, pa.array(np.diff(of_row))], ["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
            none = pa.nulls(len(totals), pa.string())
            held.append(pa.table([pa.array(np.zeros(len(totals), np.int32)), totals["lang"], none, pa.nulls(len(totals), pa.int64()), totals["n_sum"]], schema=schema))
            sample = slice(-seen % EVERY, None, EVERY)
            seen += len(h)
            paths = paths_of(h, on)
            for depth, p in list(enumerate(_prefix_hashes(paths[:3])))[1:]:
                p = p[sample][paths[depth][sample] != 0]
                none = pa.nulls(len(p), pa.string())
                held.append(pa.table([pa.array(np.full(len(p), depth + 1, np.int32)), none, none, pa.array(p.view(np.int64)), pa.array(np.ones(len(p), np.int64))], schema=schema))
            size += len(u)
            if size > HELD_WORDS:
                yield from rows()
                held, size = [], 0
        if held:
            yield from rows()

    return _text(docs).mapInArrow(run, "kind int, lang string, word string, h long, n long").groupBy("kind", "lang", "word", "h").agg(F.sum("n").alias("n"))


def _shards(docs: DataFrame, known, complete: bool, hot, n_ranges: int) -> DataFrame:
    """range, automaton, size: what each shard of the text has below each range of prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_hash, ids = known.value
        by_id = np.concatenate([np.zeros(1, np.uint64), by_hash[np.argsort(ids)]])

        def numbered(h: np.ndarray) -> np.ndarray:
            if not len(by_hash):
                return np.zeros_like(h) if complete else h | _RAW
            at = np.minimum(np.searchsorted(by_hash, h), len(by_hash) - 1)
            return np.where(by_hash[at] == h, ids[at].astype(np.uint64), np.uint64(0) if complete else h | _RAW)

        def made(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            paths = [np.concatenate([x[d] for x in held]) for d in range(LONGEST)]
            paths, weights = summed(paths, np.ones(len(paths[0]), np.int64))
            words = [np.where(p & _RAW, p & ~_RAW, by_id[np.where(p & _RAW, 0, p).astype(np.int64)]) for p in paths]
            prefix = _prefix_hashes(words)
            cut = _depth(words[0], prefix, hot.value)
            to = np.choose(cut - 1, [p % np.uint64(n_ranges) for p in prefix]).astype(np.int64) * LONGEST + cut - 1
            order = np.argsort(to, kind="stable")
            to = to[order]
            first = np.flatnonzero(np.diff(to, prepend=-1))
            out, size = ([], [], [], []), 0
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(to)]):
                part = order[a:b]
                packed, n = Automaton.build([p[part] for p in paths], weights[part]).pack()
                for c, x in zip(out, (int(to[a]) // LONGEST, int(to[a]) % LONGEST + 1, packed, n)):
                    c.append(x)
                size += len(packed)
                if size > 4 << 20:
                    yield batch(out)
                    out, size = ([], [], [], []), 0
            if out[0]:
                yield batch(out)

        def batch(out: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["range", "cut", "automaton", "size"])

        held, n = [], 0
        for block, raw, offsets in blocks(batches):
            *_, h, on, _ = tokens(block, raw, offsets)
            ids_here = numbered(h)
            on[:-1] &= (ids_here[:-1] != 0) & (ids_here[1:] != 0)
            paths = paths_of(ids_here, on)
            some = paths[1] != 0
            held.append([p[some] for p in paths])
            n += int(some.sum())
            if n > SHARD:
                yield from made(held)
                held, n = [], 0
        if n:
            yield from made(held)

    return _text(docs).mapInArrow(run, "range long, cut int, automaton binary, size long")


def _depth(first: np.ndarray, prefix: list[np.ndarray], hot: list[np.ndarray]) -> np.ndarray:
    """How many words of each path choose its range: one, and one more behind each frequent prefix."""
    cut, more = np.ones(len(first), np.int64), np.ones(len(first), bool)
    for keys, values in zip(hot, (first, *prefix[1:])):
        if not len(keys):
            break
        more &= keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values
        cut += more
    return cut


def counts(docs: DataFrame, scratch: Scratch, least: int, most_words: int = MOST_WORDS, range_size: int = RANGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, h, n) and phrases of two to four words (w1 to w4, f) that occur ``least`` times, and the words of each language (lang, n)."""
    spark = docs.sparkSession
    with arrow_rows(spark, TEXTS):
        all_words = scratch.keep(vocabulary(docs).where((F.col("kind") == 0) | ((F.col("kind") == 1) & (F.col("n") >= least)) | ((F.col("kind") > 1) & (F.col("n") * EVERY > range_size // 8))))
    words = all_words.where("kind = 1").select("lang", "word", "h", "n")
    totals = all_words.where("kind = 0").select("lang", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    n_words = words.count()
    complete = n_words <= most_words
    top = (words if complete else words.orderBy(F.desc("n"), "h").limit(most_words)).select("h", "n").toArrow()
    h = top["h"].to_numpy().astype(np.uint64)
    ids = np.empty(len(h), np.int64)
    ids[np.lexsort((h, -top["n"].to_numpy()))] = np.arange(1, len(h) + 1)
    order = np.argsort(h)
    known = spark.sparkContext.broadcast((h[order], ids[order].astype(np.uint32)))
    level = max(range_size // 8, total // MOST_HOT)
    hot = [all_words.where((F.col("kind") == k) & (F.col("n") * (EVERY if k > 1 else 1) > level)).select("h").orderBy("h").limit(MOST_HOT).toArrow()["h"].to_numpy() for k in (1, 2, 3)]
    hot_sent = spark.sparkContext.broadcast([np.sort(x.astype(np.int64).view(np.uint64)) for x in hot])
    n_ranges = max(1, math.ceil(total / range_size))

    def unite(table: pa.Table) -> pa.Table:
        by_hash, ids = known.value
        by_id = np.concatenate([np.zeros(1, np.uint64), by_hash[np.argsort(ids)]])
        cuts = table["cut"].to_numpy()
        parts = table["automaton"]
        sizes = table["size"].to_pylist()
        out: list[list[np.ndarray]] = [[] for _ in range(LONGEST + 1)]
        for cut in np.unique(cuts):
            whole = Automaton.union([Automaton.unpack(parts[i].as_py(), sizes[i]) for i in np.flatnonzero(cuts == cut).tolist()])
            for depth, f in list(enumerate(whole.through()))[1:]:
                # a state above the cut has other paths in other ranges
                there = np.flatnonzero((f >= least) | (depth + 1 < cut))
                here = whole.prefixes(depth)
                for d in range(LONGEST):
                    w = here[d][there] if d <= depth else np.zeros(len(there), np.uint64)
                    out[d].append(np.where(w & _RAW, w & ~_RAW, by_id[np.where(w & _RAW, 0, w).astype(np.int64)]).astype(np.int64))
                out[LONGEST].append(f[there])
        return pa.table([np.concatenate(x) for x in out], [*PATH, "f"])

    found = _shards(docs, known, complete, hot_sent, n_ranges).groupBy("range").applyInArrow(unite, ", ".join(f"{w} long" for w in PATH) + ", f long")
    phrases = found.groupBy(*PATH).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    with arrow_rows(spark, TEXTS):
        return words, scratch.keep(phrases), totals


PATH = [f"w{d}" for d in range(1, LONGEST + 1)]


def part_counts(words: DataFrame, phrases: DataFrame, n_ranges: int) -> DataFrame:
    """w1 to w4 and a of each phrase, with l1 to l3 and r1 to r3: how often its first one to three words and what is behind them occur."""
    length = sum((F.col(w) != 0).cast("int") for w in PATH)

    def part(first: int, last) -> F.Column:
        """Words first to last (counted from 1) as a path."""
        return F.array(*(F.when(F.lit(first + d) <= last, F.col(PATH[first + d - 1])).otherwise(F.lit(0).cast("long")) if first + d <= LONGEST else F.lit(0).cast("long") for d in range(LONGEST)))

    asked = F.array(*(F.struct(F.lit(side * 4 + k).alias("which"), (part(1, F.lit(k)) if side == 0 else part(k + 1, length)).alias("p")) for k in range(1, LONGEST) for side in (0, 1)))
    asking = phrases.withColumn("m", length).select(*PATH, F.col("f").alias("a"), F.explode(F.filter(asked, lambda x: F.col("m") > x["which"] % 4)).alias("x"))
    asking = asking.select(*PATH, "a", "x.which", *(F.col("x.p")[d].alias(f"q{d + 1}") for d in range(LONGEST))).withColumn("salt", F.pmod(F.hash(*PATH), F.lit(SALT)))
    counted = words.select(F.col("h").alias("q1"), *(F.lit(0).cast("long").alias(f"q{d}") for d in range(2, LONGEST + 1)), F.col("n").alias("f")).unionByName(phrases.toDF(*(f"q{d}" for d in range(1, LONGEST + 1)), "f"))
    counted = counted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    place = F.pmod(F.xxhash64("q1", "q2"), F.lit(n_ranges)).alias("range")

    def answer(asked: pa.Table, counted: pa.Table) -> pa.Table:
        q = [f"q{d}" for d in range(1, LONGEST + 1)]
        known = Automaton.build(*summed([counted[c].to_numpy().astype(np.uint64) for c in q], counted["f"].to_numpy()))
        return asked.select([*PATH, "a", "which"]).append_column("f", pa.array(known.compose([asked[c].to_numpy().astype(np.uint64) for c in q])))

    left, right = (t.withColumn("range", place).groupBy("range", "salt") for t in (asking, counted))
    answers = left.cogroup(right).applyInArrow(answer, ", ".join(f"{w} long" for w in PATH) + ", a long, which int, f long")
    return answers.groupBy(*PATH, "a").agg(*(F.max(F.when(F.col("which") == side * 4 + k, F.col("f"))).alias(f"{'lr'[side]}{k}") for side in (0, 1) for k in range(1, LONGEST)))


def scored(parts: DataFrame) -> DataFrame:
    """a, l, r and score of each phrase at its lowest-scoring cut, the first of equals."""
    score = lambda k: F.expr(f"cast(2000000 * cast(a as decimal(19, 0)) div cast(l{k} + r{k} as decimal(19, 0)) as long)")
    cuts = F.array_compact(F.array(*(F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST))))
    return parts.select(*PATH, "a", F.array_min(cuts).alias("x")).select(*PATH, "a", "x.l", "x.r", "x.score")


def covered(phrases: DataFrame, share: int) -> DataFrame:
    """The phrases (w1 to w4) whose words stand inside a longer phrase that has ``share`` percent of their count."""
    inner = [(at, m) for m in range(2, LONGEST) for at in range(LONGEST - m + 1)]
    zero = F.lit(0).cast("long")
    subs = F.array(*(F.struct(*((F.col(PATH[at + d]) if d < m else zero).alias(w) for d, w in enumerate(PATH)), F.lit(at + m).alias("end"), F.lit(m).alias("m")) for at, m in inner))
    length = sum((F.col(w) != 0).cast("int") for w in PATH)
    inside = phrases.select(length.alias("length"), F.col("f").alias("longer"), F.inline(subs)).where("end <= length and m < length")
    most = inside.groupBy(*PATH).agg(F.max("longer").alias("longer"))
    return phrases.join(most, PATH).where(F.col("longer") * 100 >= F.col("f") * share).select(*PATH)


def collocations(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000, most_words: int = MOST_WORDS, range_size: int = RANGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language."""
    scratch = Scratch(docs.sparkSession)
    words, phrases, totals = counts(docs, scratch, least, most_words, range_size)
    n = phrases.count()
    left = phrases.join(covered(phrases, share), PATH, "left_anti")
    good = scored(part_counts(words, phrases, max(1, math.ceil(n / 500_000)))).join(left, PATH, "left_semi")
    text = words.select("h", "word")
    named = good.join(words.select(F.col("h").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    named = named.withColumn("salt", F.pmod(F.xxhash64(*PATH), F.lit(max(1, math.isqrt(n // top)))))
    order = [F.desc("score"), F.desc("a")]
    first = named.withColumn("place", F.rank().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top).drop("place")
    for d in range(2, LONGEST + 1):
        first = first.join(text.toDF(f"w{d}", f"t{d}"), f"w{d}", "left")
    first = first.withColumn("phrase", F.concat_ws(" ", *(f"t{d}" for d in range(1, LONGEST + 1))))
    for key in (("lang", "salt"), ("lang",)):
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
