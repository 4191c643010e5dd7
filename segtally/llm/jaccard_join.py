"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A text is the set of its shingles of ``WORDS`` words, in one global order: hashes
ascending, with the most frequent shingles behind all others in order of
frequency. The order is cut into fragments. Two sets can only link if they share
a shingle in their first quarters (prefixes), whose places bound what they can
have in common; these lists give the candidates. For a candidate pair the overlap
is counted fragment by fragment, in separate rows, and summed per pair.

A node is a distinct set, named by a 128-bit digest, so equal sets are one node
before anything is joined. Prefix shingles travel packed, by bucket; those that
one node alone holds go at once, and of lists with the same members one stays.
A list that more than ``HOT_LIST`` sets hold is never gathered: its members are
rows from the start. Small lists give all their pairs; in each round every other list
is compared with some of its members, and what that links is one component. After the
rounds, the members of the lists that are still in different components are compared
block by block.
So a group of near copies costs its size and not its square, as long as it hangs
together, and no link between different texts is lost for the components.
Candidates must fit by size, by the places of their shared shingle, and by
bitmaps: sets whose parities of 1,024 bits, for large sets also of 8,192 bits, differ
in more bits than a link leaves single shingles cannot link. Components come from alternating large and small stars.

Defined cases: null or wordless texts have an empty set and are their own
component; rows of one id are separate nodes if their texts differ, and of one
component if they link; a null id is its own component, null; ids are integers;
equal rows get equal results; a text of any length is one row of one task, which
holds about ten times its bytes; an empty table gives an empty table; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch, arrow_rows, blocks, cut, free_name, hashes, mix, windows, words

WORDS = 5
#: A link needs 100 * common >= PERCENT * union.
PERCENT = 75
#: Shingles set behind all others; only their order depends on it, never the result.
FREQUENT = 200_000
#: Lists of frequent shingles with more members than this are rows from the start.
HOT_LIST = 100_000
FRAGMENTS = 4
#: Members that each list is compared with in each round (in further ones as in the last), and turns of stars behind a round.
HUBS, TURNS = (1, 6), 2
#: More rounds follow while more than MANY pairs a member are left and a round settles the share PAYS of them.
MANY, PAYS = 2000, 0.25
#: Members of a list in a block of the last round.
BLOCK_MEMBERS = 4096
#: Lists of at most so many members give all their pairs at once.
SMALL_LIST = 4
#: Lists of more members than this are compared with several members before blocks of them are compared.
HUB_LIST = 64
#: Bitmaps have so many 64-bit words, and a second one for sets of more than WIDE_FROM shingles so many.
LONGS, WIDE, WIDE_FROM = 16, 128, 1000
#: Fewer pairs than this (40 bytes each) are sent to every executor; more are joined by a shuffle.
BROADCAST_PAIRS = 400_000
BUCKET_BYTES = 48 << 20
GROUP_ROWS = 200_000


def sets(raw: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    low, s, e, at = words(raw, offsets)
    h = hashes(low, s, e)
    w = windows(h, size)
    for i, j in zip(at[:-1], at[1:]):
        if j - i >= size:
            yield np.unique(w[i : j - size + 1])
        else:
            yield mix(windows(h[i:j], j - i) + np.uint64(j - i)) if j > i else w[:0]


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def need(n: np.ndarray | int):
    """Common shingles that a set of n needs with any partner."""
    return -(-n * PERCENT // 100)


def parities(s: np.ndarray, longs: int) -> np.ndarray:
    """Whether an even or odd number of hashes falls on each of 64 * longs bits."""
    return np.packbits((np.bincount((s & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1).astype(bool)).view(np.int64)


def _columns(rows: tuple[list, ...] | list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names)


def _nodes(docs: DataFrame, least: int = 4, held: int = 2_000_000) -> DataFrame:
    """One scan: rows doc_id, h (digest of id and text), k (digest of the set), n, bits and wide (parities of hash values); and rows shingle, times of what blocks hold often."""
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    names = ["doc_id", "h", "k", "n", "bits", "wide", "shingle", "times"]

    def often(parts: list) -> pa.RecordBatch:
        u, n = np.unique(np.concatenate(parts), return_counts=True)
        none = [None] * int((n >= least).sum())
        return _columns([none] * 6 + [u[n >= least].view(np.int64), n[n >= least]], kinds, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count = [np.zeros(0, np.uint64)], 0
        for batch, raw, offsets in blocks(batches):
            ids, out, data = batch.column("doc_id").to_pylist(), [], raw.tobytes()
            for i, x, y, s in zip(ids, offsets[:-1], offsets[1:], sets(raw, offsets)):
                bits, wide = parities(s, LONGS) if len(s) else None, parities(s, WIDE) if len(s) > WIDE_FROM else None
                text = hashlib.md5(b"%s:" % (b"" if i is None else b"%d" % i))
                text.update(data[x:y])
                out.append((i, text.digest(), digest(s), len(s), bits, wide, None, None))
                parts.append(s)
                count += len(s)
            yield _columns(list(zip(*out)), kinds, names)
            if count > held:
                yield often(parts)
                parts, count = [np.zeros(0, np.uint64)], 0
        yield often(parts)
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, h binary, k binary, n long, bits array<long>, wide array<long>, shingle long, times long")


def row_key(docs: DataFrame) -> Column:
    """The digest of id and text that ``_nodes`` gives a row."""
    return F.unhex(F.md5(F.concat(F.coalesce(docs["doc_id"].cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(docs["text"], F.lit(""))).cast("binary")))


def _postings(docs: DataFrame, scratch: Scratch, often: np.ndarray, times: np.ndarray, n_buckets: int, hot: int = HOT_LIST) -> tuple[DataFrame, DataFrame]:
    """list, k, n, pos, large: the sets that share a shingle of their prefixes, one list for equal members; and pairs a, b of small lists. often: shingles by ascending frequency."""
    order = np.argsort(often)
    shared = docs.sparkSession.sparkContext.broadcast((often[order], order + 1, times[order] > hot))  # 17 bytes x FREQUENT
    sent = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "k", "n", "times", "t", "pos"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank, hot_ = shared.value
        for batch, raw, offsets in blocks(batches):
            found: dict[bytes, np.ndarray] = {}
            for s in sets(raw, offsets):
                if len(s):
                    found.setdefault(digest(s), s)
            if not found:
                continue
            keys, n, prefix = np.frombuffer(b"".join(found), "V16"), np.array([len(s) for s in found.values()]), []
            for s in found.values():
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    s = s[np.argsort(np.where(common[at] == s, rank[at], 0), kind="stable")]
                prefix.append(s[: len(s) - need(len(s)) + 1])
            length = np.array([len(p) for p in prefix])
            t, row = np.concatenate(prefix), np.repeat(np.arange(len(prefix)), length)
            pos = np.minimum(np.arange(len(t)) - np.repeat(np.cumsum(length) - length, length), 65535).astype(np.uint16)  # a smaller place only lets more candidates through
            b = (mix(t) % np.uint64(n_buckets)).astype(np.int64)
            if hot_.any():
                at = np.minimum(np.searchsorted(common, t), len(common) - 1)
                b[(common[at] == t) & hot_[at]] = -1
            o = np.argsort(b, kind="stable")
            edges = np.flatnonzero(np.diff(b[o], prepend=-2))
            rows = []
            for i, j in zip(edges, np.append(edges[1:], len(o))):
                sel = o[i:j]
                r, times_ = np.unique(row[sel], return_counts=True)
                rows.append((int(b[sel[0]]), keys[r].tobytes(), n[r].astype(np.int32).tobytes(), times_.astype(np.int32).tobytes(), t[sel].tobytes(), pos[sel].tobytes()))
            yield _columns(list(zip(*rows)), sent, names)

    def opened(tables) -> tuple[np.ndarray, ...]:
        get = lambda c, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in tables[c]])
        times_ = get("times", np.int32)
        return np.repeat(get("k", "V16"), times_), np.repeat(get("n", np.int32), times_).astype(np.int64), get("t", np.uint64), get("pos", np.uint16).astype(np.int64)

    def lists(table: pa.Table) -> pa.Table:
        k, n, t, pos = opened(table)
        size = np.unique(t, return_inverse=True, return_counts=True)
        keep = size[2][size[1]] > 1
        k, n, t, pos = k[keep], n[keep], t[keep], pos[keep]
        high, low = (k.view(np.uint64).reshape(-1, 2)[:, c] for c in (0, 1))
        o = np.lexsort((low, high, t))
        k, n, t, pos, high, low = (x[o] for x in (k, n, t, pos, high, low))
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])])[: len(t)]  # copies in several blocks
        k, n, t, pos, high, low = (x[new] for x in (k, n, t, pos, high, low))
        out: list[tuple] = []
        if len(t):
            start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            group = np.cumsum(np.concatenate([[True], t[1:] != t[:-1]])) - 1
            most = ((100 + PERCENT) * (n - pos) - PERCENT * n) // PERCENT  # the largest partner that a member can have
            keep = most >= np.minimum.reduceat(n, start)[group]
            k, n, t, pos, high, low, group = (x[keep] for x in (k, n, t, pos, high, low, group))
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
            end = np.append(start[1:], len(group))
            a, b = (np.add.reduceat(mix(x + np.uint64(c)), start) if len(start) else start for c, x in ((1, high), (2, low)))
            size = end - start
            pairs = [np.zeros(0, "V32")]
            for m in range(2, SMALL_LIST + 1):
                at = start[size == m]
                for i in range(m):
                    for j in range(i + 1, m):
                        x, y = at + i, at + j
                        ok = np.minimum(n[x] - pos[x], n[y] - pos[y]) * (100 + PERCENT) >= PERCENT * (n[x] + n[y])
                        pairs.append(np.stack([k[x[ok]], k[y[ok]]], 1).reshape(-1).view("V32"))  # members of a list are in order
            both = np.unique(np.concatenate(pairs))
            out += [(None, None, None, None, None, None, None, None, both[i : i + 4000].tobytes()) for i in range(0, len(both), 4000)]
            for g in np.flatnonzero(size > SMALL_LIST):
                i, j = start[g], end[g]
                out.append((int(t[i : i + 1].view(np.int64)[0]), int(a[g : g + 1].view(np.int64)[0]), int(b[g : g + 1].view(np.int64)[0]), int(j - i), int(pos[i]), k[i:j].tobytes(), n[i:j].tobytes(), pos[i:j].tobytes(), None))
        return pa.Table.from_batches([_columns(list(zip(*out)) or [[]] * 9, [pa.int64()] * 5 + [pa.binary()] * 4, ["list", "sign1", "sign2", "size", "first", "k", "n", "pos", "pairs"])])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                k = batch.column("k")[r].as_py()
                yield _columns([[batch.column("list")[r].as_py()] * (len(k) // 16), [k[i : i + 16] for i in range(0, len(k), 16)]] + [np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in ("n", "pos")] + [[len(k) > 16 * HUB_LIST] * (len(k) // 16)], [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()], ["list", "k", "n", "pos", "large"])

    def straight(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                k, n, t, pos = opened(batch.to_pydict() and {c: batch.column(c) for c in batch.schema.names})
                yield _columns([t.view(np.int64), [x.tobytes() for x in k], n, pos, [True] * len(k)], [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()], ["list", "k", "n", "pos", "large"])

    def two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("pairs"):
                x = x.as_py()
                yield _columns([[x[i + c : i + c + 16] for i in range(0, len(x), 32)] for c in (0, 16)], [pa.binary()] * 2, ["a", "b"])

    made = "list long, k binary, n long, pos long, large boolean"
    dealt = docs.select("text").mapInArrow(deal, "bucket long, k binary, n binary, times binary, t binary, pos binary")
    found = scratch.keep(dealt.where("bucket >= 0").groupBy("bucket").applyInArrow(lists, "list long, sign1 long, sign2 long, size long, first long, k binary, n binary, pos binary, pairs binary"))
    # places in the global order only fall together, so of equal lists the one whose shingle comes first bounds every pair
    one = found.where("list is not null").groupBy("sign1", "sign2", "size").agg(F.min_by(F.struct("list", "k", "n", "pos"), F.struct("first", "list")).alias("l")).select("l.*")
    rows = one.mapInArrow(members, made)
    if (times > hot).any():
        rows = rows.unionByName(dealt.where("bucket < 0").mapInArrow(straight, made).distinct())
    return scratch.keep(rows), found.where("pairs is not null").select("pairs").mapInArrow(two, "a binary, b binary").distinct()


def _close(n: str = "n", pos: str = "pos", n2: str = "n2", pos2: str = "pos2") -> Column:
    """Whether sets of sizes n and n2 whose first common shingle is at pos and pos2 can link."""
    return F.expr(f"least({n} - {pos}, {n2} - {pos2}) * {100 + PERCENT} >= {PERCENT} * ({n} + {n2})")


def _alike() -> Column:
    """Whether sets of sizes n and n2 with bitmaps bits, wide and bits2, wide2 can link."""
    most = (100 - PERCENT) * (F.col("n") + F.col("n2"))
    apart = reduce(add, (F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("bits2")[k])) for k in range(LONGS)))
    wide = F.aggregate(F.zip_with("wide", "wide2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return (apart * (100 + PERCENT) <= most) & F.coalesce(wide * (100 + PERCENT) <= most, F.lit(True))


def _links(pairs: DataFrame, n: int, docs: DataFrame, reps: DataFrame, limit: int = BROADCAST_PAIRS) -> DataFrame:
    """a, b of the pairs that link: overlaps of each fragment of the order, summed per pair.

    The fragments of a's set are made next to the list of its partners, so only they move, to the partner's.
    """
    small = F.broadcast if n <= limit else lambda df: df  # about 40 bytes a pair
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    names = reps.select("k", "doc")
    lots = F.pmod(F.xxhash64("b"), F.lit(1 + n // 100_000))  # so no list of partners grows with the pairs
    partners = pairs.groupBy(F.col("a").alias("k"), lots.alias("lot")).agg(F.collect_list("b").alias("with")).join(names, "k").select("doc", "k", "with")
    ends = pairs.select(F.col("b").alias("k")).distinct().join(names, "k").select("doc", "k", F.lit(None).cast("array<binary>").alias("with"))
    kinds = [pa.binary(), pa.binary(), pa.int32(), pa.binary()]

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(FRAGMENTS + 1, dtype=np.uint64) * np.uint64((1 << 32) // FRAGMENTS)
        for batch, raw, offsets in blocks(batches, 1 << 19):
            rows: tuple[list, ...] = [], [], [], []
            for k, to, s in zip(batch.column("k").to_pylist(), batch.column("with").to_pylist(), sets(raw, offsets)):
                if digest(s) != k:
                    continue  # another text under the same id
                cuts = np.searchsorted(s >> np.uint64(32), edges)
                parts = [s[cuts[f] : cuts[f + 1]].tobytes() for f in range(FRAGMENTS)]
                for b in to or [k]:
                    for out, values in zip(rows, ([k] * FRAGMENTS, [b] * FRAGMENTS, range(FRAGMENTS), parts)):
                        out.extend(values)
                    if len(rows[0]) > 4000:
                        yield _columns(rows, kinds, ["a", "b", "frag", "part"])
                        rows = [], [], [], []
            yield _columns(rows, kinds, ["a", "b", "frag", "part"])
        pa.default_memory_pool().release_unused()

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = ([np.frombuffer(v.as_py(), np.uint64) for v in b.column(c)] for c in ("x", "y"))
            counted = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("frag"), pa.array(counted, pa.int64()), pa.array([len(p) + len(q) for p, q in zip(x, y)], pa.int64())], ["a", "b", "frag", "common", "both"])

    made = "a binary, b binary, frag int, part binary"
    left = d.join(small(partners), "doc").mapInArrow(fragments, made).withColumnRenamed("part", "x")
    right = d.join(small(ends), "doc").mapInArrow(fragments, made).select("b", "frag", F.col("part").alias("y")).dropDuplicates(["b", "frag"])
    counted = left.join(right, ["b", "frag"]).select("a", "b", "frag", "x", "y").mapInArrow(common, "a binary, b binary, frag int, common long, both long")
    one = counted.groupBy("a", "b", "frag").agg(F.max("common").alias("common"), F.max("both").alias("both"))  # a row of the table may stand in it twice
    summed = one.groupBy("a", "b").agg(F.sum("common").alias("common"), F.sum("both").alias("both"))
    return summed.where(100 * F.col("common") >= PERCENT * (F.col("both") - F.col("common"))).select("a", "b")


def contract(links: DataFrame, turns: int | None = None) -> DataFrame:
    """Edges u > v with the components of links a, b: alternating stars, until nothing changes (then v is the smallest node) or for some turns."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state = None
    while turns is None or turns > 0:
        if turns is None:
            now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == state or not now[0]:
                break
            state = now
        else:
            turns -= 1
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = cut(small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
    return edges


def _named(edges: DataFrame) -> DataFrame:
    """node, component of the edges: of stars the smallest node; while they are none yet, some node of the same component."""
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).groupBy("node").agg(F.min("component").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of links a, b."""
    return _named(contract(links))


def _rest(named: DataFrame, open_: DataFrame, bits: DataFrame, n_rows: int, block: int = BLOCK_MEMBERS) -> DataFrame:
    """a, b of the members of a list that are in different components and can link by places and bitmaps, found block by block. open_: list, size; bits: k, bits."""
    parts = F.ceil(F.col("size") / block).cast("int")
    part = F.pmod(F.xxhash64("k", F.lit("part")), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j")
    rows = named.join(open_.select("list", parts.alias("parts")), "list").join(bits, "k").withColumn("i", part).select("list", "k", "n", "pos", "comp", "bits", "i", other)
    rows = rows.select("list", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "i", "k", "n", "pos", "comp", "bits")
    lot = F.pmod(F.xxhash64("list", "x", "y"), F.lit(max(16, n_rows // GROUP_ROWS)))

    def compare(t: pa.Table) -> pa.Table:
        key, x, y, i, n, pos = (t[c].to_numpy().astype(np.int64) for c in ("list", "x", "y", "i", "n", "pos"))
        k, comp = (np.frombuffer(b"".join(t[c].to_pylist()), "V16") for c in ("k", "comp"))
        comp, node = (np.unique(v, return_inverse=True)[1] for v in (comp, k))
        bitmap = t["bits"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
        o = np.lexsort((y, x, key))
        cuts = np.flatnonzero(np.concatenate([[True], (key[o][1:] != key[o][:-1]) | (x[o][1:] != x[o][:-1]) | (y[o][1:] != y[o][:-1])]))
        found = [np.zeros((0, 2), np.int64)]
        for lo, hi in zip(cuts, np.append(cuts[1:], len(o))):
            at = o[lo:hi]
            same_block = x[at[0]] == y[at[0]]
            here, there = (at, at) if same_block else (at[i[at] == x[at]], at[i[at] == y[at]])
            for p in range(0, len(here), 256):
                h = here[p : p + 256, None]
                ok = (comp[h] != comp[there]) & (np.minimum(n[h] - pos[h], n[there] - pos[there]) * (100 + PERCENT) >= PERCENT * (n[h] + n[there]))
                a, b = np.nonzero(ok)
                for q in range(0, len(a), 50_000):
                    u, v = h[a[q : q + 50_000], 0], there[b[q : q + 50_000]]
                    apart = np.bitwise_count(bitmap[u] ^ bitmap[v]).sum(1, dtype=np.int64)
                    ok2 = (apart * (100 + PERCENT) <= (100 - PERCENT) * (n[u] + n[v])) & (node[u] != node[v])
                    found.append(np.stack([u[ok2], v[ok2]], 1))
        pair = np.concatenate(found)
        pair = pair[np.unique(np.sort(node[pair], 1), axis=0, return_index=True)[1]] if len(pair) else pair
        return pa.table({c: pa.array([x.tobytes() for x in k[pair[:, i]]], pa.binary()) for i, c in enumerate("ab")})

    return rows.withColumn("lot", lot).groupBy("lot").applyInArrow(compare, "a binary, b binary")


def labelled(docs: DataFrame, scratch: Scratch, frequent: int = FREQUENT, hot: int = HOT_LIST, block: int = BLOCK_MEMBERS) -> DataFrame:
    """doc_id, h, n, component_id of every row of docs; h is ``row_key``."""
    with arrow_rows(docs.sparkSession, 2000):
        return _labelled(docs, scratch, frequent, hot, block)


def _labelled(docs: DataFrame, scratch: Scratch, frequent: int, hot: int, block: int) -> DataFrame:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    scan = scratch.keep(_nodes(docs))
    rows = scan.where("h is not null").select("doc_id", "h", "k", "n")
    top = scan.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "shingle").limit(frequent).toArrow()  # 16 bytes x FREQUENT
    often, times = (top[c].to_numpy()[::-1] for c in ("shingle", "times"))
    real = F.expr("n > 0 and doc_id is not null")
    posts, few = _postings(docs.where("doc_id is not null"), scratch, often.astype(np.int64).view(np.uint64), times, max(12, total // BUCKET_BYTES), hot)
    n_posts, few = posts.count(), scratch.keep(few)
    met_at_all = posts.select("k").union(few.select("a")).union(few.select("b")).distinct()
    reps = scratch.keep(scan.where(real).groupBy("k").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("wide").alias("wide")).join(met_at_all, "k", "left_semi"))
    bits, bits2 = reps.select(F.col("k").alias("a"), "n", "bits", "wide"), reps.select(F.col("k").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"), F.col("wide").alias("wide2"))
    fit = lambda pairs: pairs.join(bits, "a").join(bits2, "b").where(_alike()).select("a", "b")
    edges = tried = docs.sparkSession.createDataFrame([], "a binary, b binary")
    turn, last, named, before = 0, False, None, None
    while not last:
        old = named
        known = _named(edges.toDF("u", "v"))
        named = scratch.keep(posts.join(known, posts.k == known.node, "left").select("list", "k", "n", "pos", "large", F.coalesce("component", "k").alias("comp")) if turn else posts.withColumn("comp", F.col("k")))
        if old is not None:
            scratch.drop(old)
        each = named.groupBy("list", "comp").agg(F.count("*").alias("m"))
        open_ = each.groupBy("list").agg(F.sum("m").alias("size"), F.count("*").alias("comps"), F.sum(F.col("m").cast("decimal(38,0)") * F.col("m")).alias("squares")).where("comps > 1")
        if turn >= len(HUBS):  # more rounds only where they spare many pairs
            left = float(open_.agg(F.sum((F.col("size").cast("decimal(38,0)") * F.col("size") - F.col("squares")) / 2)).first()[0] or 0)
            last = left <= MANY * n_posts or before is not None and left > (1 - PAYS) * before
            before = left
        if last:
            pairs = fit(_rest(named, open_, reps.select("k", "bits"), n_posts, block))
        else:
            order = lambda i: F.xxhash64("k", F.lit(64 * turn + i))
            hubs = [F.min(F.struct(order(i).alias("o"), "k", "n", "pos", "comp")) for i in range(HUBS[min(turn, len(HUBS) - 1)])]
            among = named.where("large") if turn else named
            chosen = among.groupBy("list").agg(F.min("comp").alias("p"), F.max("comp").alias("q"), F.array_distinct(F.array(*hubs)).alias("hubs")).where("p != q").select("list", "hubs")
            met = among.join(chosen, "list").select("k", "n", "pos", "comp", F.explode("hubs").alias("hub"))
            met = met.select("k", "n", "pos", "comp", F.col("hub.k").alias("k2"), F.col("hub.n").alias("n2"), F.col("hub.pos").alias("pos2"), F.col("hub.comp").alias("comp2"))
            pairs = met.where((F.col("comp") != F.col("comp2")) & _close()).select(F.col("k").alias("a"), F.col("k2").alias("b")).distinct()
            pairs = fit(pairs if turn else pairs.union(few))
        # hubs stay on the side of b; of a pair of two hubs one direction is enough
        pairs = pairs.groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(F.min(F.struct("a", "b")).alias("p")).select("p.*")
        pairs = scratch.keep(pairs.join(tried, ["a", "b"], "left_anti") if turn else pairs)
        tried = tried.union(pairs).union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        n_pairs = pairs.count()
        new = scratch.keep(_links(pairs, n_pairs, docs, reps)) if n_pairs else pairs
        last = last or not n_posts
        edges = contract(edges.toDF("a", "b").union(new), None if last else TURNS)  # between rounds labels need not be final
        turn += 1
    scratch.drop_all_but(scan)
    known = _named(edges.toDF("u", "v"))
    ids = rows.where(real).groupBy("k").agg(F.min("doc_id").alias("doc"))
    parts = ids.join(known, ids.k == known.node, "left").select("k", "doc", F.coalesce("component", "k").alias("comp"))
    label = parts.join(parts.groupBy("comp").agg(F.min("doc").alias("component_id")), "comp").select("k", "component_id")
    label = label.withColumnRenamed("k", "own")
    named_rows = rows.join(label, real & (rows.k == label.own), "left")
    return named_rows.select("doc_id", "h", "n", F.coalesce("component_id", "doc_id").alias("component_id"))


def similar(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    return labelled(docs, Scratch(docs.sparkSession), **how).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """One row of docs of each component, with all columns: that of the smallest id, and of several of them that with the smallest digest; of rows without an id one of each text."""
    found = labelled(docs, Scratch(docs.sparkSession), **how)
    first = found.where("doc_id is not null").groupBy("component_id").agg(F.min(F.struct("doc_id", "h")).alias("m")).select("m.h")
    key = free_name("_row", docs.columns)
    kept = first.union(found.where("doc_id is null").select("h")).select(F.col("h").alias(key))
    rows = docs.withColumn(key, row_key(docs))
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
