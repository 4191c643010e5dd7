"""What the operators of this subpackage share: table access, cut lineage, words as numpy arrays.

The numpy helpers work on one Arrow batch inside a Spark task; Spark splits the
input, moves the rows and regroups them. Texts stay UTF-8 bytes all the way, so
no Python string is made for a document.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step takes; a longer document is a step of its own.
BLOCK_BYTES = 2 << 20
#: Bytes of text that are stored, and later met by what the buckets say of them, as one key.
UNIT_BYTES = 8 << 20
#: White space of the text contracts, as a Java and RE2 character class body.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share; one of this machine where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))  # one machine, as in tests
        found = spark.sparkContext.getCheckpointDir()
    return found


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


class Scratch:
    """Tables of intermediate rows in the shared folder, which go when they are superseded."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, f"{shared_folder(spark)}/segtally-{uuid.uuid4().hex}", {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)  # the frame is held, so that its id stays its own
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            remove(self.spark, self.paths[id(f)][0])

    def drop_all_but(self, *frames: DataFrame) -> None:
        """For the end, when only these tables are still read by what is returned."""
        self.drop(*(f for k, (_, f) in self.paths.items() if k not in {id(x) for x in frames}))


def free_name(stem: str, *taken: list[str]) -> str:
    """A column name that none of the lists holds, in any case of letters."""
    used = {c.lower() for names in taken for c in names}
    return next(n for n in (f"{stem}{i}" for i in range(len(used) + 1)) if n.lower() not in used)


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Sends at most n rows at a time to Python for what runs inside; for rows of a megabyte."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def lower_ascii(c: F.Column) -> F.Column:
    """A-Z only, as the contracts ask; other letters keep their case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- numpy side

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
#: The first 0 to 8 bytes of a little-endian value.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_WORD = 256
_POW = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base modulo 2^64, and of its inverse."""
    if len(_POW["up"]) < n:
        for key, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            x = np.full(n + n // 8, base, np.uint64)
            x[0] = 1
            _POW[key] = np.cumprod(x)
    return _POW["up"][:n], _POW["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n+1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes of column text (or one row): batch slice, bytes, offsets."""
    for batch in batches:
        raw, offsets = flat(batch.column("text"))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def in_units(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """blocks() with their units and numbers. A unit is a run of blocks of a task, at most ``UNIT_BYTES`` of text or one block,
    so that its size follows neither the input nor the partitions; units and numbers rise in the order of the rows."""
    unit, held = TaskContext.get().partitionId() << 24, 0
    for k, (batch, raw, offsets) in enumerate(blocks(batches, limit)):
        if held and held + len(raw) > UNIT_BYTES:
            unit, held = unit + 1, 0
        held += len(raw)
        yield unit, k, batch, raw, offsets


def n_units(spark: SparkSession, total: int) -> int:
    """The buckets by unit of a table of ``total`` bytes of text."""
    return int(min(max(1, total // UNIT_BYTES), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))))


def with_answers(stored: DataFrame, said: DataFrame, n: int, *fields: str) -> DataFrame:
    """The blocks of a table bucketed by unit into n, with what is said of each: said (unit, block, fields) is gathered by unit and comes to the blocks, which stay where they are."""
    told = said.repartition(n, "unit").groupBy("unit").agg(F.collect_list(F.struct("block", *fields)).alias("answers"))
    mine = F.filter("answers", lambda a: a["block"] == F.col("block"))
    return stored.join(told.hint("merge"), "unit", "left").select(*stored.columns, mine.alias("answers"))


def _spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside & edge[:-1]
    first[1:] |= inside[1:] & ~inside[:-1]
    last = inside & edge[1:]
    last[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words(raw: np.ndarray, offsets: np.ndarray, alnum: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A-Z lower-cased words of every row: bytes, word starts, word ends, n+1 offsets of rows into the words.

    Words are runs without white space, or with ``alnum`` runs of a-z, 0-9 and
    bytes over 127 (whole characters outside ASCII).
    """
    low = _LOWER[raw]
    return (low, *_spans(_ALNUM[low] if alnum else ~_WS[low], offsets))


def hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, the same wherever the range stands.

    Eight bytes at a time go through a bijection that mixes all that came before, so
    no sums of powers cancel; ranges of over ``LONG_WORD`` bytes are hashed by BLAKE2.
    """
    n = (ends - starts).astype(np.int64)
    eight = np.ndarray(len(low) + 1, "<u8", np.concatenate([low, np.zeros(8, np.uint8)]), strides=(1,))
    h = mix(n.astype(np.uint64) + np.uint64(_P))
    far = n > LONG_WORD
    todo, k = np.flatnonzero((n > 0) & ~far), 0
    while len(todo):
        rest = n[todo] - k
        h[todo] = mix(h[todo] ^ ((eight[starts[todo] + k] & _FIRST[np.minimum(rest, 8)]) * np.uint64(_P)))
        todo, k = todo[rest > 8], k + 8
    for i in np.flatnonzero(far):
        h[i] = int.from_bytes(hashlib.blake2b(low[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values; runs at the end that would be cut off are left out."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(_P) + h[k : len(h) - size + 1 + k]
    return mix(out)


def by_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by bucket, the buckets that occur, and where each begins in that order, with the end behind."""
    b = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    b = b[order]
    start = np.flatnonzero(np.diff(b, prepend=-1))
    return order, b[start], np.append(start, len(b))
