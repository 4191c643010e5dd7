"""The first records of many FASTQ files, without reading the rest of them.

A data source of its own, since a reader of text goes through whole files: each task takes
a few files, and stops reading one when it has its records.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, read_no long, header string, sequence string, quality string, bytes_read long"
#: Bytes that are asked of a store at a time.
STEP = 1 << 16


class _Counted(io.RawIOBase):
    """A stream of a file that counts what is taken from it."""

    def __init__(self, stream):
        self.stream, self.taken = stream, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.stream.read(len(buffer))
        buffer[: len(data)] = data
        self.taken += len(data)
        return len(data)


def head_records(stream, path: str, records: int) -> list[tuple]:
    """The rows of SCHEMA of one file; stream gives its bytes as they are stored. Text is UTF-8, other bytes are replaced."""
    counted = _Counted(stream)
    raw = io.BufferedReader(counted, STEP)
    lines = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
    out = []
    for k in range(1, records + 1):
        record = [lines.readline() for _ in range(4)]
        if not record[0].strip() and not any(record):
            break
        if not record[3] or not record[0].startswith(b"@"):
            raise ValueError(f"broken record {k} of {path}")
        header, sequence, _, quality = (x.decode("utf-8", "replace").strip() for x in record)
        out.append((path, k, header, sequence, quality))
    return [(*r, counted.taken) for r in out]


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FastqHeadReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files, self.records, self.tasks = json.loads(options["files"]), int(options["records"]), int(options["tasks"])

    def partitions(self) -> list[Files]:
        n = max(1, min(self.tasks, len(self.files)))
        return [Files(self.files[i::n]) for i in range(n)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (c.split() for c in SCHEMA.split(", "))])
        for path in partition.paths:
            store, name = FileSystem.from_uri(path)
            with store.open_input_stream(name, compression=None, buffer_size=STEP) as stream:
                rows = head_records(stream, path, self.records)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class FastqHead(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_head"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqHeadReader:
        return FastqHeadReader(self.options)


def read_fastq_head(spark: SparkSession, paths, records: int, keys: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """path, keys, read_no, header, sequence, quality, bytes_read of the first records of every file; bytes_read is what was taken of the file for all of them.

    Files are named by Spark's own listing and opened by their URI, in any store that Arrow
    opens (local, hdfs, s3, gs); for others take files.read_fastq and its read_no. A header
    without ``@`` and a short record raise; an empty file gives no row.
    """
    spark.dataSource.register(FastqHead)
    names = spark.read.text(paths).inputFiles()
    tasks = tasks or max(1, min(len(names), 4 * spark.sparkContext.defaultParallelism))
    t = spark.read.format("fastq_head").option("files", json.dumps(names)).option("records", str(records)).option("tasks", str(tasks)).load()
    return t.select("path", *(F.regexp_extract("path", p, 1).alias(n) for n, p in (keys or {}).items()), "read_no", "header", "sequence", "quality", "bytes_read")
