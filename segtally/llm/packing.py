"""Harmonic packing of tokenised documents into sequences of one capacity.

A document is a run of token ids. Whole sequences are cut off its front; what is
left, the tail, belongs to the reciprocal-capacity class k when its length is in
(capacity / (k + 1), capacity / k], and a bin of class k takes exactly k pieces,
whatever they are. So each Spark task packs its own rows, with one open bin a class
and no view of other tasks. A tail that would leave more than ``slack`` of its bin
empty is cut: a piece of capacity // (k + 1) goes to class k + 1, which it fills, and
the rest, now under capacity / (k * (k + 1)), is a tail again. Bins that are still
open when the rows of a task end are laid end to end in sequences of full capacity,
the last of them in sequences of a power of two, which are not padded.

Defined cases: null and "" are the end id alone; repeated rows are packed each by
itself; an empty table gives an empty table; a text of any length is encoded in parts
that end at white space; rows without an id keep null; other columns are not read,
whatever their names. A task that runs again gives the same rows.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Words, and parts of words, whose ids a worker keeps; the memory is given back when there are more.
KEEP_WORDS, KEEP_PARTS = 700_000, 500_000
#: Bytes of text that are split into words at a time.
STEP = 1 << 20
#: Bytes of ids in one Arrow batch of pieces.
BATCH = 4 << 20

# The normaliser and splitter for which words can be encoded one by one.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next one from U+0100."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(other)) for b in range(256)]


class _Filled(dict):
    """A dict that asks ``make`` for what it lacks."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of a text as the tokenizers library gives them, little-endian unsigned 32-bit, without added special tokens.

    Where the vocabulary drops white space and splits at it, each word between ASCII white
    space has its own ids, which are kept; any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        norm = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = norm == NORMALIZER and pre[0].get("pattern", {}).get("Regex") == SPLIT and pre[0].get("behavior") == "Removed" and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)").search
        self.split, self.letters = regex.compile(SPLIT).findall, byte_letters()
        self.words, self.parts = _Filled(self._word), _Filled(self._part)

    def _whole(self, text: str) -> bytes:
        return packed_ids(self.lib.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        """Printing ASCII stands for itself among byte letters."""
        return packed_ids([t.id for t in self.lib.model.tokenize(part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode())))])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        # Printing letters below U+0180 are normal forms already, and every version of Unicode puts them into the same classes.
        if text.isprintable() and (text.isascii() or max(text) < "ƀ") and not self.special(text):
            low = text.lower()
            return self.parts[low] if low.isalpha() else b"".join(map(self.parts.__getitem__, self.split(low)))
        return self._whole(text)

    def encode(self, raw: bytes) -> bytes:
        if not self.by_word:
            return self._whole(raw.decode())
        if len(self.words) > KEEP_WORDS:
            self.words.clear()
        if len(self.parts) > KEEP_PARTS:
            self.parts.clear()
        if len(raw) <= STEP:
            return b"".join(map(self.words.__getitem__, raw.split()))
        return b"".join(self._steps(raw))

    def _steps(self, raw: bytes) -> Iterator[bytes]:
        at, space = 0, re.compile(rb"[\t-\r ]")
        while at < len(raw):
            end = space.search(raw, at + STEP)
            to = end.end() if end else len(raw)
            yield b"".join(map(self.words.__getitem__, raw[at:to].split()))
            at = to


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tail_lengths(length: int, capacity: int, slack: int) -> list[int]:
    """Pieces of a tail shorter than the capacity, each of which leaves at most ``slack`` of a bin of its class empty."""
    out = []
    while length:
        k = capacity // length
        if capacity - k * length <= slack:
            out.append(length)
            break
        out.append(capacity // (k + 1))
        length -= out[-1]
    return out


class Packer:
    """The open bins of one task, a list of pieces (doc_id, doc_tokens, start, ids) for each class."""

    def __init__(self, capacity: int, slack: int, first_sequence: int):
        self.capacity, self.slack, self.next = capacity, slack, first_sequence
        self.bins: dict[int, list[tuple]] = {}
        self.tails: dict[int, list[int]] = {}

    def close(self, pieces: list[tuple]) -> Iterator[tuple]:
        """Rows of one sequence."""
        offset = 0
        for doc_id, total, start, ids in pieces:
            n = len(ids) // 4
            yield doc_id, start, n, ids, total, self.next, offset
            offset += n
        self.next += 1

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, at, cap = len(ids) // 4, 0, self.capacity
        while total - at >= cap:
            yield from self.close([(doc_id, total, at, ids[4 * at : 4 * (at + cap)])])
            at += cap
        rest = total - at
        if rest not in self.tails:
            self.tails[rest] = tail_lengths(rest, cap, self.slack)
        for n in self.tails[rest]:
            k = cap // n
            open_bin = self.bins.setdefault(k, [])
            open_bin.append((doc_id, total, at, ids[4 * at : 4 * (at + n)]))
            at += n
            if len(open_bin) == k:
                yield from self.close(self.bins.pop(k))

    def end(self) -> Iterator[tuple]:
        """What no bin of its class could be filled with, end to end; the last sequences have lengths of powers of two."""
        left = [p for k in sorted(self.bins) for p in self.bins[k]]
        n = sum(len(p[3]) // 4 for p in left)
        sizes = [self.capacity] * (n // self.capacity) + [1 << b for b in range(n.bit_length(), -1, -1) if n % self.capacity >> b & 1]
        pieces = iter(left)
        now = next(pieces, None)
        for size in sizes:
            sequence = []
            while size:
                doc_id, total, start, ids = now
                take = min(size, len(ids) // 4)
                sequence.append((doc_id, total, start, ids[: 4 * take]))
                size -= take
                now = (doc_id, total, start + take, ids[4 * take :]) if 4 * take < len(ids) else next(pieces, None)
            yield from self.close(sequence)
        self.bins = {}


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 1, slack: float = 1 / 128) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset of each piece of each row of docs; one pass, no shuffle."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    kind, last = docs.select("doc_id").schema[0].dataType.simpleString(), np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_file)
        packer = Packer(capacity, int(capacity * slack), TaskContext.get().partitionId() << 33)
        rows, held, schema = [], 0, None

        def made() -> Iterator[tuple]:
            nonlocal schema
            for batch in batches:
                schema = schema or pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
                    yield from packer.add(doc_id, e.encode(text.as_py() or b"") + last)
            yield from packer.end()

        for row in made():
            rows.append(row)
            held += len(row[3]) + 64
            if held > BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
