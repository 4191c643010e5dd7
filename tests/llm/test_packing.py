"""op11: packing, held against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from segtally.llm import packing, queries

FILE = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
ODD = ["a", "É", "ß", " ", "\n", "'s", "'", "1", "²", "\x1c", "\x85", "\xa0", "é", "́", "Σ", "<|endoftext|>", "<|", "İ", "ﬁ", "中", "😀", "\t", "\x00", "I'LL", "ª", "가", "word", "Thesened"]


def test_ids_are_those_of_the_library():
    r, e, lib = random.Random(3), packing.encoder(FILE), Tokenizer.from_file(FILE)
    assert e.by_word
    for _ in range(4000):
        text = "".join(r.choice(ODD) for _ in range(r.randint(0, 14)))
        assert np.frombuffer(e.encode(text.encode()), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_a_text_in_steps(monkeypatch):
    e, text = packing.encoder(FILE), "Ein Satz, dann\nnoch einer; " * 50
    whole = e.encode(text.encode())
    monkeypatch.setattr(packing, "STEP", 64)
    assert e.encode(text.encode()) == whole


@pytest.mark.parametrize("capacity", [1, 2, 64, 2048])
def test_tails_leave_little_empty(capacity):
    slack = capacity // 128
    for n in range(1, capacity):
        parts = packing.tail_lengths(n, capacity, slack)
        assert sum(parts) == n and len(parts) <= 6
        # a piece that was cut off fills its class but for the rest of the division
        assert all(capacity - (k := capacity // x) * x <= max(slack, k) for x in parts)


def _hold(rows, texts, capacity=2048):
    """Every contract of the result; texts: (doc_id, text) in any order, ids without copies."""
    lib = Tokenizer.from_file(FILE)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert docs.keys() == {d for d, _ in texts}
    for d, text in texts:
        ids, at = [*lib.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(docs[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    used = padded = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        used, padded = used + at, padded + (0 if at & (at - 1) == 0 else capacity - at)
    return padded / (used + padded)


def test_packing_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = queries.op11_packing(spark, sf)
    assert out.columns == COLUMNS and dict(out.dtypes)["ids_crc32"] == "bigint"
    assert _hold(out.collect(), docs) < 0.005


def test_packing_of_defined_cases(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "y"), (3, "word " * 9000, "z"), (4, "ab", "z"), (5, "a" * 30000, "z"), (6, "<|endoftext|> b", None)]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_packing(spark, str(tmp_path))
    _hold(out.collect(), [r[:2] for r in rows])
    same = spark.createDataFrame([(7, "one two")] * 3 + [(None, "three")], "doc_id long, text string")
    got = packing.pack(same, FILE).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 7) == 9 and sum(r["length"] for r in got if r["doc_id"] is None) == 2
    assert packing.pack(same.limit(0), FILE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(same, FILE, capacity=1000)


def test_packing_again_is_the_same(spark):
    sf = "/root/testdata/sf0.001"
    a, b = ({tuple(r) for r in queries.op11_packing(spark, sf).collect()} for _ in range(2))
    assert a == b
