"""op12: alignment of two tokenizers, by brute force over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from segtally.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a", "É", "ß", " ", "  ", "\n", "'s", "1", "²", "\r", "\x85", "\xa0", "é", "́", "<|endoftext|>", "</s>", "<0x41>", "中", "😀", "\t", "\x00", "가", "word", " Thesened", "▁", "　", ");"]


@lru_cache(maxsize=1)
def libraries():
    return Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text: str):
    """Tokens of the whole text and their bytes, from the libraries alone."""
    a, b = libraries()
    a.encode_special_tokens = True
    letter = {c: i for i, c in enumerate(alignment.byte_letters())}
    x = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    return (x, y) if text and b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else ([], [])


def brute(rows):
    found = []
    for doc, text in rows:
        x, y = tokens(text or "")
        ends = []
        for side in (x, y):
            at, out = 0, []
            for _, t in side:
                out.append(at := at + len(t))
            ends.append(out)
        common = sorted(set(ends[0]) & set(ends[1]))
        group = [[sum(c < e for c in common) for e in side] for side in ends]
        parts = [([i for (i, _), g in zip(x, group[0]) if g == k], [i for (i, _), g in zip(y, group[1]) if g == k]) for k in range(len(common))]
        found.append((doc, len(x), len(y), parts, Counter((i, j) for p in parts for i in p[0] for j in p[1])))
    count = Counter(k for *_, links in found for k in links)
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    text = lambda parts: ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in parts)
    return sorted((d, n_a, n_b, len(parts), links.total(), sum(n for k, n in links.items() if count[k] == best[k[0]]), sum(n * count[k] for k, n in links.items()), hashlib.sha256(text(parts).encode()).hexdigest() if parts else "") for d, n_a, n_b, parts, links in found)


def test_groups_end_where_both_end():
    r = random.Random(5)
    for _ in range(500):
        n = r.randint(1, 60)
        ea, eb = (sorted({*r.sample(range(1, n + 1), r.randint(1, n)), n}) for _ in range(2))
        if r.random() < 0.3:
            eb = ea
        ga, gb = alignment.group_ends(ea, eb)
        common = sorted(set(ea) & set(eb))
        assert [ea[i - 1] for i in ga] == common == [eb[j - 1] for j in gb]


@pytest.mark.parametrize("most", [alignment.MOST_PAIRS, 0])
def test_alignment_of_odd_texts(spark, most):
    r = random.Random(7)
    rows = [(k, "".join(r.choice(ODD) for _ in range(r.randint(0, 12)))) for k in range(300)]
    rows += [(300, None), (301, ""), (302, " "), (303, "  "), (304, "\n"), (305, "a" * 3000), (306, "a a  a"), (307, "a a  a"), (308, "▁")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.align(docs, A, B, most)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_alignment_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op12_alignment(spark, sf).collect()))
    assert [x[0] for x in got] == sorted(d for d, _ in rows)
    short = [(d, t) for d, t in rows if len(t or "") < 400]
    text = {d: hashlib.sha256(g.encode()).hexdigest() if g else "" for d, g in alignment.groups(spark.read.parquet(f"{sf}/documents.parquet"), A, B).collect()}
    want = {x[0]: (*x[1:5], x[7]) for x in brute(short)}
    for x in got:
        assert x[7] == text[x[0]]
        assert x[0] not in want or want[x[0]] == (*x[1:5], x[7])


def test_long_texts_in_segments(spark, monkeypatch):
    p = alignment.pair_of(A, B)
    texts = ["One two,  three.\nVier fünf " * 40, "x" * 500, "a ▁ b" * 50]
    whole = alignment._measured(texts, p)
    monkeypatch.setattr(alignment, "SEGMENT", 64)
    for x, y in zip(whole, alignment._measured(texts, p)):
        assert x[:4] == y[:4] and dict(zip(x[5].tolist(), x[6].tolist())) == dict(zip(y[5].tolist(), y[6].tolist()))
        assert (hashlib.sha256(x[4]).hexdigest() == y[4]) if x[0] else y[0] == 0


def test_alignment_of_defined_cases(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "p")] * 2 + [(None, "a b", 2, "q")], "doc_id long, text string, n_a int, pairs string")
    got = alignment.align(docs, A, B).collect()
    assert [r["count_sum"] for r in got] == [6, 6, 6] and {r["doc_id"] for r in got} == {1, None}
    assert alignment.align(docs.limit(0), A, B).count() == 0
    assert alignment.align(docs.limit(0), A, B, -1).count() == 0
