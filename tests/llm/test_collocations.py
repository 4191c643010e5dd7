"""op13: phrase collocations, by brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from segtally.llm import collocations, queries
from segtally.llm.collocations import Automaton, summed

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, share=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + m]) for m in (1, 2, 3, 4) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + m] for p, a in good.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= share * count[p[i : i + m]]}
        found = []
        for p, a in good.items():
            if p not in gone:
                score, _, left, right = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def text_rows(seed=2, n=400):
    r = random.Random(seed)
    words = [f"W{k}" for k in range(12)] + ["é", "of", "The", "x\x00y", "ñandú"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 30)):
            parts += ["new", "York", "city"] if r.random() < 0.1 else ["hot", "pair", r.choice(words)] if r.random() < 0.3 else [r.choice(words)]
            parts.append(r.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "!"]))
            if parts[-1] != " ":
                continue
        rows.append((r.choice(["en", "en", "en", "de", None, "und"]), " ".join(parts)))
    return rows + [("fr", None), ("fr", ""), ("es", "one"), ("xx", "a b " * 40), ("xx", "a b " * 40)]


@pytest.mark.parametrize("settings", [{}, {"most_words": 5}, {"most_words": 0}, {"range_size": 500}, {"range_size": 40, "most_words": 3}, {"top": 7, "least": 3}])
def test_collocations_by_brute_force(spark, settings):
    rows = text_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(docs, **settings)
    assert got.columns == COLUMNS and {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    want = brute(rows, settings.get("least", 30), 80, settings.get("top", 2000))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_collocations_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, queries.op13_collocations(spark, sf).collect())) == brute(rows)


def test_automata():
    r = np.random.default_rng(1)
    parts, total = [], Counter()
    for _ in range(5):
        paths = r.integers(1, 6, (200, 4))
        for row in paths:
            row[r.integers(2, 5) :] = 0
        total.update(map(tuple, paths.tolist()))
        parts.append(Automaton.build(*summed([c.astype(np.uint64) for c in paths.T], np.ones(200, np.int64))))
    packed = [p.pack() for p in parts]
    whole = Automaton.union([Automaton.unpack(*p) for p in packed])
    paths, weights = whole.paths()
    assert dict(zip(zip(*(p.tolist() for p in paths)), weights.tolist())) == dict(total)
    for depth, f in enumerate(whole.through()):
        want = Counter()
        for p, n in total.items():
            if p[depth]:
                want[p[: depth + 1]] += n
        assert dict(zip(zip(*(p.tolist() for p in whole.prefixes(depth))), f.tolist())) == dict(want)
    asked = [tuple(x) for x in r.integers(0, 7, (300, 4)).tolist()] + list(total)
    asked = [tuple(x if all(p[:k]) or not k else 0 for k, x in enumerate(p)) for p in asked]
    got = whole.compose([np.array(c, np.uint64) for c in zip(*asked)])
    assert got.tolist() == [total.get(p, 0) for p in asked]


def test_scores_beyond_64_bits(spark):
    n = 10**14
    parts = spark.createDataFrame([(1, 2, 0, 0, n, n + 1, 2 * n, None, None, None, None)], "w1 long, w2 long, w3 long, w4 long, a long, l1 long, r1 long, l2 long, r2 long, l3 long, r3 long")
    assert collocations.scored(parts).first()["score"] == 2000000 * n // (3 * n + 1)


def test_collocations_of_defined_cases(spark):
    docs = spark.createDataFrame([("en", "a b", 1, "q")] * 30, "lang string, text string, w1 int, h string")
    assert [r["phrase"] for r in collocations.collocations(docs).collect()] == ["a b"]
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.limit(29)).count() == 0
