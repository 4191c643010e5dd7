"""The similarity join against brute force: hot lists, chains of near copies, common passages, repeated ids, hash traps."""

import random
import re

from segtally.llm import jaccard_join

SCHEMA = "doc_id long, text string, _row0 string, k int, h int"


def brute(rows):
    """(doc_id, n, component) of each row, by all pairs."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if None not in (rows[a][0], rows[b][0]) and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                comp[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted((str(i), len(sets[a]), str(None if i is None else least[find(a)])) for a, (i, _) in enumerate(rows))


def check(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.similar(docs, **how).collect())
    assert got == brute(rows)
    return docs


def corpus():
    r = random.Random(3)
    words = ["w%d" % i for i in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    base, rows = say(120), []
    for i in range(90):  # a family whose members link to some others only
        t = list(base)
        for _ in range(r.randint(0, 5)):
            t[r.randrange(len(t))] = r.choice(words)
        rows.append((i, " ".join(t)))
    passage = say(60)
    rows += [(100 + i, " ".join(say(r.randint(8, 30)) + passage + say(r.randint(0, 20)))) for i in range(60)]  # unlike texts with one common passage
    rows += [(200 + i, " ".join(say(n))) for i, n in enumerate((1, 2, 4, 5, 6, 300))]
    rows += [(None, rows[0][1]), (None, ""), (300, None), (301, " \n"), (302, "W1 w2"), (303, "w1  W2"), (7, rows[205 - 50][1]), (7, rows[3][1]), rows[5], rows[5]]
    return rows


def test_families_and_passages(spark):
    rows = corpus()
    docs = check(spark, rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    with_id = [x for x in kept.collect() if x.doc_id is not None]
    assert len(with_id) == len({c for i, _, c in brute(rows) if i != "None"})


def test_hot_lists_and_blocks(spark):
    """Lists that are rows from the start, and lists compared in several blocks."""
    check(spark, corpus(), frequent=50, hot=3, block=4)


def test_words_that_sums_of_powers_confuse(spark):
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    check(spark, [(1, a), (2, b), (3, f"x {a} y z u v"), (4, f"x {b} y z u v")])


def test_long_and_empty(spark):
    long = " ".join("w%d" % (i * i % 99991) for i in range(700_000))
    check(spark, [(1, long), (2, long + " end"), (3, "x" * 3_000_000), (4, "")])
    assert jaccard_join.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0
