import collections
import hashlib
import random
import re
import zlib

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from segtally.llm import decontaminate, exact_dedup, jaccard_join, line_dedup, lm_score, mixing, quality, queries, suffix_dedup, token_counts, url_filters

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, h int, removed int, name string, part int"


def rows():
    r = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    base = [" ".join(r.choice(words) for _ in range(n)) for n in (1, 4, 60, 90, 200, 3000)]
    near = base[4].split(" ")
    near[7] = "changed"
    texts = [None, "", " \n ", *base, base[3], base[4] + "\n" + base[3], " ".join(near), base[3].replace(" ", "  "), "\n".join(["a b", "c", "d e f", ""] * 4), "ü" * 150 + " é"]
    out = [(i, t, [None, "a", "b"][i % 3], 1, 2, "n", 3) for i, t in enumerate(texts)]
    return out + [out[7], (None, "no id", None, 1, 2, "n", 3)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    assert compare(spark, connect(DIR), DIR, queries.QUERIES[name], queries.SQL[name]).startswith("equal")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def test_suffix(spark, docs):
    seen, want = set(), []
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is None, r[0])):
        b = (t or "").encode()
        g = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                g[p : p + 100] = b"\x01" * 100
            seen.add(b[p : p + 100])
        want.append((i, len(b), sum(g), hashlib.sha256(bytes(c for c, f in zip(b, g) if not f)).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.spans(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert suffix_dedup.spans(empty(spark)).count() == 0
    assert suffix_dedup.texts(docs).count() == len(rows())


def test_tokens(spark, docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()]
    assert sorted(map(str, got)) == sorted(str((i, len((t or "").encode()), len(lib.encode(t or "")))) for i, t, *_ in rows())
    c = token_counts.counter(path)
    for x in ("a  b ▁x\n漢字①", "  <s> !!!====", "tion thétion"):
        assert c.prefix_counts(x) == [len(lib.encode(x[:i])) for i in range(len(x) + 1)]
    assert all(len(lib.encode(r.text)) <= 7 for r in token_counts.truncate(docs, path, 7).collect())


def test_jaccard(spark, docs):
    sets = {}
    for i, t, *_ in rows():
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if None not in (a, b) and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar(docs).collect()}
    assert got == {i: (len(sets[i]), comp[i]) for i in sets}
    assert jaccard_join.similar(empty(spark)).count() == 0
    bare = spark.createDataFrame([(None, "d"), (None, "e"), (None, "d"), (1, "d"), (2, "d")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text) for r in jaccard_join.one_of_each(bare).collect()) == [("1", "d"), ("None", "d"), ("None", "e")]


def test_lm(spark, docs):
    got = lm_score.score(docs).collect()
    assert len(got) == len(rows()) and all(r.score < 0 and 0 <= r.n_known <= r.n_tokens for r in got)
    want = collections.Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", low(t))) + 1) for i, t, *_ in rows())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert lm_score.score(empty(spark)).count() == 0


def test_lm_keeps_every_gram(spark, docs):
    """Pairs and triples seen once count, and neither buckets nor blocks change a score."""
    pairs = [(i, "%s c%d d%d e%d" % (x, i, i, i), None, 1, 2, "n", 3) for i, x in enumerate(["a b", "a b", "b a", "a e", "b e"] * 40)]
    text = spark.createDataFrame(pairs, SCHEMA)
    held = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)
    x, y, z = [i for i, *_ in pairs if zlib.crc32(str(i).encode()) % 10][:3]
    texts = [f"c{x} d{x} e{x}", f"c{y} d{x} e{x}", f"c{y} d{x} e{z}"]  # a triple, a pair and words alone that the training texts hold once
    more = spark.createDataFrame([(held, t, None, 1, 2, "n", 3) for t in texts], SCHEMA)
    got = sorted(r.score for r in lm_score.score(text.unionByName(more)).where(F.col("doc_id") == held).collect())
    assert got[1] - got[0] > 0.5 and got[2] - got[1] > 0.5
    key = lambda df: sorted((str(r.doc_id), r.n_known, round(r.base_score, 6), r.score) for r in df.collect())
    whole, cut_up = key(lm_score.score(docs)), key(lm_score.score(docs, bucket_bytes=500, block_bytes=1000))
    assert [x[:3] for x in whole] == [x[:3] for x in cut_up] and sum(abs(a[3] - b[3]) > 0.01 * abs(a[3]) for a, b in zip(whole, cut_up)) < 3  # the filter errs at times


def test_decontaminate(spark, docs):
    text = rows()[6][1].split(" ")
    items = spark.createDataFrame([("x", " ".join(text[5:20])), ("y", "W1 nothing here"), ("z", None), (None, " ".join(text[40:55])), ("s", "w%s" % text[0][1:])], "item_id string, text string")
    for size in (1 << 22, 20):
        got = {r.doc_id: r for r in decontaminate.mark(docs, items, part_bytes=size).collect()}
        assert got[6]["_hits"]["n_hit"] >= 30 and "x" in got[6]["_hits"]["items"] and got[0]["_hits"]["n_words"] == 0
    assert decontaminate.hits(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.remove(docs, items).columns == docs.columns


def test_others(spark, docs):
    g = exact_dedup.exact_groups(docs, lambda c: F.lit("one hash")).collect()  # every text collides
    assert len(g) == len(rows()) and sum(r.kept for r in g) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows()})
    twice = spark.createDataFrame([(1, "a  b", 0), (0, "a b", 1), (1, "c", 2), (1, "c", 3), (None, "d", 4), (None, "e", 5)], "doc_id long, text string, _sha0 int")
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.exact_dedup(twice).collect()) == [("0", "a b"), ("1", "c"), ("None", "d"), ("None", "e")]
    assert exact_dedup.exact_dedup(twice).columns == twice.columns and exact_dedup.exact_dedup(empty(spark)).count() == 0
    m = mixing.mix(docs).collect()
    assert len(m) == len(rows()) and all(r.taken <= 2 * r["size"] for r in m)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns
    lines = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert lines[13].n_removed == 9 and lines[13].n_runs == 1 and lines[0].n_removed == 0
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://A.Example.com/en/7x?q"), (4, "http://b.com/en/"), (4, "http://b.com/en/"), (5, "x://adult-a.example.io")], "page_id int, url string")
    out = sorted((r.page_id, r.rule, r.verdict) for r in url_filters.judge(pages, url_filters.rules(spark)).collect())
    assert [x[2] for x in out] == ["allow", "allow", "allow", "block", "block", "block"] and out[2][1] == "example.com/en/7"


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    half = labels.where("doc_id % 2 = 0")
    out = quality.classify(docs, half).join(labels.where("doc_id % 2 = 1"), "doc_id")
    kept = lambda cond: out.where(cond).agg(F.avg(F.col("selected").cast("int"))).first()[0]
    assert kept("quality = 1 and toxic = 0") > 0.97
    assert kept("quality = 0") < 0.4
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.classify(docs.limit(5), labels.limit(0)).where("selected").count() == 5


def test_url_tokens(spark):
    urls = ["http://adult-videos.com/x", "http://a.adult-b.org", "http://adultery.com/x", "http://x.org/signup", "http://x.org/a/login/b", "http://x.org/login-page", "http://bigcasino.org/", "http://casinobig.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    rules = url_filters.rules(spark, [*url_filters.HOST_RULES, ("block", "my-site.org/a-b.c/")])
    assert [r.verdict for r in url_filters.judge(pages, rules).orderBy("page_id").collect()] == ["block", "block", "allow", "block", "block", "allow", "allow", "block"]
    dashed = spark.createDataFrame([(0, "http://www.my-site.org/a-b.c/d"), (1, "http://site.org/a-b.c/d")], "page_id int, url string")
    assert [r.verdict for r in url_filters.judge(dashed, rules).orderBy("page_id").collect()] == ["block", "allow"]


def test_quality_toxic(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    out = quality.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").join(docs.select("doc_id", F.size(F.split("text", r"\s+")).alias("n")), "doc_id").toPandas()
    toxic = out[out.toxic == 1]
    assert toxic.selected.mean() < 0.22
    assert toxic[toxic.n >= 500].selected.mean() < 0.22  # length does not outvote toxic n-grams
