"""Columns of any name come through every function that returns the columns of documents; rows without an id."""

import pytest
from pyspark.sql import functions as F

from segtally.llm import decontaminate, exact_dedup, jaccard_join, line_dedup, mixing, quality, suffix_dedup

#: Names that the operators use inside, and what they make of them.
INNER = "sha key text own size same bytes removed copies number h t th text_hash keep_id group_size kept taken rank place before inside bin fine source_size target name seq row bucket log_weight gumbel_key selected".split()
NAMES = [f"_{n}0" for n in INNER] + [f"_{n}1" for n in INNER] + [f"_{n}0x" for n in INNER] + [n for n in INNER if n not in ("text", "row")] + ["_n", "_id", "_th", "_w"]


@pytest.mark.parametrize("case", [str.lower, str.upper])
def test_every_column_stays(spark, case):
    labels = spark.createDataFrame([(k, int(k % 2 == 0), int(k % 2)) for k in range(40)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(k, ("good quiet words here " if k % 2 == 0 else "vile awful trash here ") * 5 + f"n{k // 4}", f"s{k % 3}") for k in range(40)], "doc_id long, text string, source string")
    names = list(dict.fromkeys(map(case, NAMES)))
    docs = docs.select("*", *(F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names))
    bench = spark.createDataFrame([(1, "nothing of this kind stands in any of the documents that are here")], "item_id long, text string")
    for f in (exact_dedup.exact_dedup, lambda d: quality.keep_good(d, labels), mixing.mixed_documents, suffix_dedup.texts, jaccard_join.one_of_each, lambda d: decontaminate.remove(d, bench)):
        out = f(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[n] == f"{n}-{r['doc_id']}" for r in got for n in names)


def test_lines_without_an_id_come_last(spark):
    text = "one\ntwo\nthree\nfour"
    docs = spark.createDataFrame([(None, text), (1, text), (2, "zero\n" + text)], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (text, 0, 0), 2: ("zero", 4, 1), None: ("", 4, 1)}
