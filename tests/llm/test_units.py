"""What the buckets say of blocks comes back in units, whose size follows neither the input nor its partitions."""

import random

import pytest
from pyspark.sql import functions as F

from segtally.llm import lm_score, suffix_dedup


@pytest.mark.parametrize("name", ["suffix", "lm"])
def test_answers_come_by_units(spark, monkeypatch, name):
    """Twenty texts of a megabyte, half of them copies, in one partition."""
    r = random.Random(5)
    texts = [" ".join("w%d" % r.randrange(50_000) for _ in range(160_000)) for _ in range(10)]
    docs = spark.createDataFrame([(i, texts[i % 10]) for i in range(20)], "doc_id long, text string").coalesce(1)
    told, join = [], type(docs).join

    def seen(left, right, *rest):
        told.append(right.select(F.max(F.size("answers")), F.sum(F.size("answers"))).first())
        return join(left, right, *rest)

    monkeypatch.setattr(type(docs), "join", seen)
    got = {"suffix": suffix_dedup.spans, "lm": lm_score.score}[name](docs).collect()
    assert sorted(x.doc_id for x in got) == list(range(20))
    assert told and all(0 < most < 0.7 * whole for most, whole in told)
    if name == "suffix":
        assert {x.doc_id for x in got if x.n_removed == x.n_bytes} == set(range(10, 20))
