"""Calibration of the quality scores, and odd tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripmill.llm import quality_fm


def made(spark, share, n=2000):
    """Good texts have sentences, bad ones shout; one in twenty looks like the other kind."""
    r = random.Random(int(share * 100))
    docs, labels = [], []
    for k in range(n):
        good = r.random() < share
        looks = good if r.random() > 0.05 else not good
        words = ["river", "stone", "evening", "letter", "window", "harbour"] if looks else ["WIN", "$$$", "click", "FREE", "now!!!", "buy"]
        docs.append((k, " ".join(r.choice(words) for _ in range(r.randrange(5, 40))), 0))
        labels.append((k, int(good)))
    docs = [(k, t, len(t)) for k, t, _ in docs]
    return spark.createDataFrame(docs, "doc_id long, text string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.mark.parametrize("share", [0.05, 0.5, 0.95])
def test_mean_score_is_the_share(spark, share):
    docs, labels = made(spark, share)
    learn = F.col("doc_id") % 3 != 1
    scored = quality_fm.score(docs, quality_fm.train(docs, labels, learn)).join(labels, "doc_id")
    held = scored.where("doc_id % 3 = 1")
    row = held.agg(F.avg("score"), F.avg("quality")).first()
    assert abs(row[0] - row[1]) < 0.03
    means = dict(held.groupBy("quality").agg(F.avg("score")).collect())
    assert means[1] > means[0] + 0.2


def test_odd_tables(spark):
    docs, labels = made(spark, 0.5, 300)
    odd = docs.union(spark.createDataFrame([(None, None, None), (1, "", 0), (1, "a " * 500_000, 1), (1, "", 0)], docs.schema)).withColumn("Score", F.lit("kept?"))
    model = quality_fm.train(odd, labels.union(labels).union(spark.createDataFrame([(None, 1), (5, 7), (6, None)], labels.schema)), F.lit(True))
    rows = quality_fm.score(odd, model).collect()
    assert len(rows) == 304 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.text == "" and r.n_chars == 0}) == 1
    for empty in (quality_fm.train(docs.limit(0), labels, F.lit(True)), quality_fm.train(docs, labels.limit(0), F.lit(True))):
        assert {r.score for r in quality_fm.score(docs, empty).collect()} == {0.5}
    assert quality_fm.score(docs.limit(0), model).count() == 0
    ones = quality_fm.train(docs, labels.withColumn("quality", F.lit(1)), F.lit(True))
    assert all(r.score > 0.95 for r in quality_fm.score(docs, ones).collect())
