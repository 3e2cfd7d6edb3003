import random

import numpy as np
from pyspark.sql import functions as F

from morphloom.llm import compression_quality as cq

SCHEMA = "doc_id long, text string"


def tables(spark, n=300):
    rng = random.Random(0)
    good = ["the", "of", "reason", "and", "there", "is", "quiet"]
    bad = ["BUY!!", "NOW!!", "$$$", "click|", "###win"]
    docs, labels = [], []
    for i in range(n):
        q = int(rng.random() < 0.7)
        docs.append((i, " ".join(rng.choice(good if q else bad) for _ in range(rng.randint(30, 300)))))
        labels.append((i, q, 0))
    docs += [(1000, None), (1001, ""), (None, "the quiet"), (1, docs[1][1]), (1002, "x" * 300_000)]
    labels += [(1, labels[1][1], 0), (5000, 1, 0), (None, 0, 0), (1001, None, 0)]
    return (
        spark.createDataFrame(docs, SCHEMA).withColumn("score", F.lit("clash")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        len(docs),
        dict((i, q) for i, q, _ in labels),
    )


def test_held_out_accuracy_and_edges(spark):
    docs, labels, n, truth = tables(spark)
    model = cq.train(docs, labels)
    got = cq.score(docs, model).collect()
    assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score and by_id[None].held_out


def test_without_labels(spark):
    docs, labels, n, _ = tables(spark, 10)
    model = cq.train(docs, labels.limit(0))
    assert model is None
    assert {r.score for r in cq.score(docs, model).collect()} == {0.5}
    assert cq.score(docs.limit(0), model).collect() == []


def test_difference_is_that_of_the_sizes():
    d = cq.Difference(b"alpha beta gamma " * 50, b"0123456789 " * 80)
    assert d(b"alpha beta gamma alpha") > 0 > d(b"0123456789 0123456789")
    assert d(b"") == 0
