import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from morphloom.llm import mixing

SCHEMA = "doc_id long, text string"
OWN = {"good": ["reason", "quiet", "letter"], "poor": ["BUY!!", "$$$", "click|"], "toxic": ["idiot", "scum", "reason"]}


def tables(spark, n=240):
    rng = random.Random(0)
    docs, labels, truth = [], [], {}
    for i in range(n):
        d = rng.choices(["good", "poor", "toxic"], [6, 2, 2])[0]
        truth[i] = d
        docs.append((i, " ".join(rng.choice(OWN[d] + ["the", "of", "and"]) for _ in range(rng.randint(20, 90)))))
        if i % 2:
            labels.append((i, int(d != "poor"), int(d == "toxic")))
    docs += [(1000, None), (1001, ""), (None, "quiet letter"), (1, docs[1][1])]
    labels += [(5000, 1, 0), (None, 1, 0), (1001, None, None)]
    return (
        spark.createDataFrame(docs, SCHEMA).withColumn("rate", F.lit("clash")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        truth,
    )


@pytest.mark.parametrize("weights", [{"good": 0.9, "poor": 0.08, "toxic": 0.02}, {"good": 0.3, "toxic": 0.7}])
def test_totals_match_targets(spark, weights):
    docs, labels, truth = tables(spark)
    rows = mixing.mix(docs, mixing.train(docs, labels), weights).collect()
    assert len(rows) == len(truth) + 4 and all(r.rate >= 0 for r in rows)
    total = sum(r.n_tokens for r in rows)
    for d in OWN:
        got = sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows)
        want = weights.get(d, 0) * total
        # no text is surely free of a domain, so a target of none is met but for a trace
        assert abs(got - want) <= max(0.01 * want, 0.001 * total)
    held = [r for r in rows if r.doc_id in truth and r.doc_id % 2 == 0]
    best = [max(OWN, key=lambda d: r[f"p_{d}"]) for r in held]
    assert np.mean([truth[r.doc_id] == b for r, b in zip(held, best)]) > 0.95


def test_rates_against_steps_one_by_one(spark):
    docs, labels, _ = tables(spark)
    model = mixing.train(docs, labels)
    members = mixing.memberships(docs, model)
    history = [[0.5, -0.2, 0.9], [0.1, 0.4, 0.6], [-0.3, 0.0, -0.1]]
    for r in members.select("p", mixing.rate(history).alias("rate")).collect():
        want = 1.0
        for h in history:
            want = max(0.0, want - sum(a * b for a, b in zip(r.p, h)))
        assert abs(r.rate - want) < 1e-12


def test_without_labels_and_empty(spark):
    docs, labels, truth = tables(spark, 10)
    assert mixing.train(docs, labels.limit(0)) is None
    rows = mixing.mix(docs, None, {"all": 1.0}).collect()
    assert {(r.p_all, r.rate) for r in rows} == {(1.0, 1.0)}
    assert mixing.mix(docs.limit(0), None, {"all": 1.0}).collect() == []


def test_thinned_keeps_clean_documents(spark):
    docs, labels, truth = tables(spark)
    kept = mixing.thinned(docs, labels, {"good": 1.15, "poor": 0.5, "toxic": 0.05})
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i, d in truth.items() if d == "good"} <= set(ids)
    toxic = {i for i, d in truth.items() if d == "toxic"}
    assert len(toxic & set(ids)) < len(toxic) / 3


def test_thinned_meets_its_targets(spark):
    docs, labels, truth = tables(spark, 1500)
    left = {"good": 0.97, "poor": 0.6, "toxic": 0.15}
    model = mixing.train(docs, labels)
    rows = mixing.mix(docs, model, left, relative=True, most=1.0).collect()
    assert all(0 <= r.rate <= 1 for r in rows)
    ids = {r.doc_id for r in mixing.thinned(docs, labels, left).collect()}
    for d, share in left.items():
        now = sum(r.n_tokens * r[f"p_{d}"] for r in rows)
        assert abs(sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) - share * now) <= 0.002 * share * now
        # what the filter itself leaves, up to the chance of the draw
        assert abs(sum(r.n_tokens * r[f"p_{d}"] for r in rows if r.doc_id in ids) / now - share) < 0.09


def test_targets_out_of_reach_are_told(spark):
    docs, labels, _ = tables(spark)
    members = mixing.memberships(docs, mixing.train(docs, labels))
    with pytest.warns(UserWarning, match="the targets"):
        mixing.solve(members, np.array([10.0**6] * 3), steps=2, most=1.0)
