import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from morphloom.llm import bitplane_clusters as b

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, n=16, rounds=3):
    """The same by Python's integers."""
    good = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(
        good, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    )
    centroids = [v for _, v in order[:n]]

    def assign():
        out = []
        for i, v in good:
            d = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids]
            out.append((i, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for c in range(len(centroids)):
            own = [v for _, v, k, _ in of if k == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    of = assign()
    whole = sum(d for *_, d in of)
    sums = [sum(d for *_, k, d in of if k == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, sums[k], whole, sha[k]) for i, _, k, d in of), key=str)


def vectors(n=400):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(scale=0.2, size=64).tolist()) for i in range(n)]
    hot = rows[7][1]
    rows += [(1000 + i, hot) for i in range(200)]  # a third of all rows
    rows += [(1, rows[1][1]), (2, rows[3][1]), (None, hot), (None, rows[4][1])]
    rows += [(2000, None), (2001, [0.1] * 63), (2002, [0.1] * 65), (2003, [None] + [0.1] * 63), (2004, [])]
    rows += [(2005, [float("nan")] * 64), (2006, [float("-inf")] * 64), (2007, [0.0] * 64), (2008, [-0.0] * 64)]
    return rows + [(2009, [50000.25, -50000.25] * 32), (2010, [-1e-300] * 64)]


def test_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumn("cluster", F.lit("clash")).withColumn("v", F.lit(1))
    got = sorted((tuple(r) for r in b.clusters(df).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 15])
def test_fewer_vectors_than_centroids_and_equal_ones(spark, n):
    rows = vectors()[:n] + [(0, vectors()[0][1])]
    got = b.clusters(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    # two equal centroids: the first takes all
    assert len({r.cluster for r in got if r.vec_id == 0}) == 1


def test_nothing_kept(spark):
    for rows in ([], [(0, None), (1, [1.0])]):
        assert b.clusters(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_components_too_large_stop_the_job(spark):
    with pytest.raises(Exception, match="component of"):
        b.clusters(spark.createDataFrame([(0, [1e30] + [0.0] * 63)], SCHEMA)).collect()


def test_plane_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high in ((-1, 1), (0, 1), (-70, 90), (-(2**26), 2**26)):
        u, v = rng.integers(low, high, (30, 64)), rng.integers(-300, 300, (8, 64))
        a, c = b.planes(u), b.planes(v)
        assert (b.components(a) == u).all()
        assert (b.dots(a, c) == u @ v.T).all()
        assert (b.squares(a) == (u * u).sum(axis=1)).all()
    assert b.planes(np.array([[-64] * 64, [63] * 64])).shape == (2, 7)
