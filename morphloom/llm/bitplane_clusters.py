"""Centroid clustering of integer vectors by bit planes.

A vector of 64 integers is held as its bit planes: plane p is one 64-bit word whose bit i
is bit p of component i, in two's complement. With the weight 2^p of each plane (the last
one's is negative) the dot product of two vectors is the sum of the number of ones in the
AND of every plane of the one with every plane of the other, times both weights; squared
lengths and distances follow. All of it is in integers and exact.

The planes are written once; every round reads them, sends one row of sums per task and
cluster, and nothing else is shuffled. The centroids, 64 integers each, are the model.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from morphloom.llm.common import keep

DIM = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
SEED = "1"
LIMIT = 2**27  # of a component's size, so that squared distances fit in 64 bits

_BITS = np.arange(DIM, dtype=np.uint64)


def planes(vectors: np.ndarray) -> np.ndarray:
    """The planes of vectors (rows of 64 integers): a row of words each, as few as hold
    all of the vectors, the sign last."""
    size = int(np.maximum(vectors, ~vectors).max(initial=0))
    out = np.empty((len(vectors), size.bit_length() + 1), np.uint64)
    for p in range(out.shape[1]):
        bit = (vectors >> p).astype(np.uint64) & np.uint64(1)
        out[:, p] = np.bitwise_or.reduce(bit << _BITS, axis=1)
    return out


def _weights(n: int) -> list[int]:
    return [1 << p for p in range(n - 1)] + [-(1 << (n - 1))]


def components(words: np.ndarray) -> np.ndarray:
    """The vectors that planes stand for."""
    out = np.zeros((len(words), DIM), np.int64)
    for p, weight in enumerate(_weights(words.shape[1])):
        out += weight * ((words[:, p, None] >> _BITS) & np.uint64(1)).astype(np.int64)
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot product of each vector of ``a`` with each of ``b``, both given as planes."""
    out = np.zeros((len(a), len(b)), np.int64)
    for p, u in enumerate(_weights(a.shape[1])):
        for q, v in enumerate(_weights(b.shape[1])):
            ones = np.bitwise_count(a[:, p, None] & b[None, :, q])
            out += (u * v) * ones.astype(np.int64)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Squared length of each vector."""
    out = np.zeros(len(a), np.int64)
    weights = _weights(a.shape[1])
    for p, u in enumerate(weights):
        for q, v in enumerate(weights):
            out += (u * v) * np.bitwise_count(a[:, p] & a[:, q]).astype(np.int64)
    return out


def nearest(words: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the first of equally near ones, and the squared
    distance to it."""
    of = planes(centroids)
    distance = squares(words)[:, None] - 2 * dots(words, of) + squares(of)[None, :]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(words)), cluster]


def quantized(embeddings: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the components of the vectors that have DIM of
    them, none NULL or not finite. A component of LIMIT or more stops the job."""
    x = F.transform(F.col(column), lambda c: c.cast("double"))
    known = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    beyond = F.raise_error(F.lit(f"component of {LIMIT} or more")).cast("long")
    whole = F.transform(
        x,
        lambda c: F.when(F.abs(c * scale) < LIMIT, F.floor(c * scale)).otherwise(beyond),
    )
    rows = embeddings.where((F.size(column) == DIM) & known)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _vectors(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, DIM)


def packed(vectors: DataFrame) -> DataFrame:
    """(vec_id, planes) of rows (vec_id, v); a word is carried as a signed long."""
    schema = pa.schema([("vec_id", pa.int64()), ("planes", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            words = planes(_vectors(batch.column(1), np.int64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(words), pa.list_(pa.int64()))], schema=schema
            )

    return vectors.mapInArrow(run, "vec_id long, planes array<long>")


def _read(column: pa.Array) -> np.ndarray:
    """Planes of a batch, whose rows may hold different numbers of them: a row that is
    short is filled up with its sign."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    words = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    if not len(sizes):
        return np.zeros((0, 1), np.uint64)
    ends, width = np.cumsum(sizes), int(sizes.max())
    place = np.minimum(np.arange(width)[None, :], sizes[:, None] - 1)
    return words[(ends - sizes)[:, None] + place]


def start(vectors: DataFrame, n: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; NULL ids last, rows that share an
    id in the order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(digest.alias("digest"), "v")
    first = first.orderBy(F.asc_nulls_last("digest"), "v").limit(n).collect()
    return np.array([r.v for r in first], np.int64).reshape(-1, DIM)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors."""

    def run(batches):
        n = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            words = _read(batch.column(0))
            cluster, _ = nearest(words, centroids)
            n += np.bincount(cluster, minlength=len(centroids))
            np.add.at(sums, cluster, components(words))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(held, pa.int32()),
                "n": pa.array(n[held], pa.int64()),
                "sums": pa.array(list(sums[held]), pa.list_(pa.int64())),
            }
        )

    parts = rows.select("planes").mapInArrow(run, "cluster int, n long, sums array<long>")
    exact = [F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")]
    totals = (
        parts.select("cluster", "n", F.posexplode("sums").alias("place", "total"))
        .groupBy("cluster", "place")
        .agg(*exact)
        .collect()  # one row per centroid and component
    )
    out = centroids.copy()
    for r in totals:
        out[r.cluster, r.place] = int(r.total) // r.n
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, centroid_sha256) of every vector."""
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    schema = pa.schema(
        [("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())]
        + [("centroid_sha256", pa.string())]
    )

    def run(batches):
        for batch in batches:
            cluster, distance = nearest(_read(batch.column(1)), centroids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(cluster, pa.int32()),
                    pa.array(distance),
                    pa.array([digests[c] for c in cluster], pa.string()),
                ],
                schema=schema,
            )

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long, centroid_sha256 string")


def clusters(
    embeddings: DataFrame,
    n: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    column: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256.

    Kept are the vectors with DIM components, none of them NULL or not finite; a vector
    that is NULL is not. Equally near centroids: the smaller number. An empty centroid
    stays where it is. With fewer vectors than ``n`` there are as many centroids as
    vectors. Repeated rows are vectors of their own, a NULL id stays NULL, an empty table
    gives an empty result, other columns are ignored. A scaled component of LIMIT or more
    stops the job, as squared distances might not fit in 64 bits.
    """
    vectors = quantized(embeddings, column, scale)
    centroids = start(vectors, n, seed)
    rows = keep(packed(vectors))
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    found = keep(assigned(rows, centroids))
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(total.alias("sum"))  # at most one row per centroid
    whole = F.sum("sum").over(Window.partitionBy())
    sums = sums.select(
        "cluster",
        F.col("sum").cast("long").alias("cluster_inertia"),
        whole.cast("long").alias("inertia"),
    )
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def sql(n: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, scale: int = SCALE) -> str:
    """The same clusters in DuckDB's SQL, by plain arithmetic on the components."""
    steps = [
        f"""kept AS (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(
            embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = {DIM}
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS (
        SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS c, v
        FROM kept QUALIFY c < {n})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS (
        SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS m
        FROM (
            SELECT rid, vec_id, k.v, c, CAST(list_sum(list_transform(list_zip(k.v, c{i}.v),
                lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
            FROM kept k, c{i})
        GROUP BY rid)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (
        SELECT c, i, sum(x) AS s, count(*) AS n
        FROM (SELECT m.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i})
        GROUP BY c, i),
    c{i + 1} AS (
        SELECT c, coalesce(w, v) AS v FROM c{i} LEFT JOIN (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w
            FROM s{i} GROUP BY c) USING (c))"""
            )
    last = rounds
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(m.c AS INT) AS cluster, m.d AS distance,
        CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
    FROM a{last} JOIN c{last} ON c{last}.c = a{last}.m.c"""
