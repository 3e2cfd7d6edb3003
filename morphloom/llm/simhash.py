"""Near duplicates by SimHash, found through an inverted index on bytes and positions.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of
their eight bytes, so they share at least five bytes at equal positions. The postings
of the index are (position, byte value) terms. A posting of one byte would hold a
256th of all fingerprints, so the index keeps the intersections of four postings for
14 sets of four positions, chosen so that every five positions contain one of the sets
(the blocks of a Steiner system S(3,4,8)). Whatever shares five bytes therefore meets
in a posting; there the shared bytes of a pair are tallied, pairs below five are left
out and the others verified by their differing bits.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from morphloom.llm.common import columns, components, keep, texts, tidy

SEED = 42
WIDTH = 3
MAX_BITS = 3
BLOCK = 1024

# The positions 0-7 are split into two halves; the sets are the halves themselves and
# pairs of one half with pairs of the other half from the same of its three matchings.
_MATCHINGS = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
POSITIONS = [(0, 1, 2, 3), (4, 5, 6, 7)] + [
    (*p, q[0] + 4, q[1] + 4) for m in _MATCHINGS for p in m for q in m
]


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """Unsigned SimHash of the word shingles of ``text``; 0 if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.uint32) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(doc_id, digest, fp): a digest and the fingerprint, a signed long, of each whole text."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "digest", "fp")])

    def run(batches):
        for batch in batches:
            ids, digests, bodies = batch.columns
            fps = np.array([fingerprint(t, width, seed) for t in texts(bodies)], np.uint64)
            signed = pa.array(fps.view(np.int64))
            yield pa.RecordBatch.from_arrays([ids, digests, signed], schema=schema)

    whole = columns(docs).select("doc_id", F.xxhash64("text").alias("digest"), "text")
    return whole.mapInArrow(tidy(run), "doc_id long, digest long, fp long")


def _byte(position: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def _posting(number: int, positions: tuple[int, ...]) -> Column:
    value = F.lit(number)
    for p in positions:
        value = value * F.lit(256) + _byte(p)
    return value


def forest(values: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect whatever is connected in ``values``, one per found value."""
    edges, left = [], np.unique(values)
    while left.size:
        stack, left = [left[0]], left[1:]
        while stack and left.size:
            at = stack.pop()
            differ = left ^ at
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = shared >= 8 - max_bits
            near[near] = np.bitwise_count(differ[near]) <= max_bits
            if near.any():
                found = left[near]
                edges.extend((at, x) for x in found)
                stack.extend(found)
                left = left[~near]
    return edges


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) between distinct fingerprints ``fp``: not all pairs within ``max_bits`` (3
    at most), but enough to connect every two that such pairs connect.

    A posting of more than ``block`` fingerprints is dealt into blocks and each pair of
    blocks is compared on its own, so no task holds more than two blocks.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees links of up to three bits")
    postings = distinct.select(
        "fp", F.explode(F.array(*[_posting(i, p) for i, p in enumerate(POSITIONS)])).alias("key")
    )
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("fp"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    dealt = (
        postings.join(sizes, "key")
        .select("key", "fp", own.alias("own"), other.alias("other"))
        .groupBy("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            found = []
            for fps in batch.column(0):
                values = fps.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found.extend(forest(values, max_bits))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema
            )

    return dealt.select("fps").mapInArrow(tidy(run), "a long, b long").distinct()


def grouped(
    docs: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(doc_id, digest, fp, root): ``root`` is the smallest fingerprint connected with ``fp``."""
    marked = keep(fingerprints(docs, width))
    roots = components(links(marked.select("fp").distinct(), max_bits, block))
    found = marked.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return found.select("doc_id", "digest", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links of at most
    ``max_bits`` differing bits. Texts that are NULL or have no word have fingerprint 0
    and link like others. Copies share a fingerprint and are one node, so a group of
    copies costs no pairs. A NULL ``doc_id`` takes part but is never the smallest; the
    component is NULL only if all its ids are. Repeated rows come back repeated, an empty
    table gives an empty result, other columns are ignored.
    """
    found = grouped(docs, **options)
    least = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of each component one row, with the smallest id."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    chosen = grouped(docs, **options).groupBy("root").agg(first.alias("first"))
    chosen = chosen.select(
        F.col("first.doc_id").alias("_kept"), F.col("first.digest").alias("_digest")
    )
    digest = F.xxhash64(F.col("text").cast("binary"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (digest == F.col("_digest"))
    stay = docs.join(chosen, same, "left_semi").withColumn("_digest", digest)
    return stay.dropDuplicates(["doc_id", "_digest"]).drop("_digest")
