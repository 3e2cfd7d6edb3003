"""Ranked search with K2-treaps over grids of terms and documents.

The terms of the items are the rows of a grid, documents its columns, and a cell holds
the impact of a term in a document. A K2-treap halves the grid in both directions again
and again and keeps the quadrants that hold anything, level by level: four bits per node
say which of its quadrants exist, the number of ones before them leads to the children,
and a node's maximum impact is stored as the difference from its parent's.

An item goes down its rows' paths jointly: an entry of the queue is a range of documents
with the node of each of the item's rows there, and its bound is the sum of the nodes'
maxima. The entries of the largest bounds are split into their two halves first. At the
last level a node is a cell and the sum is the document's score; the search ends when no
bound reaches the score of the last place.

Documents are dealt to treaps by blocks as tasks read them; of each task an item's best
documents are shuffled. The items are worked off in blocks of a bounded size, each of
which reads all documents; their vocabulary and the counts of its terms are all that the
driver holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from morphloom.llm.common import columns, keep

PLACES = 20
DOCUMENTS = 1 << 13  # documents of a treap
CELLS = 1 << 20  # cells after which a treap is closed
ITEM_BYTES = 8_000_000  # text of the items that are worked off at once
SPLIT = 32  # entries of a queue split at once

_PIECE = 1 << 20
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists for pieces of bounded length."""
    text, at = text.translate(_TERM), 0
    while at < len(text):
        end = text.find(b" ", at + _PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Treap:
    """The K2-treap of cells (row, column, impact), every cell once, impacts above 0."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray):
        self.height = max(1, int(max(rows.max(initial=0), cols.max(initial=0))).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.height):
            code |= ((cols >> bit) & 1) << (2 * bit) | ((rows >> bit) & 1) << (2 * bit + 1)
        order = np.argsort(code, kind="stable")
        code, top = code[order], impacts[order]
        masks, differences = [], []
        for _ in range(self.height):  # from the cells up
            parent = code >> 2
            begin = np.flatnonzero(np.diff(parent, prepend=-1))
            above = np.maximum.reduceat(top, begin)
            sizes = np.diff(begin, append=len(code))
            masks.append(np.bitwise_or.reduceat(1 << (code & 3), begin).astype(np.uint8))
            differences.append(np.repeat(above, sizes) - top)
            code, top = parent[begin], above
        self.top = int(top[0])
        self.masks = np.concatenate(masks[::-1])  # nodes from the root down, without the cells
        # child of a node: the ones in all masks before it, and in its own before the quadrant
        ones = np.bitwise_count(self.masks).astype(np.int32)
        self.ranks = np.cumsum(ones) - ones + 1
        found = np.concatenate([np.zeros(1, np.int64), *differences[::-1]])
        kinds = (np.uint8, np.uint16, np.uint32, np.uint64)
        self.less = found.astype(next(k for k in kinds if found.max() <= np.iinfo(k).max))

    def children(self, nodes: np.ndarray, quadrant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children in a quadrant, and whether they exist."""
        mask = self.masks[nodes]
        before = mask & ((np.uint8(1) << quadrant) - np.uint8(1))
        return self.ranks[nodes] + np.bitwise_count(before), (mask >> quadrant & 1).astype(bool)


def best(
    treap: Treap, rows: np.ndarray, times: np.ndarray, places: int, floor: int = 1, split: int = SPLIT
) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores that contain the ``places`` highest sums of ``times`` * impact
    over ``rows``, and all that are equal to the last of these, but for sums below
    ``floor``. Best first: the ranges of the largest bounds are split, ``split`` at once.
    """
    height, k = treap.height, len(rows)
    path = (rows[None, :] >> np.arange(height - 1, -1, -1)[:, None]) & 1
    path = (path << 1).astype(np.uint8)
    nodes = np.zeros((1, k), np.int32)  # -1: the row has nothing in the range
    values = np.full((1, k), treap.top, np.int64)
    # entries: (-bound, place in the arrays of its batch, level, first column, nodes, values)
    queue: list[tuple] = [(-int(values[0] @ times), 0, 0, 0, nodes[0], values[0])]
    made, found = 1, []  # found: heap of the best scores
    cols: list[np.ndarray] = []
    scores: list[np.ndarray] = []
    while queue and -queue[0][0] >= floor:
        taken = []
        while queue and len(taken) < split and -queue[0][0] >= floor:
            taken.append(heappop(queue))
        level = np.array([e[2] for e in taken])
        at = np.array([e[3] for e in taken], np.int64)
        nodes, values = np.stack([e[4] for e in taken]), np.stack([e[5] for e in taken])
        alive = nodes >= 0
        safe = np.where(alive, nodes, 0)
        for half in (0, 1):
            child, there = treap.children(safe, path[level] + np.uint8(half))
            there &= alive
            child = np.where(there, child, 0)
            value = np.where(there, values - treap.less[child].astype(np.int64), 0)
            bound = value @ times
            child = np.where(there, child, -1).astype(np.int32)
            col, ends = at << 1 | half, level + 1 == height
            done = np.flatnonzero(ends & (bound >= floor))
            if len(done):
                cols.append(col[done])
                scores.append(bound[done])
                for s in bound[done].tolist():
                    heappush(found, s)
                    if len(found) > places:
                        heappop(found)
                if len(found) == places:
                    floor = max(floor, found[0])
            for i in np.flatnonzero(~ends & (bound >= floor)).tolist():
                made += 1
                entry = (-int(bound[i]), made, int(level[i]) + 1, int(col[i]), child[i], value[i])
                heappush(queue, entry)
    if not cols:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    col, score = np.concatenate(cols), np.concatenate(scores)
    return col[score >= floor], score[score >= floor]


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): the number of all terms of each whole text, and which of
    the vocabulary's it has how often."""
    numbers = pa.list_(pa.int32())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", numbers), ("tfs", pa.list_(pa.int64()))]
    )

    def run(batches):
        for batch in batches:
            n, found, tfs = [], [], []
            for text in batch.column(1):
                total, seen = 0, Counter()
                for words in terms(text.as_py() or b""):
                    total += len(words)
                    seen.update(map(vocabulary.get, words))
                seen.pop(None, None)
                n.append(total)
                found.append(list(seen))
                tfs.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip((n, found, tfs), schema.types[1:])],
                schema=schema,
            )

    return columns(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _blocks(batches, documents: int, cells: int):
    """Documents, the owner of each cell, terms and counts, in blocks for one treap each."""
    held, size = [], 0
    for batch in batches:
        at = 0
        ends = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            room = cells - sum(len(b.column(2).flatten()) for b in held)
            used = ends[at - 1] if at else 0
            stop = max(int(np.searchsorted(ends, used + room)), at + 1)
            stop = min(stop, at + documents - size, batch.num_rows)
            held.append(batch.slice(at, stop - at))
            size, at = size + stop - at, stop
            if size >= documents or at < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]):
    whole = pa.Table.from_batches(held).combine_chunks()
    ids, n = whole.column("doc_id").combine_chunks(), whole.column("n").to_numpy()
    lists = whole.column("terms").combine_chunks()
    owner = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (lists, whole.column("tfs").combine_chunks())]
    return ids, n, owner, flat[0].astype(np.int64), flat[1].astype(np.int64)


def searched(
    rows: DataFrame,
    items: list[tuple[str, np.ndarray, np.ndarray]],
    weights: np.ndarray,
    n_documents: int,
    n_terms: int,
    places: int = PLACES,
    documents: int = DOCUMENTS,
    cells: int = CELLS,
) -> DataFrame:
    """(item, doc_id, score): of each task the best documents of every item, which is given
    by its key, its terms and how often it has each."""
    schema = pa.schema([("item", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        # per item (score, id) of the best so far, the worst first
        kept: list[list[tuple]] = [[] for _ in items]
        for ids, n, owner, term, tf in _blocks(batches, documents, cells):
            m = 75 + (25 * n * n_documents) // n_terms
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner]))
            some = impact > 0
            if not some.any():
                continue
            used, row = np.unique(term[some], return_inverse=True)
            # Columns by the term that weighs most, so that texts alike lie side by side.
            heavy = np.lexsort((-impact[some], owner[some]))
            first = np.flatnonzero(np.diff(owner[some][heavy], prepend=-1))
            by = np.full(len(n), len(used))
            by[owner[some][heavy][first]] = row[heavy][first]
            order = np.lexsort((n, by))
            column = np.empty(len(n), np.int64)
            column[order] = np.arange(len(n))
            treap = Treap(row, column[owner[some]], impact[some])
            for i, (_, own, times) in enumerate(items):
                at = np.minimum(np.searchsorted(used, own), len(used) - 1)
                have = used[at] == own
                if not have.any():
                    continue
                best_so_far = kept[i]
                floor = best_so_far[0][0] if len(best_so_far) == places else 1
                cols, scores = best(treap, at[have], times[have], places, floor)
                new = [(int(s), _last(ids[int(d)].as_py())) for d, s in zip(order[cols], scores)]
                kept[i] = sorted(best_so_far + new)[-places:]
        out = [(items[i][0], -d if d > -_NONE else None, s) for i, k in enumerate(kept) for s, d in k]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema
            )

    return rows.where(F.size("terms") > 0).mapInArrow(run, "item string, doc_id long, score long")


_NONE = 1 << 64


def _last(doc_id: int | None) -> int:
    """Sorts smaller ids behind larger ones, and NULL before all."""
    return -_NONE if doc_id is None else -doc_id


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def search(
    docs: DataFrame,
    items: DataFrame,
    places: int = PLACES,
    item_bytes: int = ITEM_BYTES,
    documents: int = DOCUMENTS,
    cells: int = CELLS,
) -> DataFrame:
    """Per row of ``items`` its ``places`` documents of the highest score above 0:
    item_id, rank, doc_id, score.

    Equal scores go by ascending ``doc_id``, a NULL id last. A NULL text has no term; an
    item without terms, or whose terms no document has, has no rows. Repeated documents
    are ranked each; repeated items have a ranking each. Empty tables give an empty
    result, other columns are ignored. Items of one text are searched once; ``item_bytes``
    bounds the texts worked off at once (one text at least).
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keyed = items.select(
        F.col("item_id").cast("long").alias("item_id"), text.alias("text"), F.sha2(text, 256).alias("item")
    )
    distinct = keyed.select("item", "text").distinct()
    size = distinct.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = []
    for block in range(n_blocks := max(1, -(-size // item_bytes))):
        own = distinct if n_blocks == 1 else distinct.where(_dealt(F.col("item"), n_blocks) == block)
        parts.append(_search(docs, own.collect(), places, documents, cells))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= places)
    return keyed.select("item_id", "item").join(ranked, "item").select("item_id", "rank", "doc_id", "score")


def _dealt(item: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(blocks))


def _search(docs: DataFrame, rows: list, places: int, documents: int, cells: int) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    items = []
    for key, text in sorted((r.item, bytes(r.text)) for r in rows):
        own: Counter = Counter()
        for words in terms(text):
            own.update(vocabulary.setdefault(w, len(vocabulary)) for w in words)
        if own:
            counts = sorted(own.items())
            items.append((key, *(np.array(c, np.int64) for c in zip(*counts))))
    marked = keep(counted(docs, vocabulary))
    total = marked.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("terms")).first()
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    df = marked.select(F.explode("terms").alias("term")).groupBy("term").count()
    for r in df.collect():  # at most one row per term of the block's items
        weights[r.term] = weight(total.n, r["count"])
    return searched(marked, items, weights, total.n, total.terms or 1, places, documents, cells)


# What a term is made of, and its case.
_SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL = rf"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_TERM}')) AS term
    FROM documents),
tf AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term),
size AS (SELECT row, sum(tf) AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS nn, sum(n) AS ll FROM size),
weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term, nn),
wanted AS (
    SELECT row, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_TERM}')) AS term
    FROM (SELECT row_number() OVER () AS row, * FROM benchmark)),
scored AS (
    SELECT q.row AS item, any_value(q.item_id) AS item_id, tf.row, any_value(tf.doc_id) AS doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + CAST((25 * n * nn) // ll AS BIGINT))))) AS BIGINT) AS score
    FROM wanted q JOIN tf USING (term) JOIN weight USING (term) JOIN size ON size.row = tf.row, total
    GROUP BY q.row, tf.row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {PLACES}
"""
