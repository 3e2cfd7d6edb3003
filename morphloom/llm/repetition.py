"""Repetition within a text, from a suffix array of its words.

The suffix arrays of many documents are made together: the first rank of a word is that
of (document, word), so suffixes of different documents never mix. Ranks are doubled in
length until all suffixes differ; only those still equal are sorted again. The common
prefixes of neighbours in the array, read off the ranks kept of each doubling, bound
the intervals of the maximal repeated substrings: the longest repeat that starts at a
word is the larger one of its two. Spans of repeats are united by counting how many
cover each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from morphloom.llm.common import columns

MIN_REPEAT = 10  # words
# The base rule lets half of the words be in repeated 3-word windows. What is covered by
# longer repeats is part of that, and two copies of a repeat cover twice its length: only
# limits well below a half and a quarter can reject a text that the base rule passes.
MAX_COVERED = 0.15  # of the words, by repeats of MIN_REPEAT words or more
MAX_LONGEST = 0.05  # of the words, but LONGEST_FREE are always allowed
LONGEST_FREE = 30
BATCH = 400_000  # words handled together; a longer text is a batch of its own

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


def suffix_ranks(doc: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4... words within the document; the last are all different."""
    n = len(word)
    order = np.lexsort((word, doc))
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (word[order][1:] != word[order][:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    rank[order] = np.repeat(starts, sizes)
    active = order[np.repeat(sizes > 1, sizes)]  # grouped by rank
    levels, width = [rank], 1
    while len(active):
        after = active + width
        inside = after < n
        inside[inside] = doc[after[inside]] == doc[active[inside]]
        following = np.full(len(active), -1, np.int64)
        following[inside] = rank[after[inside]]
        by = np.lexsort((following, rank[active]))
        active, following = active[by], following[by]
        old = rank[active]
        head = np.ones(len(active), bool)
        head[1:] = old[1:] != old[:-1]
        new = head.copy()
        new[1:] |= following[1:] != following[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(active)))
        within = np.arange(len(active)) - np.repeat(np.flatnonzero(head), np.diff(np.append(np.flatnonzero(head), len(active))))
        rank = rank.copy()
        rank[active] = old + np.repeat(within[starts], sizes)
        active = active[np.repeat(sizes > 1, sizes)]
        levels.append(rank)
        width *= 2
    return levels


def longest_repeats(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For each word the length, in words, of the longest repeat in its document that
    starts there; 0 if none does."""
    n = len(word)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    levels = suffix_ranks(doc, word)
    array = np.argsort(levels[-1])
    a, b = array[:-1], array[1:]
    same = levels[0][a] == levels[0][b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        fits = np.maximum(x, y) < n
        fits[fits] = levels[k][x[fits]] == levels[k][y[fits]]
        lcp[fits] += 1 << k
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of ``least`` words or more."""
    starts = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    change[starts] += 1
    np.subtract.at(change, starts + longest[starts], 1)
    return np.cumsum(change[:-1]) > 0


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            n += line in seen
            seen.add(line)
    return n


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """Counts of each text, in one pass over all their words."""
    split = [t.encode().split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    ids: dict[bytes, int] = {}
    word = np.array([ids.setdefault(w, len(ids)) for words in split for w in words], np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    longest = longest_repeats(doc, word)

    def per_text(values):
        return np.bincount(doc, values, len(texts)).astype(np.int64)

    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, doc, longest)
    return {
        "n_words": n_words,
        "word_chars": np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": per_text(covered(longest, 3)),
        "n_covered": per_text(covered(longest, MIN_REPEAT)),
        "longest_repeat": most,
    }


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_covered", "longest_repeat"]


def quality(
    docs: DataFrame, max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_covered, longest_repeat.

    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows.
    Other texts are kept if repeats of MIN_REPEAT words cover at most ``max_covered`` of
    the words and the longest repeat is at most ``max_longest`` of them (or LONGEST_FREE
    words). A NULL text has no words and fails. Repeated rows and NULL ids are measured
    like others, an empty table gives an empty result, other columns are ignored.
    """
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in _NAMES]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
        + [(n, pa.int64()) for n in _MORE]
    )

    def judged(ids: list, texts: list[str]) -> pa.RecordBatch:
        m = measure(texts)
        n = m["n_words"]
        failed = (n < 50) | (100 * m["n_repeat_words"] > 50 * n)
        good = (m["n_covered"] <= max_covered * n) & (
            m["longest_repeat"] <= np.maximum(LONGEST_FREE, max_longest * n)
        )
        arrays = [ids, *(m[c] for c in _NAMES), failed, ~failed & good, *(m[c] for c in _MORE)]
        return pa.RecordBatch.from_arrays(
            [pa.array(a, t) for a, t in zip(arrays, schema.types)], schema=schema
        )

    def run(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                if texts and size + len(text) > 6 * BATCH:
                    yield judged(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
            if texts:
                yield judged(ids, texts)

    ddl = ", ".join(
        f"{f.name} {'boolean' if f.type == pa.bool_() else 'long'}" for f in schema
    )
    return columns(docs, "string").mapInArrow(run, ddl)


# The rows of :func:`quality` with its default limits. Equal words on one diagonal of a text
# with itself make up its repeats.
SQL = rf"""
  WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
  ),
  w AS (SELECT r, unnest(generate_series(1, len(words))) AS i, unnest(words) AS word FROM d),
  sized (size) AS (VALUES (3), ({MIN_REPEAT})),
  windows AS (
    SELECT r, size, i,
           count(*) OVER (PARTITION BY r, size, words[i : i + size - 1]) > 1 AS twice
    FROM (SELECT r, words, unnest(generate_series(1, len(words))) AS i FROM d), sized
    WHERE i + size - 1 <= len(words)
  ),
  covered AS (
    SELECT r, size, count(DISTINCT place) AS n
    FROM (SELECT r, size, unnest(generate_series(i, i + size - 1)) AS place FROM windows WHERE twice)
    GROUP BY ALL
  ),
  runs AS (
    SELECT r, count(*) AS n
    FROM (SELECT a.r, b.i - a.i AS apart,
                 a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS run
          FROM w a JOIN w b ON a.r = b.r AND a.word = b.word AND a.i < b.i)
    GROUP BY r, apart, run
  ),
  counts AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
             AS n_symbols,
           (SELECT count(*) - count(DISTINCT line) FROM (SELECT unnest(string_split(text, chr(10))) AS line)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_dup_lines,
           coalesce((SELECT n FROM covered c WHERE c.r = d.r AND size = 3), 0) AS n_repeat_words,
           coalesce((SELECT n FROM covered c WHERE c.r = d.r AND size = {MIN_REPEAT}), 0) AS n_covered,
           coalesce((SELECT max(n) FROM runs u WHERE u.r = d.r), 0) AS longest_repeat
    FROM d
  ),
  judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
  )
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND n_covered <= CAST({MAX_COVERED} AS DOUBLE) * n_words
         AND longest_repeat <= greatest({LONGEST_FREE}, CAST({MAX_LONGEST} AS DOUBLE) * n_words) AS kept,
         n_covered, longest_repeat
  FROM judged"""
