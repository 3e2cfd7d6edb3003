"""Which tables of words are small enough to broadcast, and a filter for those that are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A broadcast table of words holds at most this many rows and characters.
BROADCAST_ROWS = 1_000_000
BROADCAST_CHARS = 32_000_000


# Bits of a filter per word of its list: one word in 32 that is not listed passes it.
BITS_PER_WORD = 32
# A filter is never larger than this many bits (128 MB), whatever the list.
MAX_BITS = 1 << 30
_ROW_BITS = 1 << 15  # bits in a row of the filter, as 512 words of 64


def measure(words: DataFrame, col: str) -> tuple[int, int]:
    """Rows and characters of a word table, counted."""
    size = F.coalesce(F.sum(F.octet_length(col)), F.lit(0))
    return tuple(words.agg(F.count(F.lit(1)), size).first())


def is_small(
    words: DataFrame, col: str, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS
) -> bool:
    """Whether a word table is safe to broadcast: its rows and characters, counted."""
    n, size = measure(words, col)
    return n <= rows and size <= chars


def filter_bits(n: int) -> int:
    """Size of the filter for a list of ``n`` words: a power of two between one row and
    ``MAX_BITS``."""
    return min(MAX_BITS, max(_ROW_BITS, 1 << (BITS_PER_WORD * n - 1).bit_length()))


def _bit(word: Column, bits: int) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(bits - 1))


def word_filter(words: DataFrame, col: str, bits: int) -> DataFrame:
    """A Bloom filter as a table ``_filter_row, _filter_words``: the bit at each word's hash is set.

    A row holds 32,768 bits, so the whole of it has a known size, ``bits`` / 8 bytes at
    most, and a bit is found by a join on the row and an access to its array.
    """
    bit = _bit(F.col(col), bits)
    cell = F.shiftright(bit, 6)
    cells = words.where(F.col(col).isNotNull()).groupBy(cell.alias("_cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("_value")
    )
    place = F.col("_cell").bitwiseAND(F.lit(511)).cast("int")
    pairs = F.map_from_entries(F.collect_list(F.struct(place, "_value")))
    return cells.groupBy(F.shiftright("_cell", 9).alias("_filter_row")).agg(
        F.transform(
            F.sequence(F.lit(0), F.lit(511)),
            lambda i: F.coalesce(F.try_element_at(pairs, i), F.lit(0).cast("bigint")),
        ).alias("_filter_words")
    )


def suspects(df: DataFrame, word: Column, filter_table: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``word`` may be in the filter's list, and rows whose word
    is not. No shuffle; the filter is broadcast. ``df`` is read for each."""
    bit = _bit(word, bits)
    cell = F.shiftright(bit, 6).bitwiseAND(F.lit(511)).cast("int")
    marked = df.join(F.broadcast(filter_table), F.shiftright(bit, 15) == F.col("_filter_row"), "left")
    found = F.getbit(F.get("_filter_words", cell), bit.bitwiseAND(F.lit(63)).cast("int"))
    maybe = F.coalesce(found == 1, F.lit(False))
    return marked.where(maybe).select(*df.columns), marked.where(~maybe).select(*df.columns)
