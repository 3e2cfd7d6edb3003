"""Document-feature analytics: stopwords, counts, vectors, top features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from morphloom.functions import once, strip_punct
from morphloom.operators.checkpoints import materialize
from morphloom.operators.skew import (
    BROADCAST_CHARS,
    BROADCAST_ROWS,
    filter_bits,
    measure,
    suspects,
    word_filter,
)
from morphloom.operators.tokens import (
    _remove_punct,
    drop_empty_tokens,
    keep_pos,
    value_column,
)
from morphloom.schemas import CONTENT_POS, key_columns, require_columns
from morphloom.sources.wordlists import stopwords as stopword_list

# Hash buckets whose totals bound those of their features; see topfeatures.
FEATURE_BUCKETS = 1 << 16


def strip_trailing_punct(df: DataFrame, cols: Sequence[str] = ("lemma", "token")) -> DataFrame:
    """Cut punctuation at the end of the named columns that exist."""
    present = {c: strip_punct(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def drop_emptied(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose ``col`` is the empty string; NULL stays."""
    return df.where(F.col(col).isNull() | (F.col(col) != ""))


def remove_stopwords(
    df: DataFrame,
    stopwords: DataFrame | Iterable[str] | None,
    col: str = "token",
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """Drop rows whose ``col`` is a stopword, whatever the case of either.

    ``stopwords`` is a table with a ``word`` column, a list, or None (or empty) for no
    removal. A table is measured when the plan is built: up to ``broadcast_rows`` words
    and ``broadcast_chars`` characters it is broadcast. Of a larger one a Bloom filter is
    broadcast: rows whose word it rules out stay where they are, and only the others, the
    stopwords and one word in 32 by chance, are shuffled to be joined with the list, where
    adaptive execution splits the partition of a common word. ``df`` is then read twice,
    so store it first (:func:`morphloom.store`) if it is costly or not the same on every
    reading.
    """
    if stopwords is None:
        return df
    if not isinstance(stopwords, DataFrame):
        listed = sorted({w.lower() for w in stopwords if w is not None})
        if not listed:
            return df
        n, size = len(listed), sum(map(len, listed))
        stopwords = df.sparkSession.createDataFrame([(w,) for w in listed], "word string")
    else:
        require_columns(stopwords, "word")
        n, size = measure(stopwords, "word")
    words = stopwords.select(F.lower("word").alias("_word")).where("_word IS NOT NULL")
    value = F.lower(F.col(col))
    if n <= broadcast_rows and size <= broadcast_chars:
        return df.join(F.broadcast(words), value == F.col("_word"), "left_anti")
    bits = filter_bits(n)
    if df.isStreaming or n > bits:  # nothing would be ruled out by a filter that is full
        return df.join(words.hint("merge"), value == F.col("_word"), "left_anti")
    maybe, other = suspects(df, value, word_filter(words, "_word", bits), bits)
    return other.union(maybe.join(words.hint("merge"), value == F.col("_word"), "left_anti"))


def _content_rows(
    parsed: DataFrame,
    heb_lemma: bool,
    use_lemma: bool,
    pos_keep: Sequence[str] | None,
    remove_punct: bool,
    strip_trailing_punct: bool,
) -> DataFrame:
    """The rows that make up the documents of the matrix: keys, place and ``token``."""
    if heb_lemma:
        use_lemma = True
        pos_keep = CONTENT_POS if pos_keep is None else pos_keep
    value = value_column(parsed, use_lemma)
    # Tag filters first: they are cheap, and cleaning changes no tag.
    rows = keep_pos(_remove_punct(parsed, remove_punct), pos_keep)
    place = [c for c in ("sentence_id", "token_id") if c in parsed.columns]
    strip = heb_lemma and strip_trailing_punct
    cleaned = once(strip_punct(value)) if strip else F.col(value)
    rows = rows.select(*key_columns(parsed), *place, cleaned.alias("token"))
    return drop_emptied(rows, "token") if strip else rows


def content_tokens(
    parsed: DataFrame,
    heb_lemma: bool = True,
    use_lemma: bool = True,
    pos_keep: Sequence[str] | None = None,
    remove_punct: bool = True,
    remove_stopwords: bool = True,
    stopwords: DataFrame | Iterable[str] | None = None,
    strip_trailing_punct: bool = True,
    lang: str | None = None,
    stopword_source: str = "stopwords-iso",
) -> DataFrame:
    """The tokens that are counted, one per row.

    ``stopwords`` is a list of words or, with ``lang``, a table ``lang, source, word``
    from which the list of that language and ``stopword_source`` is taken.

    With ``heb_lemma``: lemmas of content words, cleaned of trailing punctuation,
    without stopwords. Without it only ``use_lemma``, ``pos_keep`` and
    ``remove_punct`` have an effect.
    """
    rows = drop_empty_tokens(
        _content_rows(
            parsed, heb_lemma, use_lemma, pos_keep, remove_punct, strip_trailing_punct
        ),
        "token",
    )
    if heb_lemma and remove_stopwords:
        if lang is not None and isinstance(stopwords, DataFrame):
            stopwords = stopword_list(stopwords, lang, stopword_source)
        rows = _remove_stopwords(rows, stopwords)
    return rows


# The name is a parameter above.
_remove_stopwords = remove_stopwords


def dfm(tokens: DataFrame) -> DataFrame:
    """``doc_id, feature, n``: how often each lower-cased token occurs per document.

    Takes token lists or one token per row. Counts are combined before the one
    shuffle, so neither a frequent token nor a long document is a hot spot.
    """
    if "tokens" in tokens.columns:
        tokens = drop_empty_tokens(
            tokens.select("doc_id", F.explode("tokens").alias("token")), "token"
        )
    require_columns(tokens, "doc_id", "token")
    return tokens.groupBy("doc_id", F.lower("token").alias("feature")).agg(
        F.count(F.lit(1)).alias("n")
    )


def parsed_to_dfm(parsed: DataFrame, **options) -> DataFrame:
    """Morpheme table to document-feature counts; options of :func:`content_tokens`."""
    return dfm(content_tokens(parsed, **options))


def dfm_documents(
    parsed: DataFrame,
    heb_lemma: bool = True,
    use_lemma: bool = True,
    pos_keep: Sequence[str] | None = None,
    remove_punct: bool = True,
    strip_trailing_punct: bool = True,
) -> DataFrame:
    """All documents of the matrix, also those in which nothing is left to count.

    A document whose every token is a stopword or empty has no row in the long
    counts but still belongs to the matrix, so take document numbers from here.
    """
    rows = _content_rows(
        parsed, heb_lemma, use_lemma, pos_keep, remove_punct, strip_trailing_punct
    )
    return rows.select("doc_id").distinct()


def featnames(counts: DataFrame) -> DataFrame:
    """The distinct features, of counts or, with one shuffle less, of one token per row."""
    if "feature" in counts.columns:
        return counts.select("feature").distinct()
    return counts.select(F.lower("token").alias("feature")).distinct()


def _candidates(rows: DataFrame, feature: Column, size: Column, n: int, buckets: int) -> DataFrame:
    """``rows`` without those whose feature cannot be among the ``n`` largest.

    A bucket's total is at least that of each of its features. The features of the
    largest buckets are counted first; the n-th of them is a bound that the n-th of all
    features reaches, so buckets below it go.
    """
    bucket = F.pmod(F.xxhash64(feature), F.lit(buckets))
    sums = materialize(
        rows.groupBy(bucket.alias("_bucket")).agg(F.coalesce(F.sum(size), F.lit(0)).alias("_n"))
    )

    def within(some: DataFrame) -> DataFrame:
        # At most ``buckets`` rows of one number.
        some = F.broadcast(some.select("_bucket"))
        return rows.join(some, bucket == F.col("_bucket"), "left_semi")

    largest = within(sums.orderBy(F.desc("_n"), "_bucket").limit(4 * n))
    totals = largest.groupBy(feature.alias("_feature")).agg(F.sum(size).alias("_n"))
    nth = totals.select("_n").orderBy(F.desc("_n")).limit(n).agg(F.min("_n"), F.count("_n")).first()
    return within(sums.where(F.col("_n") >= nth[0])) if nth[1] == n else rows


def topfeatures(counts: DataFrame, n: int = 10, buckets: int | None = None) -> DataFrame:
    """The ``n`` features with the highest totals, ties in order of the feature.

    Takes document-feature counts or, when those are not needed otherwise, one
    token per row: that saves the shuffle by document.

    Counting every feature shuffles each task's vocabulary. With ``buckets`` (such as
    :data:`FEATURE_BUCKETS`) totals are taken by hash bucket of the feature first, and
    only features of buckets that reach the n-th total are counted by themselves. What is
    shuffled is then bounded by ``buckets`` and the candidates of each task, whatever the
    vocabulary, and the result is the same. If the totals are so even that no bucket can
    be ruled out, every feature is a candidate. ``counts`` is read three times, so store
    it first; two small jobs run when the plan is built.
    """
    if buckets is not None and buckets < 1:
        raise ValueError("buckets must be 1 or more")
    if buckets is not None and n > 0:
        if "feature" in counts.columns:
            counts = counts.select("feature", "n")
            counts = _candidates(counts, F.col("feature"), F.col("n"), n, buckets)
        else:
            counts = counts.select(F.lower("token").alias("token"))
            counts = _candidates(counts, F.col("token"), F.lit(1), n, buckets)
    if "feature" in counts.columns:
        totals = counts.groupBy("feature").agg(F.sum("n").alias("n"))
    else:
        totals = counts.groupBy(F.lower("token").alias("feature")).agg(
            F.count(F.lit(1)).alias("n")
        )
    return totals.orderBy(F.desc("n"), "feature").limit(n)


def _bucket(feature: Column) -> Column:
    """One of 4096 even buckets, the same on every run."""
    return F.substring(F.md5(feature), 1, 3)


def feature_index(counts: DataFrame) -> DataFrame:
    """``feature, n_documents, feature_index``: every feature numbered from 0 on.

    Numbers follow the first three hex digits of the feature's MD5, then the
    feature. That order needs no global sort: each of the 4096 buckets is numbered
    by itself and starts where the sizes of those before it end. The vocabulary is
    checkpointed, since sizes and numbers both come from it.
    """
    words = materialize(
        counts.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_documents"))
        .withColumn("_bucket", _bucket(F.col("feature")))
    )
    sizes = words.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # One window over at most 4096 rows, and a broadcast of as many.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("feature"))
    return (
        words.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_bucket")
        .select(
            "feature",
            "n_documents",
            (F.col("_start") + F.col("_rank") - 1).alias("feature_index"),
        )
    )


def dfm_vectors(
    counts: DataFrame,
    index: DataFrame | None = None,
    docs: DataFrame | None = None,
    features_per_block: int | None = None,
) -> DataFrame:
    """The matrix in sparse rows: ``doc_id, block, indices, values``.

    ``indices`` are sorted column numbers of :func:`feature_index` and ``values``
    their counts; a feature that a given ``index`` lacks stops the job. A document is one
    row, of ``block`` 0. With ``features_per_block`` it is one row per block of that many
    columns that it has features in, so that no row can outgrow its block, not even that
    of a document that uses more features than one array should hold.

    ``counts`` is read several times. Without an ``index`` it is checkpointed first
    and the index is made from it; a caller that has both stored passes both. Pass
    ``docs`` (:func:`dfm_documents`) to have empty rows for documents without counts.
    """
    if index is None:
        counts = materialize(counts)
        index = feature_index(counts)
    # Adaptive execution splits the partition of a feature that very many documents have.
    unknown = F.raise_error(F.concat(F.lit("not in the index: "), F.col("feature")))
    entries = counts.join(index.select("feature", "feature_index"), "feature", "left")
    entries = entries.withColumn(
        "feature_index", F.coalesce("feature_index", unknown.cast("bigint"))
    )
    if features_per_block is None:
        by, block = [], F.lit(0)
    else:
        block = F.expr(f"cast(feature_index div {int(features_per_block)} AS int)")
        by, block = [block.alias("block")], F.col("block")
    rows = (
        entries.groupBy("doc_id", *by)
        .agg(F.sort_array(F.collect_list(F.struct("feature_index", "n"))).alias("_e"))
        .select(
            "doc_id",
            block.alias("block"),
            F.col("_e").getField("feature_index").alias("indices"),
            F.col("_e").getField("n").alias("values"),
        )
    )
    if docs is None:
        return rows
    none = F.array().cast("array<bigint>")
    return docs.join(rows, "doc_id", "left").select(
        "doc_id",
        F.coalesce("block", F.lit(0)).alias("block"),
        F.coalesce("indices", none).alias("indices"),
        F.coalesce("values", none).alias("values"),
    )
