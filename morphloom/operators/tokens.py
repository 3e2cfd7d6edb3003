"""Filters, token lists and simple reports on the morpheme table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from morphloom.functions import is_punct, lattice_lines, line_fields, once
from morphloom.schemas import MD_COLUMNS, key_columns, require_columns

_POSITION = ("sentence_id", "token_id")

# Marks rows that a filter takes out. No token is a line break.
_FILTERED = "\n"


def remove_punct(df: DataFrame) -> DataFrame:
    """Drop punctuation rows; rows without a tag stay."""
    return df.where(~is_punct("pos")) if "pos" in df.columns else df


def keep_pos(df: DataFrame, tags: Sequence[str] | None) -> DataFrame:
    """Keep rows with one of the tags; rows without a tag go. None keeps all."""
    if tags is None or "pos" not in df.columns:
        return df
    return df.where(F.col("pos").isin(*_tags(tags)))


def _tags(tags: Sequence[str]) -> list[str]:
    return [tags] if isinstance(tags, str) else list(tags)


def value_column(df: DataFrame, use_lemma: bool) -> str:
    """``lemma`` or ``token``; an error if the table lacks it."""
    name = "lemma" if use_lemma else "token"
    require_columns(df, name)
    return name


def usable(c: Column) -> Column:
    """True for tokens that count: neither NULL nor empty."""
    return F.coalesce(c != "", F.lit(False))


def drop_empty_tokens(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) != "")


def token_rows(
    df: DataFrame,
    use_lemma: bool = False,
    remove_punct: bool = False,
    pos_keep: Sequence[str] | None = None,
) -> DataFrame:
    """The filtered tokens one per row, with their place. No shuffle."""
    kept = keep_pos(_remove_punct(df, remove_punct), pos_keep)
    value = value_column(df, use_lemma)
    return drop_empty_tokens(
        kept.select(*key_columns(df), *_POSITION, F.col(value).alias("token")), "token"
    )


def _remove_punct(df: DataFrame, flag: bool) -> DataFrame:
    return remove_punct(df) if flag else df


def _with_concatenator(tokens: DataFrame, concatenator: str) -> DataFrame:
    return tokens.withMetadata("tokens", {"concatenator": concatenator})


def as_tokens(
    df: DataFrame,
    use_lemma: bool = False,
    concatenator: str = "_",
    remove_punct: bool = False,
    pos_keep: Sequence[str] | None = None,
    sentences_per_part: int | None = None,
) -> DataFrame:
    """Token lists in reading order: ``doc_id, part, tokens``.

    A document is one row with ``part`` 0, whatever its length: its list is bounded by
    the lattice, one row, that it came from. With ``sentences_per_part`` its list goes
    on in part 1, 2 and so on after that many sentences. Documents that share a
    ``doc_id`` need ``doc_order``, which gives them rows of their own: a place that is
    taken twice stops the job, since the order of such copies is not known.

    A document all of whose rows fall to the filters is absent; one whose remaining
    tokens are all NULL or empty has an empty list. ``concatenator`` is kept as
    metadata of the column and changes no token.

    On decoded responses :func:`lattice_tokens` gives the same lists without a
    shuffle.
    """
    require_columns(df, "doc_id", *_POSITION)
    value = F.col(value_column(df, use_lemma))
    kept = keep_pos(_remove_punct(df, remove_punct), pos_keep)
    part = F.lit(0)
    if sentences_per_part is not None:
        part = F.floor((F.col("sentence_id") - 1) / F.lit(sentences_per_part)).cast("int")
    entry = F.when(usable(value), F.struct(*_POSITION, value.alias("v")))
    repeated = _place_taken_twice(F.col("_entries"))
    stop = F.raise_error(
        F.concat(F.lit("several texts without doc_order for document "), F.col("doc_id"))
    ).cast("array<string>")
    values = F.col("_entries").getField("v")
    tokens = (
        kept.groupBy(*key_columns(df), part.alias("part"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .select(*key_columns(df), "part", F.when(repeated, stop).otherwise(values).alias("tokens"))
    )
    return _with_concatenator(tokens, concatenator)


def _place_taken_twice(entries: Column) -> Column:
    """Whether two neighbours in the sorted entries have one place. Linear; NULL is a place
    like others."""
    others = F.size(entries) - 1
    same = F.zip_with(
        F.slice(entries, F.lit(1), others),
        F.slice(entries, F.lit(2), others),
        lambda a, b: a["sentence_id"].eqNullSafe(b["sentence_id"])
        & a["token_id"].eqNullSafe(b["token_id"]),
    )
    return F.when(others > 0, F.exists(same, lambda x: x)).otherwise(False)


def to_tokens(
    df: DataFrame,
    use_lemma: bool = True,
    remove_punct: bool = True,
    pos_keep: Sequence[str] | None = None,
    concatenator: str = "_",
    sentences_per_part: int | None = None,
) -> DataFrame:
    """:func:`as_tokens` with the other defaults: lemmas, no punctuation."""
    return as_tokens(
        df,
        use_lemma=use_lemma,
        concatenator=concatenator,
        remove_punct=remove_punct,
        pos_keep=pos_keep,
        sentences_per_part=sentences_per_part,
    )


def lattice_tokens(
    decoded: DataFrame,
    use_lemma: bool = False,
    concatenator: str = "_",
    remove_punct: bool = False,
    pos_keep: Sequence[str] | None = None,
) -> DataFrame:
    """Token lists straight from decoded responses, one row per response.

    Lines are already in reading order inside the lattice, so neither a shuffle nor
    a sort is needed, and an array is never longer than the lattice it came from.
    """
    require_columns(decoded, "doc_id", "md_lattice")
    keys = key_columns(decoded)
    pos_at = MD_COLUMNS.index("cpostag")
    value_at = MD_COLUMNS.index("lemma" if use_lemma else "token")

    def value(fields: Column) -> Column:
        text = F.coalesce(F.get(fields, F.lit(value_at)), F.lit(""))
        pos = F.get(fields, F.lit(pos_at))
        wanted = None
        if remove_punct:
            wanted = ~is_punct(pos)
        if pos_keep is not None:
            tagged = F.coalesce(pos.isin(*_tags(pos_keep)), F.lit(False))
            wanted = tagged if wanted is None else wanted & tagged
        return text if wanted is None else F.when(wanted, text).otherwise(_FILTERED)

    fields = F.transform(
        lattice_lines("md_lattice"), lambda line: line_fields(line, upto=pos_at + 1)
    )
    kept = F.array_remove(F.transform(fields, lambda f: value(f)), _FILTERED)
    # As the element of a generator the array is built once, not again for the filter.
    tokens = (
        decoded.select(*keys, once(kept).alias("_kept"))
        .where(F.size("_kept") > 0)
        .select(*keys, F.lit(0).alias("part"), F.array_remove("_kept", "").alias("tokens"))
    )
    return _with_concatenator(tokens, concatenator)


def doc_names(tokens: DataFrame) -> DataFrame:
    """The documents of a token or feature table, each once."""
    return tokens.select("doc_id").distinct()


def doc_count(tokens: DataFrame) -> DataFrame:
    """``n_documents`` as a one-row table."""
    return tokens.agg(F.countDistinct("doc_id").alias("n_documents"))


def relation_filter(df: DataFrame, deprel: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with one dependency relation, reduced to some columns."""
    require_columns(df, "deprel", *(columns or ()))
    rows = df.where(F.col("deprel") == deprel)
    return rows.select(*columns) if columns else rows


def first_n(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in document order."""
    return df.orderBy(*key_columns(df), *_POSITION).limit(n)


def summary(df: DataFrame) -> DataFrame:
    """``n_morphemes, n_documents`` as a one-row table."""
    return df.agg(
        F.count(F.lit(1)).alias("n_morphemes"),
        F.countDistinct("doc_id").alias("n_documents"),
    )
