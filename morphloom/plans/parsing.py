"""Documents or responses to the morpheme table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from morphloom.operators.annotation import Annotator, annotate, decode_responses
from morphloom.operators.lattices import ambiguous_lattices, morphemes
from morphloom.operators.checkpoints import materialize


def _decoded(
    source: DataFrame,
    annotator_factory: Callable[[], Annotator] | None,
    pre_tokenized: bool,
    on_error: str,
    fields: tuple[str, ...],
    partitions: int | None,
    keep: bool = False,
    **calls,
) -> DataFrame:
    """Whatever the source is, its lattice columns."""
    if annotator_factory is not None:
        responses = annotate(
            source, annotator_factory, pre_tokenized, on_error, partitions, **calls
        )
        if keep:
            responses = materialize(responses)
        return decode_responses(responses, on_error, fields)
    if "response" in source.columns:
        return decode_responses(source, on_error, fields)
    if "md_lattice" in source.columns:
        return source
    raise ValueError("documents need an annotator_factory; responses need a response column")


def parse(
    source: DataFrame,
    annotator_factory: Callable[[], Annotator] | None = None,
    dependency: bool = False,
    pre_tokenized: bool = False,
    keep_lattice: bool = False,
    on_error: str = "fail",
    partitions: int | None = None,
    **calls,
):
    """One row per morpheme.

    ``source`` is a document table together with an ``annotator_factory``, or a
    table of stored responses (or of their decoded lattices) without one. The
    columns are ``doc_id, sentence_id, token_id, token, lemma, pos, xpos, feats``
    and, with ``dependency``, ``head_token_id, deprel``. Documents are dealt out to
    ``partitions`` tasks, where given, before they are annotated; ``in_flight`` and
    ``deadline`` are those of :func:`annotate`.

    With ``keep_lattice`` the result is a pair: the morpheme table and the
    ambiguous lattices ``doc_id, ma_lattice``. As both read the responses, these are
    checkpointed so that no document is annotated twice.
    """
    fields = ("md_lattice",) + (("dep_tree",) if dependency else ())
    both = fields + (("ma_lattice",) if keep_lattice else ())
    decoded = _decoded(
        source, annotator_factory, pre_tokenized, on_error, both, partitions, keep_lattice, **calls
    )
    table = morphemes(decoded, dependency)
    return (table, ambiguous_lattices(decoded)) if keep_lattice else table


def parse_dependencies(
    source: DataFrame,
    annotator_factory: Callable[[], Annotator] | None = None,
    pre_tokenized: bool = False,
    on_error: str = "fail",
    partitions: int | None = None,
    **calls,
) -> DataFrame:
    """:func:`parse` with dependency columns."""
    return parse(
        source,
        annotator_factory,
        True,
        pre_tokenized=pre_tokenized,
        on_error=on_error,
        partitions=partitions,
        **calls,
    )
