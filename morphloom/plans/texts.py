"""Documents or responses to token lists and document-feature counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from morphloom.operators.annotation import Annotator
from morphloom.operators.features import parsed_to_dfm
from morphloom.operators.lattices import content_morphemes
from morphloom.operators.tokens import lattice_tokens
from morphloom.plans.parsing import _decoded


def text_to_dfm(
    source: DataFrame,
    annotator_factory: Callable[[], Annotator] | None = None,
    pre_tokenized: bool = False,
    on_error: str = "fail",
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Document-feature counts in one step.

    The source is that of :func:`morphloom.plans.parse`, the options are those of
    :func:`morphloom.operators.content_tokens`.
    """
    decoded = _decoded(
        source, annotator_factory, pre_tokenized, on_error, ("md_lattice",), partitions
    )
    return parsed_to_dfm(content_morphemes(decoded), **options)


def text_to_tokens(
    source: DataFrame,
    annotator_factory: Callable[[], Annotator] | None = None,
    pre_tokenized: bool = False,
    on_error: str = "fail",
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Token lists in one step and without a shuffle; options of ``lattice_tokens``."""
    decoded = _decoded(
        source, annotator_factory, pre_tokenized, on_error, ("md_lattice",), partitions
    )
    return lattice_tokens(decoded, **options)
