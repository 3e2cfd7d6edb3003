"""Morphology-aware text analytics on Spark."""

from morphloom import functions, operators, plans, schemas, sources
from morphloom.functions import strip_punct, to_wire
from morphloom.operators import *  # noqa: F401,F403
from morphloom.operators import __all__ as _operators
from morphloom.plans import (
    materialize,
    parse,
    parse_dependencies,
    store,
    text_to_dfm,
    text_to_tokens,
)
from morphloom.schemas import CONTENT_POS, empty_parse
from morphloom.sources import (
    documents,
    documents_from_strings,
    responses,
    spread_small,
    stopwords,
)

__all__ = [
    "CONTENT_POS",
    "documents",
    "documents_from_strings",
    "empty_parse",
    "functions",
    "materialize",
    "operators",
    "parse",
    "parse_dependencies",
    "plans",
    "responses",
    "schemas",
    "sources",
    "spread_small",
    "stopwords",
    "store",
    "strip_punct",
    "text_to_dfm",
    "text_to_tokens",
    "to_wire",
    *_operators,
]
