"""Whole jobs put together from the operators."""

from morphloom.operators.checkpoints import materialize, store
from morphloom.plans.parsing import parse, parse_dependencies
from morphloom.plans.texts import text_to_dfm, text_to_tokens

__all__ = [
    "materialize",
    "parse",
    "parse_dependencies",
    "store",
    "text_to_dfm",
    "text_to_tokens",
]
