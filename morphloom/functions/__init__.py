"""Column functions: no DataFrame, no Python in the data path."""

from morphloom.functions.lattice import (
    int_or_null,
    lattice_lines,
    line_fields,
    once,
    sentence_blocks,
    sentence_lines,
)
from morphloom.functions.text import is_punct, strip_punct, to_wire

__all__ = [
    "int_or_null",
    "is_punct",
    "lattice_lines",
    "line_fields",
    "once",
    "sentence_blocks",
    "sentence_lines",
    "strip_punct",
    "to_wire",
]
