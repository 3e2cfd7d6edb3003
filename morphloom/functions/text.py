"""Text expressions: wire format, punctuation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from morphloom.schemas import PUNCT_PREFIX


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_wire(text: Column | str) -> Column:
    """One token per line, closed by a blank line.

    Only the six ASCII whitespace characters separate tokens; a no-break space
    is part of a token. Blank text gives just the terminator.
    """
    one_per_line = F.regexp_replace(_col(text), r"\s+", "\n")
    # Spark's trim of given characters reads all of the text, so it is for those that need it.
    ragged = F.startswith(one_per_line, F.lit("\n")) | F.endswith(one_per_line, F.lit("\n"))
    trimmed = F.when(ragged, F.btrim(one_per_line, F.lit("\n"))).otherwise(one_per_line)
    return F.concat(trimmed, F.lit("\n\n"))


def strip_punct(c: Column | str) -> Column:
    """Cut the run of punctuation and symbols at the end; inner marks stay."""
    c = _col(c)
    last = F.substring(c, -1, 1)
    # A text that ends in one of these has no such run, and needs no pattern.
    plain = last.between("a", "z") | last.between("0", "9") | last.between("A", "Z")
    # Only the start of a run is tried and no run is given back, so the cost is linear.
    stripped = F.regexp_replace(c, r"(?<![\p{P}\p{S}])[\p{P}\p{S}]++\z", "")
    return F.when(plain, c).otherwise(stripped)


def is_punct(pos: Column | str) -> Column:
    """True for punctuation tags; a NULL tag is not punctuation."""
    return F.coalesce(F.startswith(_col(pos), F.lit(PUNCT_PREFIX)), F.lit(False))
