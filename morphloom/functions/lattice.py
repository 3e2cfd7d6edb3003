"""Expressions that take tab-separated lattice text apart.

A lattice is lines of tab-separated fields, with blank lines between sentences.
Only a line of length zero is blank: a line of spaces is a row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from morphloom.functions.text import _col

# Decimal numbers as text. Spark's own cast also takes '1d' and '1f'. No quantifier gives
# back what it took, so the cost is linear.
_NUMBER = r"^\s*+[+-]?+(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+\s*+$"


# A lattice without the blank lines at its ends. Spark's trim of given characters would list
# the place of every character.
_INNER = r"(?s)\A\n*+(.*[^\n])"


def _body(lattice: Column | str) -> Column:
    """The lattice without blank lines at its ends; NULL if nothing is left."""
    lattice = _col(lattice)
    # The blank line behind the last sentence, which nearly every lattice has, is cut off as
    # bytes, and only what is still ragged is read as a whole.
    raw = lattice.cast("binary")
    short = F.substring(raw, F.lit(1), F.octet_length(raw) - 2).cast("string")
    cut = F.when(F.endswith(lattice, F.lit("\n\n")), short).otherwise(lattice)
    ragged = F.startswith(cut, F.lit("\n")) | F.endswith(cut, F.lit("\n"))
    inner = F.when(ragged, F.regexp_extract(cut, _INNER, 1)).otherwise(cut)
    return F.nullif(inner, F.lit(""))


def sentence_blocks(lattice: Column | str) -> Column:
    """Array of sentences, each still one string; NULL for an empty lattice."""
    return F.split(_body(lattice), "\n\n+")


def sentence_lines(block: Column | str) -> Column:
    """Array of the lines of one sentence."""
    return F.split(_col(block), "\n")


def lattice_lines(lattice: Column | str) -> Column:
    """Array of all lines in reading order, whatever their sentence."""
    return F.split(_body(lattice), "\n+")


def line_fields(line: Column | str, upto: int | None = None) -> Column:
    """Array of the fields of one line.

    One empty field at the very end is no field (it reads as NULL); empty fields
    elsewhere stay empty. With ``upto`` only that many fields are taken apart and
    the rest of the line stays together behind them, which is cheaper.
    """
    line = _col(line)
    trimmed = F.when(
        F.endswith(line, F.lit("\t")), F.substring(line, F.lit(1), F.char_length(line) - 1)
    ).otherwise(line)
    return F.split(trimmed, "\t", -1 if upto is None else upto + 1)


def int_or_null(c: Column | str) -> Column:
    """Text to 32-bit integer, cut towards zero; NULL where that is impossible."""
    c = _col(c)
    # A number as Spark itself writes it needs no pattern.
    text = c.cast("string")
    plain = text.try_cast("int")
    number = F.when(F.rlike(c, F.lit(_NUMBER)), c.try_cast("double"))
    # -2^31 stands for "missing" in the data model, so it is no value either.
    value = F.when(plain.cast("string") == text, plain).otherwise(number.try_cast("int"))
    return F.nullif(value, F.lit(-(2**31)))


def once(expr: Column) -> Column:
    """``expr`` as the only element of a generator, so that it is computed once.

    A filter on a column that holds an expression is moved in front of it, and each
    condition then works the expression out anew. Filters stay behind generators.
    """
    return F.explode(F.array(expr))
