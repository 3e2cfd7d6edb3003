"""A stand-in for a morphological annotator, with rules simple enough for SQL.

Like the real thing it maps wire text to response JSON. Sentences also end after a
token that ends in ``.``, ``!`` or ``?``. Every token is one morpheme; its tags and
the irregularities of its line follow from its length L and its place i:

- lemma: lower case, or empty for L = 1
- tag: TAGS[L % 7]; fine tag: the same plus ``X``; feats: by L % 2
- L % 11 = 10: the line ends after the lemma
- last field: empty for L % 17 = 0, ``_`` for L % 13 = 0, ``i.7`` for L % 13 = 1,
  else i; then for L % 19 = 0 one field too many

Dependencies of a sentence of n tokens: head i-1, relation by L % 3; the last row is
missing for n % 5 = 0; one row too many for n % 7 = 0; the last sentence is missing
if their number is a multiple of 3. Blank text is answered with ``{}``.

Annotating runs in Python workers, and most of the time of every query that starts from
stored responses is spent here. So a document is put together column by column, in lists that
are filled and joined as wholes, of parts that stand in the JSON as they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from morphloom.operators import annotate

TAGS = ("NN", "VB", "JJ", "DEF", "NNT", "yyDOT", "IN")
RELATIONS = ("subj", "obj", "mod")

# Tab and line break as they stand in a JSON string.
_TAB, _LINE = r"\t", r"\n"
# What a JSON string escapes, except the line break.
_ESCAPED = re.compile(r'["\\\x00-\x09\x0b-\x1f]')
_LONGEST_KNOWN = 1000


def stub_annotated(docs: DataFrame, pre_tokenized: bool = False) -> DataFrame:
    """``doc_id, response`` of the annotator below."""
    return annotate(docs, make_annotator, pre_tokenized)


class _ByLength(dict):
    """What a rule gives for a token's length, worked out when it is first asked for."""

    def __init__(self, rule: Callable[[int], str]):
        self.rule = rule

    def __missing__(self, n: int) -> str:
        found = self.rule(n)
        if n <= _LONGEST_KNOWN:
            self[n] = found
        return found


def _tags(n: int) -> str:
    """What stands between the lemma and the last field."""
    if n % 11 == 10:
        return ""
    pos = TAGS[n % 7]
    return f"{_TAB}{pos}{_TAB}{pos}X{_TAB}{'_' if n % 2 else 'gen=M|num=P'}{_TAB}"


def _has_place(n: int) -> bool:
    return n % 11 != 10 and n % 17 != 0 and n % 13 != 0


def _end(n: int) -> str:
    """What follows the place in the last field, or stands there instead of it."""
    if n % 11 == 10:
        return ""
    last = "" if n % 17 == 0 else "_" if n % 13 == 0 else ".7" if n % 13 == 1 else ""
    return last if n % 19 else f"{last}{_TAB}more"


def _escaped(text: str) -> str:
    """``text`` as in a JSON string, but for its line breaks."""
    return _ESCAPED.sub(lambda found: json.dumps(found[0])[1:-1], text)


def _words(text: str) -> list[str]:
    return (re.sub("\n\n+", "\n", text) if "\n\n" in text else text).split("\n")


def _joined(*columns: Sequence[str] | str) -> str:
    """The texts of columns, row by row, without the blank line in front, closed by one. A
    column of one text has it in every row."""
    rows, width = len(columns[0]), len(columns)
    cells = [""] * (width * rows)
    for i, column in enumerate(columns):
        cells[i::width] = [column] * rows if isinstance(column, str) else column
    return "".join(cells)[2 * len(_LINE) :] + 2 * _LINE


def make_annotator():
    """A function from wire text to response JSON."""

    # By place, 0, 1, 2 and so on: the place, the beginnings of lattice and tree lines, and
    # what stands before the relation. A sentence's first line has a blank line before it.
    places: list[str] = []
    edges: list[str] = []
    numbers: list[str] = []
    heads: list[str] = []
    tags, has_place, end = map(_ByLength, (_tags, _has_place, _end))
    relation = _ByLength(lambda n: _TAB + RELATIONS[n % 3])

    def annotate(wire: str) -> str:
        body = wire.strip("\n")
        if not body:
            return "{}"
        sents = re.split("\n\n+", re.sub(r"([.!?])\n", r"\1\n\n", body))
        counts = [sentence.count("\n") + 1 for sentence in sents]
        trees = len(counts) - (len(counts) % 3 == 0)
        for i in range(len(places), max(counts) + 1):
            places.append(str(i))
            lines = _LINE if i else 2 * _LINE
            edges.append(f"{lines}{i}{_TAB}{i + 1}{_TAB}")
            numbers.append(f"{lines}{i + 1}{_TAB}")
            heads.append(f"{_TAB}_{_TAB}_{_TAB}_{_TAB}{i}")

        text = _escaped(body)
        words = _words(text)
        sizes = [*map(len, words if text == body else _words(body))]
        lemmas = _words(_escaped(body.lower()))
        if 1 in sizes:
            lemmas = ["" if n == 1 else lemma for n, lemma in zip(sizes, lemmas)]
        relations = [*map(relation.__getitem__, sizes)]

        md_edges, md_places, start = [], [], 0
        dep_numbers, dep_words, dep_heads, dep_relations = [], [], [], []
        for k, n in enumerate(counts):
            md_edges += edges[:n]
            md_places += places[1 : n + 1]
            if k < trees:
                n_tree = n - (n % 5 == 0)
                dep_numbers += numbers[:n_tree]
                dep_words += words[start : start + n_tree]
                dep_heads += heads[:n_tree]
                dep_relations.append(_TAB + "ROOT")
                dep_relations += relations[start + 1 : start + n_tree]
                if n % 7 == 0:
                    dep_numbers.append(numbers[n])
                    dep_words.append("*")
                    dep_heads.append(heads[n])
                    dep_relations.append(_TAB + "punct")
            start += n
        placed = map(has_place.__getitem__, sizes)
        md_places = [place if p else "" for p, place in zip(placed, md_places)]
        md_tags, ends = [*map(tags.__getitem__, sizes)], [*map(end.__getitem__, sizes)]
        md = _joined(md_edges, words, _TAB, lemmas, md_tags, md_places, ends)
        dep = _joined(dep_numbers, dep_words, _TAB, dep_words, dep_heads, dep_relations)
        edge = f"0{_TAB}1{_TAB}"
        ma = edge + text.replace("\n", _LINE + edge)
        return (
            f'{{"ma_lattice": "{ma}", "md_lattice": "{md}", "dep_tree": "{dep}", '
            f'"segmented_text": "{text.replace(chr(10), " ")}"}}'
        )

    return annotate
