"""DataFrame operators of the morpheme model."""

from morphloom.operators.annotation import annotate, decode_responses, wire_text
from morphloom.operators.features import (
    content_tokens,
    dfm,
    dfm_documents,
    dfm_vectors,
    drop_emptied,
    featnames,
    feature_index,
    parsed_to_dfm,
    remove_stopwords,
    strip_trailing_punct,
    topfeatures,
)
from morphloom.operators.lattices import (
    alignment_report,
    ambiguous_lattices,
    attach_dependencies,
    coerce_int,
    content_morphemes,
    cut_lattices,
    explode_dep,
    explode_md,
    morpheme_table,
    morphemes,
    response_alignment,
    with_token_id,
)
from morphloom.operators.layout import store_by_sentence
from morphloom.operators.tokens import (
    as_tokens,
    doc_count,
    doc_names,
    drop_empty_tokens,
    first_n,
    keep_pos,
    lattice_tokens,
    relation_filter,
    remove_punct,
    summary,
    to_tokens,
    token_rows,
)

__all__ = [
    "alignment_report",
    "ambiguous_lattices",
    "annotate",
    "as_tokens",
    "attach_dependencies",
    "coerce_int",
    "content_morphemes",
    "content_tokens",
    "cut_lattices",
    "decode_responses",
    "dfm",
    "dfm_documents",
    "dfm_vectors",
    "doc_count",
    "doc_names",
    "drop_emptied",
    "drop_empty_tokens",
    "explode_dep",
    "explode_md",
    "featnames",
    "feature_index",
    "first_n",
    "keep_pos",
    "lattice_tokens",
    "morpheme_table",
    "morphemes",
    "parsed_to_dfm",
    "relation_filter",
    "remove_punct",
    "remove_stopwords",
    "response_alignment",
    "store_by_sentence",
    "strip_trailing_punct",
    "summary",
    "to_tokens",
    "token_rows",
    "topfeatures",
    "wire_text",
    "with_token_id",
]
