"""Lattice texts, written as rows of fields."""


def lattice(*sentences):
    return "\n\n".join("\n".join("\t".join(row.split(" ")) for row in s) for s in sentences)


COOKS = (
    "0 1 h h DEF DEF _ 1",
    "1 2 Tbxym Tbx NN NN gen=M|num=P 1",
    "2 3 bSlw bSl VB VB gen=M|num=P|tense=PAST 2",
    "3 4 mrq mrq NN NN _ 3",
    "4 5 yrqwt yrq NN NN _ 4",
    "5 6 . yyDOT yyDOT yyDOT _ 5",
)
SEA = (
    "0 1 ym ym NN NN _ 1",
    "1 2 gdwl gdwl JJ JJ _ 2",
    "2 3 . yyDOT yyDOT yyDOT _ 3",
)
COOKS_TREE = (
    "1 h h DEF DEF _ 2 def",
    "2 Tbxym Tbx NN NN gen=M|num=P 3 subj",
    "3 bSlw bSl VB VB gen=M|num=P|tense=PAST 0 ROOT",
    "4 mrq mrq NN NN _ 3 obj",
    "5 yrqwt yrq NN NN _ 4 compound",
    "6 . yyDOT yyDOT yyDOT yyDOT 3 punct",
)

MORPHEME_DDL = (
    "doc_id string, sentence_id int, token_id int, token string, lemma string, "
    "pos string, xpos string, feats string"
)


def morpheme_table(spark, rows):
    """``(doc_id, sentence_id, token_id, token, lemma, pos)`` rows as a morpheme table."""
    return spark.createDataFrame([(*r, r[5], "_") for r in rows], MORPHEME_DDL)


def tagged(spark, **docs):
    """``a=[("word", "NN"), ...]``: one sentence per document, lemma = token."""
    return morpheme_table(
        spark,
        [
            (doc, 1, i + 1, word, word, pos)
            for doc, words in docs.items()
            for i, (word, pos) in enumerate(words)
        ],
    )


def lists(tokens):
    """Token lists by document, their parts joined in order."""
    out = {}
    for row in sorted(tokens.collect(), key=lambda r: (r.doc_id, r.part)):
        out.setdefault(row.doc_id, []).extend(row.tokens)
    return out
