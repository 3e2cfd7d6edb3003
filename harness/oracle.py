"""The same results in SQL, derived from the raw texts.

Nothing here goes through lattices: the rules of the stub annotator are applied to
the tokens of each text directly.
"""

from __future__ import annotations

SPACES = r"[ \t\n\x0b\f\r]+"

_WIRE = rf"""
wired AS (
  SELECT keys.*, text,
         array_to_string(list_filter(regexp_split_to_array(text, '{SPACES}'),
                                     lambda x: x <> ''), chr(10)) AS body
  FROM src keys
)"""

_LINES = r"""
wired AS (SELECT *, trim(text, chr(10)) AS body FROM src)"""

_TOKENS = r"""
sents AS (
  SELECT doc_id, doc_order, unnest(list) AS sent, generate_subscripts(list, 1) AS sentence_id,
         len(list) AS n_sents
  FROM (
    SELECT doc_id, doc_order,
           string_split(regexp_replace(body, '([.!?])\n', '\1' || chr(10) || chr(10), 'g'),
                        chr(10) || chr(10)) AS list
    FROM wired WHERE body <> ''
  )
),
toks AS (
  SELECT doc_id, doc_order, CAST(sentence_id AS INTEGER) AS sentence_id, n_sents,
         unnest(list) AS token, CAST(generate_subscripts(list, 1) AS INTEGER) AS token_id,
         len(list) AS n_toks
  FROM (SELECT *, string_split(sent, chr(10)) AS list FROM sents)
),
tagged AS (
  SELECT *, length(token) AS L,
         CASE WHEN length(token) % 11 = 10 THEN NULL ELSE
           list_extract(['NN', 'VB', 'JJ', 'DEF', 'NNT', 'yyDOT', 'IN'], length(token) % 7 + 1)
         END AS pos
  FROM toks
),
morphs AS (
  SELECT doc_id, doc_order, sentence_id, token_id, token,
         CASE WHEN L = 1 THEN '' ELSE lower(token) END AS lemma,
         pos, pos || 'X' AS xpos,
         CASE WHEN pos IS NULL THEN NULL WHEN L % 2 = 0 THEN 'gen=M|num=P' ELSE '_' END AS feats,
         L, n_toks, n_sents
  FROM tagged
),
md AS (
  SELECT *,
         CASE WHEN pos IS NULL OR L % 17 = 0 THEN NULL
              WHEN L % 13 = 0 THEN '_'
              WHEN L % 13 = 1 THEN token_id || '.7'
              ELSE CAST(token_id AS VARCHAR) END AS word_id
  FROM morphs
),
arcs AS (
  SELECT *, n_sents % 3 = 0 AND sentence_id = n_sents AS no_tree,
         n_toks - CAST(n_toks % 5 = 0 AS INTEGER) + CAST(n_toks % 7 = 0 AS INTEGER) AS n_tree
  FROM morphs
),
trees AS (
  SELECT *,
         CASE WHEN no_tree OR (n_toks % 5 = 0 AND n_toks % 7 <> 0 AND token_id = n_toks)
              THEN NULL
              WHEN n_toks % 5 = 0 AND n_toks % 7 = 0 AND token_id = n_toks THEN n_toks
              ELSE token_id - 1 END AS head_token_id,
         CASE WHEN no_tree OR (n_toks % 5 = 0 AND n_toks % 7 <> 0 AND token_id = n_toks)
              THEN NULL
              WHEN n_toks % 5 = 0 AND n_toks % 7 = 0 AND token_id = n_toks THEN 'punct'
              WHEN token_id = 1 THEN 'ROOT'
              ELSE list_extract(['subj', 'obj', 'mod'], L % 3 + 1) END AS deprel
  FROM arcs
)"""


def _with(src: str, *ctes: str, wire: str = _WIRE) -> str:
    return "WITH src AS (" + src + ")," + wire + "," + _TOKENS + "".join("," + c for c in ctes)


_DOCS_SRC = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, 0 AS doc_order, text FROM documents"
_TURNS_SRC = "SELECT CAST(conv_id AS VARCHAR) AS doc_id, turn AS doc_order, text FROM conversations"
_DOCS = _with(_DOCS_SRC)

_MORPH = "doc_id, sentence_id, token_id, token, lemma, pos, xpos, feats"
_STRIP = r"regexp_replace({}, '[\p{{P}}\p{{S}}]+$', '')"
_CONTENT = "pos IN ('NN', 'NNT', 'NNP', 'VB', 'JJ', 'RB')"
_STOPS = rf"""
stops AS (
  SELECT DISTINCT lower(word) AS word
  FROM (SELECT lang, source, unnest(regexp_split_to_array(text, '{SPACES}')) AS word
        FROM documents)
  WHERE lang = 'en' AND source = 'src0' AND length(word) BETWEEN 1 AND 3
)"""
_CLEAN = f"""
clean AS (
  SELECT doc_id, sentence_id, token_id, {_STRIP.format('lemma')} AS token
  FROM morphs WHERE {_CONTENT}
),
counted AS (
  SELECT doc_id, lower(token) AS feature, count(*) AS n
  FROM clean WHERE token <> '' GROUP BY ALL
)"""
_INDEXED = """
indexed AS (
  SELECT feature, row_number() OVER (ORDER BY substr(md5(feature), 1, 3), feature) - 1
         AS feature_index
         , n_documents
  FROM (SELECT feature, count(*) AS n_documents FROM counted GROUP BY feature)
)"""


def _lists(value: str, where: str, part: str = "0", keys: str = "doc_id") -> str:
    """Token lists as text: rows chosen by ``where``, empty tokens left out."""
    used = f"{value} <> ''"
    return f"""
      SELECT {keys}, CAST({part} AS INTEGER) AS part,
             CAST(count(*) FILTER ({used}) AS INTEGER) AS n_tokens,
             coalesce(string_agg({value}, ' ' ORDER BY sentence_id, token_id)
                      FILTER ({used}), '') AS tokens
      FROM morphs WHERE {where} GROUP BY ALL"""


def _report() -> str:
    return (
        _DOCS
        + """
      SELECT doc_id, sentence_id, n_toks AS n_md, n_dep, least(n_toks, n_dep) AS n_aligned,
             CASE WHEN n_dep = 0 THEN 'dep_missing' WHEN n_dep <> n_toks THEN 'length_differs'
                  ELSE 'ok' END AS status
      FROM (SELECT DISTINCT doc_id, sentence_id, CAST(n_toks AS BIGINT) AS n_toks,
                   CAST(CASE WHEN no_tree THEN 0 ELSE n_tree END AS BIGINT) AS n_dep
            FROM arcs)"""
    )


_NO_PUNCT = "coalesce(pos NOT LIKE 'yy%', true)"
_LEMMA_LISTS = _lists("lemma", "pos IN ('NN', 'JJ', 'yyDOT') AND " + _NO_PUNCT)
_DEP_SELECT = f"SELECT {_MORPH}, CAST(head_token_id AS INTEGER) AS head_token_id, deprel FROM trees"
_WITHOUT_STOPS = f"""{_DOCS}, {_STOPS}
      SELECT doc_id, sentence_id, token_id, token FROM morphs
      WHERE token <> '' AND lower(token) NOT IN (SELECT word FROM stops)"""
_CONTENT_COUNTS = f"""{_DOCS}, {_CLEAN}, {_STOPS}
      SELECT doc_id, feature, n FROM counted WHERE feature NOT IN (SELECT word FROM stops)"""

ORACLES = {
    "documents_mapped": """
      SELECT conv_id || ':' || turn AS doc_id, text FROM conversations""",
    "stored_responses": f"""{_DOCS},
      md_text AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY token_id) AS sent, sentence_id
        FROM (
          SELECT *, (token_id - 1) || chr(9) || token_id || chr(9) || token || chr(9) || lemma ||
                 CASE WHEN pos IS NULL THEN '' ELSE
                   chr(9) || pos || chr(9) || xpos || chr(9) || feats || chr(9) ||
                   coalesce(word_id, '') || CASE WHEN L % 19 = 0 THEN chr(9) || 'more' ELSE '' END
                 END AS line
          FROM md)
        GROUP BY doc_id, sentence_id
      ),
      dep_text AS (
        SELECT doc_id, sentence_id,
               string_agg(line, chr(10) ORDER BY i) AS sent
        FROM (
          SELECT doc_id, sentence_id, token_id AS i,
                 token_id || chr(9) || token || chr(9) || token || chr(9) || '_' || chr(9) || '_'
                 || chr(9) || '_' || chr(9) || (token_id - 1) || chr(9) ||
                 CASE WHEN token_id = 1 THEN 'ROOT'
                      ELSE list_extract(['subj', 'obj', 'mod'], L % 3 + 1) END AS line
          FROM arcs WHERE NOT no_tree AND NOT (n_toks % 5 = 0 AND token_id = n_toks)
          UNION ALL
          SELECT DISTINCT doc_id, sentence_id, n_toks + 1,
                 (n_toks + 1) || chr(9) || '*' || chr(9) || '*' || chr(9) || '_' || chr(9) || '_'
                 || chr(9) || '_' || chr(9) || n_toks || chr(9) || 'punct'
          FROM arcs WHERE NOT no_tree AND n_toks % 7 = 0)
        GROUP BY doc_id, sentence_id
      ),
      md_doc AS (SELECT doc_id, string_agg(sent, chr(10) || chr(10) ORDER BY sentence_id)
                        || chr(10) || chr(10) AS t FROM md_text GROUP BY doc_id),
      dep_doc AS (SELECT doc_id, string_agg(sent, chr(10) || chr(10) ORDER BY sentence_id)
                         || chr(10) || chr(10) AS t FROM dep_text GROUP BY doc_id)
      SELECT w.doc_id,
             CASE WHEN body <> '' THEN
               '0' || chr(9) || '1' || chr(9) ||
               replace(body, chr(10), chr(10) || '0' || chr(9) || '1' || chr(9)) END AS ma_lattice,
             md_doc.t AS md_lattice,
             CASE WHEN body <> '' THEN coalesce(dep_doc.t, chr(10) || chr(10)) END AS dep_tree,
             CASE WHEN body <> '' THEN replace(body, chr(10), ' ') END AS segmented_text
      FROM wired w LEFT JOIN md_doc ON w.doc_id = md_doc.doc_id
           LEFT JOIN dep_doc ON w.doc_id = dep_doc.doc_id""",
    "stopword_list": f"WITH {_STOPS} SELECT word FROM stops",
    "pretokenized_parse": _with(_DOCS_SRC, wire=_LINES) + f" SELECT {_MORPH} FROM morphs",
    "annotate_pretokenized": _with(_DOCS_SRC, wire=_LINES) + f" SELECT {_MORPH} FROM morphs",
    "malformed_bodies": """
      SELECT CAST(doc_id AS VARCHAR) AS doc_id,
             CAST(CASE WHEN doc_id % 7 = 0 THEN length(text) END AS INTEGER) AS n_chars,
             CASE WHEN doc_id % 7 IN (1, 2, 4, 5)
                  THEN 'malformed response of document ' || doc_id END AS error
      FROM documents""",
    "wire_text": _DOCS + " SELECT doc_id, body || chr(10) || chr(10) AS wire FROM wired",
    "annotate_python": _DOCS + f" SELECT {_MORPH} FROM morphs",
    "annotate_keep_errors": _DOCS
    + """
      SELECT doc_id,
             CAST(CASE WHEN length(body) + 2 <= 2000 AND (length(body) + 2) % 7 <> 0
                        AND body <> '' THEN length(body) END AS INTEGER) AS n_chars,
             CASE WHEN length(body) + 2 > 2000 THEN 'ValueError: too long'
                  WHEN (length(body) + 2) % 7 = 0 THEN 'TypeError: answer of type int'
             END AS error
      FROM wired""",
    "annotate_deadline": _DOCS
    + """
      SELECT doc_id,
             CAST(CASE WHEN (length(body) + 2) % 397 <> 0 AND body <> '' THEN length(body)
                  END AS INTEGER) AS n_chars,
             CASE WHEN (length(body) + 2) % 397 = 0 THEN 'TimeoutError: no answer within 10 s'
             END AS error
      FROM wired""",
    "explode_md": _DOCS
    + """
      SELECT doc_id, sentence_id, CAST(token_id - 1 AS VARCHAR) AS "from",
             CAST(token_id AS VARCHAR) AS "to", token, lemma, pos AS cpostag, xpos AS postag,
             feats, word_id AS token_id, token_id AS position
      FROM md""",
    "explode_dep": _DOCS
    + """,
      rows_ AS (
        SELECT doc_id, sentence_id, token_id AS position, token, token_id - 1 AS head,
               CASE WHEN token_id = 1 THEN 'ROOT'
                    ELSE list_extract(['subj', 'obj', 'mod'], L % 3 + 1) END AS deprel,
               token_id AS id
        FROM arcs WHERE NOT no_tree AND NOT (n_toks % 5 = 0 AND token_id = n_toks)
        UNION ALL
        SELECT DISTINCT doc_id, sentence_id, n_tree, '*', n_toks, 'punct', n_toks + 1
        FROM arcs WHERE NOT no_tree AND n_toks % 7 = 0
      )
      SELECT doc_id, sentence_id, CAST(id AS VARCHAR) AS id, token, token AS lemma,
             '_' AS cpostag, '_' AS postag, '_' AS feats, CAST(head AS VARCHAR) AS head, deprel,
             CAST(position AS INTEGER) AS position
      FROM rows_""",
    "explode_md_pieces": _DOCS
    + """
      SELECT doc_id, sentence_id, CAST(token_id - 1 AS VARCHAR) AS "from",
             CAST(token_id AS VARCHAR) AS "to", token, lemma, pos AS cpostag, xpos AS postag,
             feats, word_id AS token_id, token_id AS position
      FROM md""",
    "explode_dep_pieces": _DOCS
    + """,
      rows_ AS (
        SELECT doc_id, sentence_id, token_id AS position, token, token_id - 1 AS head,
               CASE WHEN token_id = 1 THEN 'ROOT'
                    ELSE list_extract(['subj', 'obj', 'mod'], L % 3 + 1) END AS deprel,
               token_id AS id
        FROM arcs WHERE NOT no_tree AND NOT (n_toks % 5 = 0 AND token_id = n_toks)
        UNION ALL
        SELECT DISTINCT doc_id, sentence_id, n_tree, '*', n_toks, 'punct', n_toks + 1
        FROM arcs WHERE NOT no_tree AND n_toks % 7 = 0
      )
      SELECT doc_id, sentence_id, CAST(id AS VARCHAR) AS id, token, token AS lemma,
             '_' AS cpostag, '_' AS postag, '_' AS feats, CAST(head AS VARCHAR) AS head, deprel,
             CAST(position AS INTEGER) AS position
      FROM rows_""",
    "coerce_int": _DOCS
    + """
      SELECT doc_id, sentence_id, token_id AS position, token_id - 1 AS "from", token_id AS "to",
             CASE WHEN word_id <> '_' THEN token_id END AS token_id
      FROM md""",
    "token_id_window": _DOCS
    + """
      SELECT doc_id, sentence_id, -token_id AS place, token,
             CAST(row_number() OVER (PARTITION BY doc_id, sentence_id ORDER BY -token_id)
                  AS INTEGER) AS token_id
      FROM morphs""",
    "token_id_sparse": _DOCS
    + """
      SELECT doc_id, sentence_id, CAST(token_id AS BIGINT) * -7000000011 AS place, token,
             CAST(row_number() OVER (PARTITION BY doc_id, sentence_id ORDER BY -token_id)
                  AS INTEGER) AS token_id
      FROM morphs""",
    "parse_morphemes": _DOCS + f" SELECT {_MORPH} FROM morphs",
    "parse_dependencies": _DOCS + _DEP_SELECT,
    "parse_repeated_ids": _with(_TURNS_SRC) + f" SELECT doc_order, {_MORPH} FROM morphs",
    "attach_dependencies": _DOCS + _DEP_SELECT,
    "attach_dependencies_stored": _DOCS + _DEP_SELECT,
    "alignment_report": _report(),
    "alignment_report_stored": _report(),
    "response_alignment": _report(),
    "drop_empty_documents": r"""
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n_rows
      FROM documents WHERE regexp_matches(text, '[0-9]')""",
    "union_batches": _with(
        """SELECT 'b' || item_id AS doc_id, 0 AS doc_order, text FROM benchmark
           UNION ALL SELECT conv_id || ':' || turn, 0, text FROM conversations"""
    )
    + f" SELECT {_MORPH} FROM morphs",
    "ambiguous_lattices": _DOCS
    + """
      SELECT doc_id, '0' || chr(9) || '1' || chr(9) ||
             replace(body, chr(10), chr(10) || '0' || chr(9) || '1' || chr(9)) AS ma_lattice
      FROM wired WHERE body <> ''""",
    "parse_keep_lattice": _DOCS
    + """
      SELECT doc_id, count(*) AS n_morphemes,
             any_value(len(string_split(body, chr(10)))) AS n_edges
      FROM morphs JOIN wired USING (doc_id) GROUP BY doc_id""",
    "remove_punct": _DOCS + f" SELECT {_MORPH} FROM morphs WHERE {_NO_PUNCT}",
    "keep_pos": _DOCS + f" SELECT {_MORPH} FROM morphs WHERE pos IN ('NN', 'VB')",
    "token_rows": _DOCS
    + f""" SELECT doc_id, sentence_id, token_id, lemma AS token
           FROM morphs WHERE {_NO_PUNCT} AND lemma <> ''""",
    "tokens_surface": _DOCS + _lists("token", "true"),
    "tokens_lemma": _DOCS + _LEMMA_LISTS,
    "tokens_in_parts": _DOCS + _lists("lemma", "true", part="(sentence_id - 1) // 20"),
    "tokens_repeated_ids": _with(_TURNS_SRC) + _lists("token", "true", keys="doc_id, doc_order"),
    "tokens_from_lattices": _DOCS + _LEMMA_LISTS,
    "relation_filter": _DOCS
    + " SELECT doc_id, sentence_id, token, lemma FROM trees WHERE deprel = 'subj'",
    "first_n": _DOCS
    + f" SELECT {_MORPH} FROM morphs ORDER BY doc_id, sentence_id, token_id LIMIT 15",
    "parse_summary": _DOCS
    + " SELECT count(*) AS n_morphemes, count(DISTINCT doc_id) AS n_documents FROM morphs",
    "doc_count": _DOCS
    + " SELECT count(DISTINCT doc_id) AS n_documents FROM morphs WHERE pos = 'NNT'",
    "doc_names": _DOCS + " SELECT DISTINCT doc_id FROM morphs WHERE pos = 'NNT'",
    "strip_punct": _DOCS
    + f""" SELECT * FROM (
             SELECT doc_id, sentence_id, token_id, {_STRIP.format('token')} AS token,
                    {_STRIP.format('lemma')} AS lemma, pos, xpos, feats FROM morphs)
           WHERE lemma <> ''""",
    "stopword_removal": _WITHOUT_STOPS,
    "stopword_removal_large": _WITHOUT_STOPS,
    "dfm_content_lemma": _CONTENT_COUNTS,
    "dfm_stopword_table": _CONTENT_COUNTS,
    "dfm_bare_lemma": f"""{_DOCS}
      SELECT doc_id, lower(lemma) AS feature, count(*) AS n FROM morphs
      WHERE {_NO_PUNCT} AND lemma <> '' GROUP BY ALL""",
    "dfm_options": f"""{_DOCS}
      SELECT doc_id, lower(lemma) AS feature, count(*) AS n FROM morphs
      WHERE pos IN ('NN', 'VB', 'yyDOT') AND lemma <> '' GROUP BY ALL""",
    "dfm_from_tokens": f"""{_DOCS}
      SELECT doc_id, lower(token) AS feature, count(*) AS n FROM morphs
      WHERE {_NO_PUNCT} GROUP BY ALL""",
    "dfm_documents": f"""{_DOCS}
      SELECT DISTINCT doc_id FROM morphs
      WHERE pos = 'VB' AND {_STRIP.format('lemma')} <> ''""",
    "featnames": f"{_DOCS}, {_CLEAN} SELECT DISTINCT feature FROM counted",
    "featnames_direct": f"{_DOCS}, {_CLEAN} SELECT DISTINCT feature FROM counted",
    "topfeatures": f"""{_DOCS}, {_CLEAN}
      SELECT feature, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY feature
      ORDER BY 2 DESC, 1 LIMIT 25""",
    "topfeatures_direct": f"""{_DOCS}, {_CLEAN}, {_STOPS}
      SELECT feature, CAST(sum(n) AS BIGINT) AS n FROM counted
      WHERE feature NOT IN (SELECT word FROM stops) GROUP BY feature
      ORDER BY 2 DESC, 1 LIMIT 25""",
    "topfeatures_bounded": f"""{_DOCS}, {_CLEAN}, {_STOPS}
      SELECT feature, CAST(sum(n) AS BIGINT) AS n FROM counted
      WHERE feature NOT IN (SELECT word FROM stops) GROUP BY feature
      ORDER BY 2 DESC, 1 LIMIT 25""",
    "feature_index": f"{_DOCS}, {_CLEAN}, {_INDEXED} SELECT * FROM indexed",
    "dfm_vectors": f"""{_DOCS}, {_CLEAN}, {_INDEXED},
      vectors AS (
        SELECT doc_id, feature_index // 10000 AS block,
               string_agg(CAST(feature_index AS VARCHAR), ' ' ORDER BY feature_index) AS indices,
               string_agg(CAST(n AS VARCHAR), ' ' ORDER BY feature_index) AS values_
        FROM counted JOIN indexed USING (feature) GROUP BY ALL
      )
      SELECT d.doc_id, CAST(coalesce(block, 0) AS INTEGER) AS block,
             coalesce(indices, '') AS indices, coalesce(values_, '') AS "values"
      FROM (SELECT DISTINCT doc_id FROM clean WHERE token <> '') d
           LEFT JOIN vectors USING (doc_id)""",
    "dfm_vectors_whole": f"""{_DOCS}, {_CLEAN}, {_INDEXED},
      vectors AS (
        SELECT doc_id, 0 AS block,
               string_agg(CAST(feature_index AS VARCHAR), ' ' ORDER BY feature_index) AS indices,
               string_agg(CAST(n AS VARCHAR), ' ' ORDER BY feature_index) AS values_
        FROM counted JOIN indexed USING (feature) GROUP BY ALL
      )
      SELECT d.doc_id, CAST(coalesce(block, 0) AS INTEGER) AS block,
             coalesce(indices, '') AS indices, coalesce(values_, '') AS "values"
      FROM (SELECT DISTINCT doc_id FROM clean WHERE token <> '') d
           LEFT JOIN vectors USING (doc_id)""",
}
