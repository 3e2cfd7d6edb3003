"""One query per operator, over the given tables."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import morphloom as m
from harness import stub
from harness.stub import make_annotator, stub_annotated
from morphloom.operators.checkpoints import checkpoint_folder
from morphloom.operators.features import FEATURE_BUCKETS

# Workers need not have this folder on their path: the annotator travels with the job.
cloudpickle.register_pickle_by_value(stub)

DOC_FIELDS = ("md_lattice", "dep_tree", "ma_lattice", "segmented_text")


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def docs(spark, sf):
    return m.spread_small(m.documents(_read(spark, sf, "documents")))


def turns(spark, sf):
    """Turns of conversations as documents that share the conversation's id."""
    return m.spread_small(
        m.documents(_read(spark, sf, "conversations"), "conv_id", "text", order_col="turn")
    )


def stored(spark, sf):
    return stub_annotated(docs(spark, sf))


def decoded(spark, sf, *fields):
    return m.decode_responses(stored(spark, sf), fields=fields or ("md_lattice",))


def parsed(spark, sf):
    return m.parse(stored(spark, sf))


def parsed_dep(spark, sf):
    return m.parse_dependencies(stored(spark, sf))


def listed(tokens: DataFrame) -> DataFrame:
    """Token lists as text, which every engine compares alike."""
    keys = [c for c in tokens.columns if c != "tokens"]
    return tokens.select(
        *keys, F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def word_table(spark, sf):
    """Stopword lists derived from the texts: per language and source, the tokens of
    at most three characters."""
    src = _read(spark, sf, "documents")
    words = m.spread_small(src.select("lang", "source", "text")).select(
        "lang", "source", F.explode(F.split("text", r"\s+")).alias("word")
    )
    return words.where("char_length(word) BETWEEN 1 AND 3").distinct()


def stoplist(spark, sf):
    """Checkpointed, since its size is measured before it is used."""
    return m.materialize(m.stopwords(word_table(spark, sf), "en", "src0"))


# --- sources -------------------------------------------------------------------


def documents_mapped(spark, sf):
    src = _read(spark, sf, "conversations").withColumn(
        "key", F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    )
    return m.documents(src, "key", "text")


def stored_responses(spark, sf):
    src = stored(spark, sf).select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("response").alias("body")
    )
    return m.decode_responses(m.responses(src, "id", "body"), fields=DOC_FIELDS)


def stopword_list(spark, sf):
    return m.stopwords(word_table(spark, sf), "en", "src0")


def pretokenized_parse(spark, sf):
    """The lines of a text as its tokens, as a user would hand them over."""
    src = docs(spark, sf).withColumn("text", F.concat("text", F.lit("\n\n")))
    return m.parse(stub_annotated(src, pre_tokenized=True))


def annotate_pretokenized(spark, sf):
    src = docs(spark, sf).withColumn("text", F.concat("text", F.lit("\n\n")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return m.parse(src, make_annotator, pre_tokenized=True, partitions=tasks)


def malformed_bodies(spark, sf):
    """Stored bodies of seven kinds by id, among them two objects in one, text behind the
    object, fields that are no text, and answers without content."""
    good = F.to_json(F.struct(F.col("text").alias("segmented_text")))
    kind = F.pmod(F.col("doc_id"), F.lit(7))
    body = (
        F.when(kind == 1, F.concat(good, F.lit(" tail")))
        .when(kind == 2, F.concat(good, good))
        .when(kind == 3, F.lit("[]\n"))
        .when(kind == 4, F.to_json(F.struct(F.struct("text").alias("segmented_text"))))
        .when(kind == 5, F.to_json(F.struct(F.col("doc_id").alias("segmented_text"))))
        .when(kind == 6, F.lit("null\n"))
        .otherwise(good)
    )
    src = _read(spark, sf, "documents").select("doc_id", body.alias("body"))
    out = m.decode_responses(m.responses(src, "doc_id", "body"), "keep", ("segmented_text",))
    return out.select("doc_id", F.length("segmented_text").alias("n_chars"), "error")


# --- annotation ----------------------------------------------------------------


def wire_text(spark, sf):
    return m.wire_text(docs(spark, sf))


def annotate_python(spark, sf):
    return m.parse(docs(spark, sf), make_annotator)


def annotate_keep_errors(spark, sf):
    """An annotator that fails on wire text of more than 2,000 characters and gives a
    number instead of JSON where the length is a multiple of seven."""

    def factory():
        annotator = make_annotator()

        def limited(wire):
            if len(wire) > 2000:
                raise ValueError("too long")
            return len(wire) if len(wire) % 7 == 0 else annotator(wire)

        return limited

    out = m.decode_responses(
        m.annotate(docs(spark, sf), factory, on_error="keep"), "keep", ("segmented_text",)
    )
    return out.select("doc_id", F.length("segmented_text").alias("n_chars"), "error")


def annotate_deadline(spark, sf):
    """An annotator that is slow now and then and hangs on wire text whose length is a
    multiple of 397: eight calls at once, ten seconds each."""

    def factory():
        import time

        annotator = make_annotator()

        def slow(wire):
            if len(wire) % 397 == 0:
                time.sleep(3600)
            if len(wire) % 23 == 0:
                time.sleep(0.01)
            return annotator(wire)

        return slow

    src = m.annotate(docs(spark, sf), factory, on_error="keep", in_flight=8, deadline=10.0)
    out = m.decode_responses(src, "keep", ("segmented_text",))
    return out.select("doc_id", F.length("segmented_text").alias("n_chars"), "error")


# --- morpheme table ------------------------------------------------------------


def explode_md(spark, sf):
    return m.explode_md(decoded(spark, sf))


def explode_dep(spark, sf):
    return m.explode_dep(decoded(spark, sf, "dep_tree"))


def explode_md_pieces(spark, sf):
    """Lattices cut at the first sentence border behind every 400 bytes, and the
    pieces dealt out over the tasks."""
    pieces = m.cut_lattices(decoded(spark, sf), bytes_per_piece=400)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return m.explode_md(pieces.repartition(tasks, "doc_id", "sentence_offset"))


def explode_dep_pieces(spark, sf):
    trees = decoded(spark, sf, "dep_tree")
    return m.explode_dep(m.cut_lattices(trees, "dep_tree", bytes_per_piece=400))


def coerce_int(spark, sf):
    md = m.coerce_int(explode_md(spark, sf), ["from", "to", "token_id", "absent"])
    return md.select("doc_id", "sentence_id", "position", "from", "to", "token_id")


def token_id_window(spark, sf):
    """Numbers the words of a document from the end, in blocks of 50 rows."""
    md = explode_md(spark, sf).select(
        "doc_id", "sentence_id", (-F.col("position")).alias("place"), "token"
    )
    return m.with_token_id(md, "place", rows_per_block=50)


def token_id_sparse(spark, sf):
    """Numbers the words of a document from the end by an order of far-off values, as
    times would be: seven thousand million apart, on several levels of blocks."""
    md = explode_md(spark, sf).select(
        "doc_id",
        "sentence_id",
        (F.col("position").cast("bigint") * -7_000_000_011).alias("place"),
        "token",
    )
    return m.with_token_id(md, "place", rows_per_block=1000)


def parse_morphemes(spark, sf):
    return parsed(spark, sf)


def parse_dependencies(spark, sf):
    return parsed_dep(spark, sf)


def parse_repeated_ids(spark, sf):
    return m.parse(stub_annotated(turns(spark, sf)))


def attach_dependencies(spark, sf):
    both = decoded(spark, sf, "md_lattice", "dep_tree")
    return m.morpheme_table(m.attach_dependencies(m.explode_md(both), m.explode_dep(both)))


def alignment_report(spark, sf):
    both = decoded(spark, sf, "md_lattice", "dep_tree")
    return m.alignment_report(m.explode_md(both), m.explode_dep(both))


def co_locating(spark: SparkSession) -> SparkSession:
    """A session like the given one that joins tables by more keys than those they lie by
    without a shuffle."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return session


def stored_apart(spark, sf):
    """Lattices and trees as two bucketed tables, as two jobs would have left them, read by a
    job of its own."""
    lattices, trees = decoded(spark, sf, "md_lattice"), decoded(spark, sf, "dep_tree")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables, reader = [], co_locating(spark)
    for kind, rows in (("lattices", m.explode_md(lattices)), ("trees", m.explode_dep(trees))):
        name = f"{kind}_{uuid.uuid4().hex}"
        path = f"{checkpoint_folder(spark)}/{name}"
        m.store_by_sentence(rows, name, buckets, path)
        tables.append(reader.table(name))
    return tables


def attach_dependencies_stored(spark, sf):
    return m.morpheme_table(m.attach_dependencies(*stored_apart(spark, sf), co_located=True))


def alignment_report_stored(spark, sf):
    return m.alignment_report(*stored_apart(spark, sf))


def response_alignment(spark, sf):
    return m.response_alignment(decoded(spark, sf, "md_lattice", "dep_tree"))


def drop_empty_documents(spark, sf):
    """Documents that still have rows when each text is cut down to its digits."""
    src = docs(spark, sf).withColumn("text", F.regexp_replace("text", "[^0-9]+", " "))
    return m.parse(stub_annotated(src)).groupBy("doc_id").agg(F.count("*").alias("n_rows"))


def union_batches(spark, sf):
    """Two collections parsed apart and put together."""
    bench = m.documents(
        _read(spark, sf, "benchmark").withColumn(
            "key", F.concat(F.lit("b"), F.col("item_id").cast("string"))
        ),
        "key",
        "text",
    )
    mapped = m.spread_small(documents_mapped(spark, sf))
    return m.parse(stub_annotated(bench)).unionByName(m.parse(stub_annotated(mapped)))


def ambiguous_lattices(spark, sf):
    return m.ambiguous_lattices(decoded(spark, sf, "md_lattice", "ma_lattice"))


def parse_keep_lattice(spark, sf):
    """Both results of one call, the second as its number of lines per document."""
    table, lattices = m.parse(docs(spark, sf), make_annotator, keep_lattice=True)
    rows = table.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_morphemes"))
    lines = F.size(F.split("ma_lattice", "\n")).cast("bigint").alias("n_edges")
    return rows.join(lattices.select("doc_id", lines), "doc_id")


# --- queries on the morpheme table -----------------------------------------------


def remove_punct(spark, sf):
    return m.remove_punct(parsed(spark, sf))


def keep_pos(spark, sf):
    return m.keep_pos(parsed(spark, sf), ["NN", "VB"])


def token_rows(spark, sf):
    return m.token_rows(parsed(spark, sf), use_lemma=True, remove_punct=True)


def tokens_surface(spark, sf):
    return listed(m.as_tokens(parsed(spark, sf)))


def tokens_lemma(spark, sf):
    return listed(m.to_tokens(parsed(spark, sf), pos_keep=["NN", "JJ", "yyDOT"]))


def tokens_in_parts(spark, sf):
    return listed(m.as_tokens(parsed(spark, sf), use_lemma=True, sentences_per_part=20))


def tokens_repeated_ids(spark, sf):
    return listed(m.as_tokens(parse_repeated_ids(spark, sf)))


def tokens_from_lattices(spark, sf):
    return listed(
        m.lattice_tokens(
            decoded(spark, sf), use_lemma=True, remove_punct=True, pos_keep=["NN", "JJ", "yyDOT"]
        )
    )


def relation_filter(spark, sf):
    return m.relation_filter(
        parsed_dep(spark, sf), "subj", ["doc_id", "sentence_id", "token", "lemma"]
    )


def first_n(spark, sf):
    return m.first_n(parsed(spark, sf), 15)


def parse_summary(spark, sf):
    return m.summary(parsed(spark, sf))


def doc_count(spark, sf):
    return m.doc_count(m.as_tokens(parsed(spark, sf), pos_keep=["NNT"]))


def doc_names(spark, sf):
    return m.doc_names(m.as_tokens(parsed(spark, sf), pos_keep=["NNT"]))


# --- document-feature analytics ----------------------------------------------------


def strip_punct(spark, sf):
    return m.drop_emptied(m.strip_trailing_punct(parsed(spark, sf)), "lemma")


def stopword_removal(spark, sf):
    return m.remove_stopwords(
        m.token_rows(parsed(spark, sf)), stoplist(spark, sf)
    )


def stopword_removal_large(spark, sf):
    """As for a list that is too large to broadcast. The tokens are then read twice, so they
    are stored first and no document is annotated again."""
    tokens = m.store(m.token_rows(parsed(spark, sf)))
    return m.remove_stopwords(tokens, stoplist(spark, sf), broadcast_rows=0)


def dfm_stopword_table(spark, sf):
    """The list is chosen from the table of all languages and sources by the job."""
    return m.text_to_dfm(
        stored(spark, sf),
        stopwords=m.materialize(word_table(spark, sf)),
        lang="en",
        stopword_source="src0",
    )


def dfm_content_lemma(spark, sf):
    return m.text_to_dfm(stored(spark, sf), stopwords=stoplist(spark, sf))


def dfm_bare_lemma(spark, sf):
    return m.text_to_dfm(stored(spark, sf), heb_lemma=False, use_lemma=True)


def dfm_options(spark, sf):
    return m.text_to_dfm(
        stored(spark, sf),
        pos_keep=["NN", "VB", "yyDOT"],
        remove_punct=False,
        remove_stopwords=False,
        strip_trailing_punct=False,
    )


def dfm_from_tokens(spark, sf):
    return m.dfm(m.lattice_tokens(decoded(spark, sf), remove_punct=True))


def dfm_documents(spark, sf):
    return m.dfm_documents(parsed(spark, sf), pos_keep=["VB"])


def featnames(spark, sf):
    return m.featnames(m.text_to_dfm(stored(spark, sf)))


def featnames_direct(spark, sf):
    return m.featnames(m.content_tokens(parsed(spark, sf)))


def topfeatures(spark, sf):
    return m.topfeatures(m.text_to_dfm(stored(spark, sf)), 25)


def topfeatures_direct(spark, sf):
    return m.topfeatures(
        m.content_tokens(parsed(spark, sf), stopwords=stoplist(spark, sf)), 25
    )


def topfeatures_bounded(spark, sf):
    """Only features of hash buckets that may hold one of the first 25 are counted."""
    tokens = m.materialize(
        m.content_tokens(parsed(spark, sf), stopwords=stoplist(spark, sf)).select("token")
    )
    return m.topfeatures(tokens, 25, buckets=FEATURE_BUCKETS)


def feature_index(spark, sf):
    return m.feature_index(m.text_to_dfm(stored(spark, sf)))


def dfm_vectors(spark, sf):
    vectors = m.dfm_vectors(
        m.text_to_dfm(stored(spark, sf)),
        docs=m.dfm_documents(parsed(spark, sf)),
        features_per_block=10_000,
    )
    return joined(vectors)


def dfm_vectors_whole(spark, sf):
    """One row per document."""
    counts = m.text_to_dfm(stored(spark, sf))
    return joined(m.dfm_vectors(counts, docs=m.dfm_documents(parsed(spark, sf))))


def joined(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        "doc_id",
        "block",
        F.array_join("indices", " ").alias("indices"),
        F.array_join("values", " ").alias("values"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        documents_mapped,
        stored_responses,
        stopword_list,
        pretokenized_parse,
        annotate_pretokenized,
        malformed_bodies,
        wire_text,
        annotate_python,
        annotate_keep_errors,
        annotate_deadline,
        explode_md,
        explode_dep,
        explode_md_pieces,
        explode_dep_pieces,
        coerce_int,
        token_id_window,
        token_id_sparse,
        parse_morphemes,
        parse_dependencies,
        parse_repeated_ids,
        attach_dependencies,
        attach_dependencies_stored,
        alignment_report,
        alignment_report_stored,
        response_alignment,
        drop_empty_documents,
        union_batches,
        ambiguous_lattices,
        parse_keep_lattice,
        remove_punct,
        keep_pos,
        token_rows,
        tokens_surface,
        tokens_lemma,
        tokens_in_parts,
        tokens_repeated_ids,
        tokens_from_lattices,
        relation_filter,
        first_n,
        parse_summary,
        doc_count,
        doc_names,
        strip_punct,
        stopword_removal,
        stopword_removal_large,
        dfm_stopword_table,
        dfm_content_lemma,
        dfm_bare_lemma,
        dfm_options,
        dfm_from_tokens,
        dfm_documents,
        featnames,
        featnames_direct,
        topfeatures,
        topfeatures_direct,
        topfeatures_bounded,
        feature_index,
        dfm_vectors,
        dfm_vectors_whole,
    )
}
