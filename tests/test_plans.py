"""The plans are what they should be at scale, not only their results."""

import pytest
from pyspark.sql import functions as F

import morphloom as m
from fixtures import COOKS, COOKS_TREE, lattice


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Responses on disk, as a job would find them."""
    path = str(tmp_path_factory.mktemp("responses") / "t")
    spark.createDataFrame(
        [(str(i), lattice(COOKS), lattice(COOKS_TREE), 1) for i in range(20)],
        "doc_id string, md_lattice string, dep_tree string, junk int",
    ).select("doc_id", F.to_json(F.struct("md_lattice", "dep_tree")).alias("response"), "junk").write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_decode_needs_no_shuffle(stored):
    one = m.decode_responses(stored)
    for df in (
        m.parse(stored),
        m.parse_dependencies(stored),
        m.response_alignment(one),
        m.ambiguous_lattices(one),
        m.token_rows(m.parse(stored), True, True, ["NN"]),
        m.lattice_tokens(one, True, "_", True, ["NN"]),
        m.text_to_tokens(stored),
        m.content_tokens(m.parse(stored), stopwords=["x"]),
        m.relation_filter(m.parse_dependencies(stored), "subj"),
    ):
        assert "Exchange hashpartitioning" not in plan(df)
        assert "Exchange Range" not in plan(df)


def test_no_python_but_for_the_annotator(stored):
    for df in (m.parse_dependencies(stored), m.text_to_dfm(stored), m.to_tokens(m.parse(stored))):
        assert "Python" not in plan(df) and "MapInArrow" not in plan(df)


def test_only_needed_columns_and_fields_are_read(stored):
    text = plan(m.parse(stored))
    assert "junk" not in text and "dep_tree" not in text and "ma_lattice" not in text


def test_arrays_are_built_once(stored):
    assert plan(m.parse(stored)).count("posexplode(split(") == 2
    assert "Filter (size(" not in plan(m.parse_dependencies(stored))
    # Conditions on fields must not split the line again in front of the generator.
    line = "split(CASE WHEN"
    parsed = m.parse(stored)
    for df in (
        m.text_to_dfm(stored),
        m.remove_punct(parsed),
        m.token_rows(parsed, True, True, ["NN"]),
        m.to_tokens(parsed, pos_keep=["NN"]),
        m.dfm_documents(parsed),
        m.content_tokens(parsed, stopwords=["x"]),
    ):
        assert plan(df).count(line) == 1
    # One line of each kind, the tree's first.
    subjects = plan(m.relation_filter(m.parse_dependencies(stored), "subj"))
    assert subjects.count(line) == 2


def test_stopwords_are_broadcast(stored):
    text = plan(m.content_tokens(m.parse(stored), stopwords=["x", "y"]))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_counts_take_one_shuffle(stored):
    names = m.featnames(m.content_tokens(m.parse(stored)))
    assert plan(names).count("Exchange hashpartitioning") == 1
    assert plan(m.text_to_dfm(stored)).count("Exchange hashpartitioning") == 1
    direct = plan(m.topfeatures(m.content_tokens(m.parse(stored))))
    assert direct.count("Exchange hashpartitioning") == 1 and "TakeOrderedAndProject" in direct
    assert "partial_count" in direct
    assert plan(m.to_tokens(m.parse(stored))).count("Exchange hashpartitioning") == 1


def test_numbering_shuffles_the_rows_once(spark, stored):
    rows = m.explode_md(m.decode_responses(stored))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dense = plan(m.with_token_id(rows, "position"))
        text = plan(m.with_token_id(rows, "position", order_range=(0, 200_000)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Values that fit in one block: the rows only.
    assert dense.count("Exchange hashpartitioning") == 1 and "Join" not in dense
    # The rows; the sizes of the blocks by block, by sentence and by block again.
    assert text.count("Exchange hashpartitioning") == 4
    assert "SortMergeJoin" in text


def test_first_rows_are_no_full_sort(stored):
    text = plan(m.first_n(m.parse(stored)))
    assert "TakeOrderedAndProject" in text and "Exchange range" not in text


def test_checkpoints_go_to_the_configured_folder(spark):
    folder = spark.sparkContext.getCheckpointDir()
    assert folder is not None or spark.conf.get("spark.checkpoint.dir", None)
    df = m.materialize(spark.range(5))
    assert df.count() == 5
    assert "Scan ExistingRDD" in plan(df)


def test_tables_by_sentence_are_joined_where_they_lie(spark, stored, tmp_path):
    both = m.decode_responses(stored, fields=("md_lattice", "dep_tree"))
    tables = [
        m.store_by_sentence(rows, f"by_sentence_{kind}", 4, str(tmp_path / kind))
        for kind, rows in (("md", m.explode_md(both)), ("dep", m.explode_dep(both)))
    ]
    want = {
        "attach": m.attach_dependencies(m.explode_md(both), m.explode_dep(both)),
        "report": m.alignment_report(m.explode_md(both), m.explode_dep(both)),
    }
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        attached = m.attach_dependencies(*tables, co_located=True)
        report = m.alignment_report(*tables)
        for df, name in ((attached, "attach"), (report, "report")):
            text = plan(df)
            assert "SortMergeJoin" in text and "Exchange" not in text
            rows = want[name].select(df.columns)
            assert df.exceptAll(rows).isEmpty() and rows.exceptAll(df).isEmpty()
    finally:
        for key in settings:
            spark.conf.unset(key)
        for kind in ("md", "dep"):
            spark.sql(f"DROP TABLE by_sentence_{kind}")
