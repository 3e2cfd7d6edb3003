import pytest
from pyspark.sql import functions as F

import morphloom as m


def test_unnamed_strings_are_numbered(spark):
    docs = m.documents_from_strings(spark, ["a", "b"])
    assert [tuple(r) for r in docs.collect()] == [("text1", "a"), ("text2", "b")]


def test_named_strings_keep_names(spark):
    docs = m.documents_from_strings(spark, {"x": "a", "y": "b"})
    assert [r.doc_id for r in docs.collect()] == ["x", "y"]
    docs = m.documents_from_strings(spark, ["a", "b"], names=["x", "y"])
    assert [r.doc_id for r in docs.collect()] == ["x", "y"]


@pytest.mark.parametrize("names", [["x", ""], ["x", None]])
def test_one_missing_name_renames_all(spark, names):
    docs = m.documents_from_strings(spark, ["a", "b"], names=names)
    assert [r.doc_id for r in docs.collect()] == ["text1", "text2"]


def test_only_strings_are_texts(spark):
    for bad in ([1, 2, 3], "one string", {"a": 1}):
        with pytest.raises(TypeError):
            m.documents_from_strings(spark, bad)
    with pytest.raises(ValueError):
        m.documents_from_strings(spark, ["a", "b"], names=["x"])


def test_no_strings_give_an_empty_table(spark):
    docs = m.documents_from_strings(spark, [])
    assert docs.columns == ["doc_id", "text"] and docs.count() == 0


def test_table_keeps_ids_and_texts_only(spark):
    df = spark.createDataFrame([("one", "aa", 5), ("two", "bb", 6)], "doc_id string, text string, x int")
    docs = m.documents(df)
    assert docs.columns == ["doc_id", "text"]
    assert [tuple(r) for r in docs.collect()] == [("one", "aa"), ("two", "bb")]


def test_columns_are_mapped_and_ids_become_strings(spark):
    df = spark.createDataFrame([(7, 1, "aa"), (7, 0, "bb")], "conv bigint, turn int, body string")
    docs = m.documents(df, "conv", "body", order_col="turn")
    assert docs.columns == ["doc_id", "text", "doc_order"]
    assert {tuple(r) for r in docs.collect()} == {("7", "aa", 1), ("7", "bb", 0)}


def test_missing_columns_are_an_error(spark):
    df = spark.createDataFrame([("one", "aa")], "doc_id string, body string")
    with pytest.raises(ValueError, match="text"):
        m.documents(df)
    with pytest.raises(ValueError, match="response"):
        m.responses(df)


def test_stored_responses(spark):
    df = spark.createDataFrame([(1, "{}", 3)], "id int, body string, x int")
    assert [tuple(r) for r in m.responses(df, "id", "body").collect()] == [("1", "{}")]


def test_stopword_list_is_chosen_by_language_and_source(spark):
    df = spark.createDataFrame(
        [
            ("he", "stopwords-iso", "A"),
            ("he", "stopwords-iso", "a"),
            ("he", "stopwords-iso", None),
            ("he", "other", "b"),
            ("en", "stopwords-iso", "c"),
        ],
        "lang string, source string, word string",
    )
    assert [r.word for r in m.stopwords(df).collect()] == ["a"]
    assert [r.word for r in m.stopwords(df, "en").collect()] == ["c"]
    assert m.stopwords(df, "xx").count() == 0


def test_small_input_is_spread_and_large_is_left_alone(spark, monkeypatch, tmp_path):
    df = spark.range(100).coalesce(1)
    assert m.spread_small(df).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        big = spark.read.parquet(path)
        assert m.spread_small(big) is big
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wire_text(spark):
    texts = ["  a  b\tc\n", "", "   ", "a b", "a\x0bb\x0cc\r\nd", None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string")
    wires = [r.wire for r in m.wire_text(df).orderBy("doc_id").collect()]
    assert wires == ["a\nb\nc\n\n", "\n\n", "\n\n", "a b\n\n", "a\nb\nc\nd\n\n", None]
    raw = [r.wire for r in m.wire_text(df, pre_tokenized=True).orderBy("doc_id").collect()]
    assert raw == texts
    assert df.select(m.to_wire(F.lit("x y"))).first()[0] == "x\ny\n\n"
