"""Row-wise operators take streams as they are."""

import pytest
from pyspark.sql import types as T

import morphloom as m
from harness.stub import make_annotator, stub_annotated

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def batch(spark):
    return m.documents(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.fixture
def stream(spark, tmp_path, batch):
    batch.repartition(3).write.parquet(str(tmp_path / "docs"))
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("text", T.StringType())])
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "docs"))
    )


def run(spark, df, name, mode="append"):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert query.exception() is None
    return spark.table(name)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_parse(spark, stream, batch):
    for i, dependency in enumerate((False, True)):
        got = run(spark, m.parse(stub_annotated(stream), dependency=dependency), f"parse{i}")
        same(got, m.parse(stub_annotated(batch), dependency=dependency))


def test_annotate(spark, stream, batch):
    got = run(spark, m.parse(stream, make_annotator), "annotated")
    same(got, m.parse(stub_annotated(batch)))


def test_content_tokens(spark, stream, batch):
    stops = ["the", "de", "und", "of"]
    got = run(spark, m.content_tokens(m.parse(stub_annotated(stream)), stopwords=stops), "content")
    same(got, m.content_tokens(m.parse(stub_annotated(batch)), stopwords=stops))


def test_lists(spark, stream, batch):
    got = run(spark, m.text_to_tokens(stub_annotated(stream), use_lemma=True), "lists")
    same(got, m.text_to_tokens(stub_annotated(batch), use_lemma=True))


def test_running_counts(spark, stream, batch):
    got = run(spark, m.text_to_dfm(stub_annotated(stream)), "counts", "complete")
    same(got, m.text_to_dfm(stub_annotated(batch)))
