"""Text functions that read all of a lattice or body only where they have to."""

import pytest
from pyspark.sql import functions as F

from morphloom.functions import int_or_null, lattice_lines, sentence_blocks, strip_punct, to_wire
from morphloom.operators import ambiguous_lattices, decode_responses, explode_md, response_alignment

LATTICES = ["", "\n", "\n\n\n", "a", "\na\n", "a\nb\n\n\nc\n", "\n\na\n\nb\n\n", "\n \n\n\t\n", None]


def trimmed(text, between):
    import re

    body = (text or "").strip("\n")
    return re.split(between, body) if body else None


def test_blocks_and_lines(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LATTICES)], "i int, x string")
    rows = df.select("x", sentence_blocks("x").alias("s"), lattice_lines("x").alias("l")).collect()
    assert [r.s for r in rows] == [trimmed(r.x, "\n\n+") for r in rows]
    assert [r.l for r in rows] == [trimmed(r.x, "\n+") for r in rows]


def test_trees_of_empty_lattices_have_no_rows(spark):
    df = spark.createDataFrame(
        [(str(i), x, "t\n\nu") for i, x in enumerate(LATTICES)],
        "doc_id string, md_lattice string, dep_tree string",
    )
    assert {r.doc_id for r in response_alignment(df).collect()} == set("34567")
    ambiguous = ambiguous_lattices(df.withColumn("ma_lattice", F.lit("x")))
    assert {r.doc_id for r in ambiguous.collect()} == set("34567")


def test_integers_as_by_pattern(spark):
    values = ["7", "-7", "+7", "-0", "007", " 7 ", "7.9", "7.", "1e2", "\x017", "\x1f7", "7d", "",
              "2147483647", "2147483648", "-2147483648", "-2147483647", "0x7", "٧", None]
    want = [7, -7, 7, 0, 7, 7, 7, 7, 100, None, None, None, None,
            2147483647, None, None, -2147483647, None, None, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r.n for r in df.orderBy("i").select(int_or_null("v").alias("n")).collect()] == want


@pytest.mark.parametrize("body", ["", "[]", " null\n", "\r\n[]\t", "{}", " {}"])
def test_answers_without_content(spark, body):
    df = spark.createDataFrame([("a", body)], "doc_id string, response string")
    assert decode_responses(df, "keep").select("error").first()[0] is None


@pytest.mark.parametrize("body", [" ", "\n\n", "[] []", "nullnull", "[[]]", "x{}", "{} {}"])
def test_malformed_bodies(spark, body):
    df = spark.createDataFrame([("a", body)], "doc_id string, response string")
    assert decode_responses(df, "keep").select("error").first()[0] is not None


def test_no_text_is_trimmed_as_a_whole(spark):
    df = spark.createDataFrame([("a", "{}", "x")], "doc_id string, response string, text string")
    rows = explode_md(decode_responses(df, fields=("md_lattice",)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "btrim" not in plan and "trim(" not in plan.replace("BOTH", "")
    wires = [" a  b ", "a", "  a", "  ", "", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wires)], "i int, w string")
    got = [r.w for r in df.orderBy("i").select(to_wire("w").alias("w")).collect()]
    assert got == ["a\nb\n\n", "a\n\n", " \na\n\n", "\n\n", "\n\n", None]


def test_only_ragged_lattices_are_searched_for_their_ends(spark):
    df = spark.createDataFrame([("a", "x\n\n")], "doc_id string, md_lattice string")
    rows = explode_md(df)._jdf.queryExecution().optimizedPlan().toString()
    before = rows.index("regexp_extract")
    # The pattern stands in a branch, behind conditions on the ends.
    assert "StartsWith" in rows[:before] and "THEN regexp_extract" in rows
    texts = ["a\n\n", "a\n\n\n", "a\n", "\na\n\n", "é\n\n\u05d0\n\n", "\n\n", "\n\n\n", " \n\n"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    rows = df.orderBy("i").select(sentence_blocks("x").alias("s")).collect()
    assert [r.s for r in rows] == [["a"]] * 4 + [["é", "\u05d0"], None, None, [" "]]


def test_plain_words_need_no_pattern(spark):
    words = ["a", "Z", "09", "a.", "a.b", "...", "", "é", "é!", "x\u05d0", "a\n", "a`", "[", "a{", "/", ":",
             "@", "a\u0301", "a\U0001d7ce", "a$", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    assert "CASE WHEN" in df.select(strip_punct("w"))._jdf.queryExecution().optimizedPlan().toString()
    got = [r.s for r in df.orderBy("i").select(strip_punct("w").alias("s")).collect()]
    want = F.regexp_replace("w", r"(?<![\p{P}\p{S}])[\p{P}\p{S}]++\z", "")
    assert got == [r.s for r in df.orderBy("i").select(want.alias("s")).collect()]
    assert got[3:6] == ["a", "a.b", ""]
