import json
import time

import pytest

import morphloom as m
from fixtures import COOKS, lattice


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id string, text string")


def responses(spark, *bodies):
    return spark.createDataFrame(
        [(str(i), b) for i, b in enumerate(bodies)], "doc_id string, response string"
    )


def test_annotator_gets_wire_text_once_per_document(spark):
    def factory():
        return lambda wire: json.dumps({"md_lattice": wire})

    out = m.annotate(docs(spark, ("a", "x y"), ("b", ""), ("c", None)), factory)
    assert out.columns == ["doc_id", "response"]
    got = {r.doc_id: r.response and json.loads(r.response)["md_lattice"] for r in out.collect()}
    assert got == {"a": "x\ny\n\n", "b": "\n\n", "c": None}


def test_pre_tokenized_text_is_sent_verbatim(spark):
    out = m.annotate(docs(spark, ("a", "x y\nz\n\n")), lambda: lambda wire: wire, pre_tokenized=True)
    assert out.first().response == "x y\nz\n\n"


def test_factory_runs_once_per_partition(spark, tmp_path):
    log = str(tmp_path / "calls")

    def factory():
        with open(log, "a") as f:
            f.write("x")
        return lambda wire: "{}"

    many = docs(spark, *[(str(i), "t") for i in range(50)])
    assert m.annotate(many, factory, partitions=3).count() == 50
    with open(log) as f:
        assert len(f.read()) <= 3


def test_long_responses_are_handed_over_in_pieces(spark):
    many = docs(spark, *[(str(i), "t") for i in range(20)]).coalesce(1)
    out = m.annotate(many, lambda: lambda wire: "y" * 3_000_000)
    got = out.selectExpr("doc_id", "length(response) n").collect()
    assert sorted(r.doc_id for r in got) == sorted(str(i) for i in range(20))
    assert {r.n for r in got} == {3_000_000}


def failing():
    def annotator(wire):
        if "bad" in wire:
            raise ValueError("no analysis")
        return "{}"

    return annotator


def test_failure_stops_the_job(spark):
    with pytest.raises(Exception, match="annotator failed on document 'b'"):
        m.annotate(docs(spark, ("a", "good"), ("b", "bad")), failing).collect()


def test_failure_can_be_kept_as_data(spark):
    out = m.annotate(docs(spark, ("a", "good"), ("b", "bad")), failing, on_error="keep")
    assert {tuple(r) for r in out.collect()} == {
        ("a", "{}", None),
        ("b", None, "ValueError: no analysis"),
    }
    # The message survives decoding.
    kept = m.decode_responses(out, "keep", ("md_lattice",))
    assert {tuple(r) for r in kept.collect()} == {
        ("a", None, None),
        ("b", None, "ValueError: no analysis"),
    }


def test_kept_failures_are_not_lost_unnoticed(spark):
    out = m.annotate(docs(spark, ("a", "good"), ("b", "bad")), failing, on_error="keep")
    with pytest.raises(Exception, match="no analysis"):
        m.parse(out).collect()
    assert m.parse(out, on_error="keep").count() == 0


def test_order_column_is_carried(spark):
    src = spark.createDataFrame([("a", "x", 2), ("a", "y", 1)], "id string, body string, place int")
    out = m.annotate(m.documents(src, "id", "body", "place"), lambda: lambda wire: wire)
    assert {tuple(r) for r in out.collect()} == {("a", 2, "x\n\n"), ("a", 1, "y\n\n")}
    assert m.decode_responses(out, "keep", ("md_lattice",)).columns == [
        "doc_id", "doc_order", "md_lattice", "error",
    ]


def test_unknown_policy_or_field(spark):
    with pytest.raises(ValueError):
        m.annotate(docs(spark, ("a", "x")), failing, on_error="ignore")
    with pytest.raises(ValueError):
        m.decode_responses(responses(spark, "{}"), fields=("other",))


def test_decode_takes_all_fields(spark):
    body = json.dumps({"ma_lattice": "a", "md_lattice": "b", "dep_tree": "c", "segmented_text": "d"})
    row = m.decode_responses(responses(spark, body)).first()
    assert tuple(row) == ("0", "a", "b", "c", "d")


@pytest.mark.parametrize("body", ["{}", "", "[]", "null", None, '{"md_lattice": null}'])
def test_answers_without_content(spark, body):
    assert m.decode_responses(responses(spark, body)).first().md_lattice is None
    assert m.parse(responses(spark, body)).count() == 0


@pytest.mark.parametrize(
    "body",
    [
        "bad",
        "  ",
        '"text"',
        '{"md_lattice": "x", "dep',
        '{"md_lattice": {"x": "a\\tb"}}',
        '{"md_lattice" :[1]}',
        '{"md_lattice":-7}',
        '{"md_lattice": true}',
        '{"dep_tree": "0\\t1", "md_lattice": 5}',
    ],
)
def test_malformed_answers(spark, body):
    with pytest.raises(Exception, match="malformed response of document 0"):
        m.decode_responses(responses(spark, body)).collect()
    row = m.decode_responses(responses(spark, body), "keep", ("md_lattice",)).first()
    assert tuple(row) == ("0", None, "malformed response of document 0")


@pytest.mark.parametrize("text", ["7", "[1]", '{"md_lattice": 5}', "true", '"md_lattice":5'])
def test_text_that_looks_like_json_is_text(spark, text):
    body = json.dumps({"md_lattice": text})
    assert m.decode_responses(responses(spark, body), fields=("md_lattice",)).first().md_lattice == text
    # A field that is not asked for is not looked at.
    other = json.dumps({"md_lattice": text, "dep_tree": 5})
    assert m.decode_responses(responses(spark, other), fields=("md_lattice",)).first().md_lattice == text


def test_documents_are_dealt_out(spark):
    few = docs(spark, *[(str(i), "good") for i in range(40)]).coalesce(1)
    lattice_of = lambda: lambda wire: json.dumps({"md_lattice": lattice(COOKS)})
    for df in (
        m.parse(few, lattice_of, partitions=5),
        m.parse_dependencies(few, lattice_of, partitions=5),
        m.text_to_tokens(few, lattice_of, partitions=5),
    ):
        assert df.rdd.getNumPartitions() == 5
    assert m.text_to_dfm(few, lattice_of, partitions=5).agg({"n": "sum"}).first()[0] == 160


def test_one_malformed_answer_among_good_ones(spark):
    good = json.dumps({"md_lattice": lattice(COOKS)})
    mixed = responses(spark, good, "bad", good)
    with pytest.raises(Exception, match="malformed response of document 1"):
        m.parse(mixed).collect()
    assert m.summary(m.parse(mixed, on_error="keep")).first() == (12, 2)


def test_calls_in_flight_keep_the_order_of_documents(spark):
    """Eight slow calls at once take an eighth of their time, and answers stay in order."""

    def factory():
        import time as clock

        def annotator(wire):
            clock.sleep(0.2 if wire.startswith("s") else 0.0)
            return wire.strip()

        return annotator

    texts = [f"{'s' if i % 2 else 'f'}{i}" for i in range(64)] + [None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string").coalesce(1)
    start = time.time()
    rows = m.annotate(df, factory, in_flight=16).collect()
    assert time.time() - start < 5
    assert [r.response for r in rows] == texts


def test_a_hanging_call_is_an_error_after_its_deadline(spark):
    def factory():
        import time as clock

        def annotator(wire):
            if "hang" in wire:
                clock.sleep(600)
            if "bad" in wire:
                raise ValueError("bad")
            return wire.strip()

        return annotator

    df = spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(["a", "hang", "b", "bad", "hang", "c", None])], "doc_id string, text string"
    ).coalesce(1)
    for in_flight in (1, 3):
        got = m.annotate(df, factory, on_error="keep", in_flight=in_flight, deadline=0.5).collect()
        assert [r.response for r in got] == ["a", None, "b", None, None, "c", None]
        late = "TimeoutError: no answer within 0.5 s"
        assert [r.error for r in got] == [None, late, None, "ValueError: bad", late, None, None]
    with pytest.raises(Exception, match="failed on document '1'"):
        m.annotate(df, factory, deadline=0.5).collect()
    with pytest.raises(ValueError, match="in_flight"):
        m.annotate(df, factory, in_flight=0)


def test_an_annotator_that_always_hangs_stops_the_task(spark):
    def factory():
        import time as clock

        return lambda wire: clock.sleep(600)

    df = spark.range(60).selectExpr("string(id) doc_id", "'x' text").coalesce(1)
    with pytest.raises(Exception, match="calls of the annotator hang"):
        m.annotate(df, factory, on_error="keep", in_flight=8, deadline=0.05).collect()


def test_a_factory_that_fails_stops_the_job(spark):
    def factory():
        raise OSError("no model")

    df = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for options in ({}, {"in_flight": 4}, {"deadline": 5.0}):
        with pytest.raises(Exception, match="no model"):
            m.annotate(df, factory, on_error="keep", **options).collect()


def test_a_hanging_call_holds_only_its_own_place(spark):
    """More calls hang than may in a row, each among others that are answered meanwhile."""

    def factory():
        import time as clock

        def annotator(wire):
            if "hang" in wire:
                clock.sleep(600)
            return wire.strip() + "x" * 500_000

        return annotator

    texts = [f"{'hang' if i % 5 == 2 else 'w'}{i}" for i in range(200)] + [None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string").coalesce(1)
    start = time.time()
    rows = m.annotate(df, factory, on_error="keep", in_flight=8, deadline=1.0).collect()
    assert time.time() - start < 20
    assert [r.doc_id for r in rows] == [str(i) for i in range(201)]
    for row, text in zip(rows, texts):
        if text is None or text.startswith("hang"):
            assert row.response is None and (row.error is None) == (text is None)
        else:
            assert row.response == text + "x" * 500_000 and row.error is None
