"""Calls with a deadline go on from one batch of documents to the next."""

import time

import pytest

import morphloom as m


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def factory():
    import time as clock

    def annotator(wire):
        if "hang" in wire:
            clock.sleep(600)
        if "bad" in wire:
            raise ValueError("bad")
        return wire.strip()

    return annotator


def test_a_hanging_call_does_not_hold_up_the_next_batch(spark, small_batches):
    texts = [{4: "hang", 1: "bad"}.get(i % 10, f"w{i}") for i in range(160)] + [None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string").coalesce(1)
    m.annotate(df.limit(3), factory, on_error="keep").collect()  # a worker
    start = time.time()
    rows = m.annotate(df, factory, on_error="keep", in_flight=8, deadline=2.0).collect()
    # 16 hanging calls, eight at once; one batch after the other they take 32 s.
    assert time.time() - start < 15
    assert [r.doc_id for r in rows] == [str(i) for i in range(161)]
    for row, text in zip(rows, texts):
        assert row.response == (None if text in ("hang", "bad") else text)
        want = {"hang": "TimeoutError: no answer within 2 s", "bad": "ValueError: bad"}.get(text)
        assert row.error == want


@pytest.mark.parametrize("options", [{}, {"in_flight": 3}])
def test_batches_end_where_they_did(spark, small_batches, options):
    df = spark.range(23).selectExpr("string(id) doc_id", "concat('w', id) text").coalesce(1)
    rows = m.annotate(df, factory, **options).collect()
    assert [(r.doc_id, r.response) for r in rows] == [(str(i), f"w{i}") for i in range(23)]
    bad = spark.range(23).selectExpr("string(id) doc_id", "if(id = 17, 'bad', 'w') text").coalesce(1)
    with pytest.raises(Exception, match="annotator failed on document '17'"):
        m.annotate(bad, factory, **options).collect()


def test_texts_behind_a_hanging_call_are_bounded():
    """Short answers to long texts: not all of them are read while one call hangs."""
    from morphloom.operators.calls import AHEAD_BYTES, Calls

    def made():
        return lambda wire: time.sleep(1.0) if wire == "hang" else "x"

    read = []

    def wires():
        for i in range(400):
            read.append(i)
            yield "hang" if i == 0 else "t" * 1_000_000 if i % 2 else None

    answers = Calls(made, 4, 5.0).answers(wires())
    next(answers)
    assert len(read) <= 2 * AHEAD_BYTES / 1_000_000 + 10
    assert sum(1 for _ in answers) == 399
