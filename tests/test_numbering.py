"""Numbers within sentences, whatever the order and the place of the rows."""

import random

import pytest
from pyspark.sql import functions as F

import morphloom as m

DDL = "doc_id string, sentence_id int, place long, token string"


def numbered(df, *args):
    return sorted(map(tuple, m.with_token_id(df, *args).collect()), key=str)


def wanted(rows):
    groups = {}
    for d, s, p, t in rows:
        groups.setdefault((d, s), []).append((p is not None, p or 0, p, t))
    found = [
        (d, s, p, t, i + 1) for (d, s), some in groups.items() for i, (_, _, p, t) in enumerate(sorted(some))
    ]
    return sorted(found, key=str)


def sentences(rng, n):
    rows = []
    for i in range(n):
        doc, size = (None if i % 20 == 7 else f"d{i // 4}"), rng.choice([1, 3, 9, 25])
        places = rng.sample(range(-(10**12), 10**12), size)
        if i % 6 == 1:
            places[-1] = None
        rows.append([(doc, i, p, rng.choice(["a", "", None, "b\nc"])) for p in places])
    return rows


@pytest.mark.parametrize("per_block", [4, 1000])
@pytest.mark.parametrize("layout", ["together", "backwards", "shuffled", "halves"])
def test_numbers_do_not_depend_on_where_rows_lie(spark, layout, per_block):
    rng = random.Random(3)
    lists = sentences(rng, 120)
    if layout == "backwards":
        lists = [sorted(some, key=lambda r: (r[2] is not None, r[2]), reverse=True) for some in lists]
    rows = [r for some in lists for r in some]
    if layout == "shuffled":
        rng.shuffle(rows)
    if layout == "halves":  # runs that follow each other, far apart
        lists = [sorted(some, key=lambda r: (r[2] is not None, r[2] or 0)) for some in lists]
        rows = [r for some in lists for r in some[: len(some) // 2]] + [r for some in lists for r in some[len(some) // 2 :]]
    df = spark.createDataFrame(rows, DDL).repartition(1) if layout == "together" else spark.createDataFrame(rows, DDL)
    assert numbered(df, "place", per_block) == wanted(rows)


def test_a_table_is_read_once(spark, tmp_path):
    """However long its sentences are, and however often its rows are needed."""
    log = str(tmp_path / "calls")

    def count(batches):
        for batch in batches:
            with open(log, "a") as f:
                f.write("x" * batch.num_rows)
            yield batch

    rows = [("long", 1, 5 * i, "w") for i in range(90)] + [("a", i, -i, "w") for i in range(30)]
    df = spark.createDataFrame(rows, DDL)
    out = m.with_token_id(df.mapInArrow(count, df.schema), "place", 10)
    assert sorted(map(tuple, out.collect()), key=str) == wanted(rows)
    with open(log) as f:
        assert len(f.read()) == len(rows)


def test_only_runs_are_shuffled(spark):
    rows = spark.sql("SELECT string(id div 20) doc_id, 1 sentence_id, -id AS place, 'w' token FROM range(0, 20000, 1, 1)")
    plan = m.with_token_id(rows, "place")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning")
    assert "Generate" in above and "Generate" not in below
    # One run per sentence, and one more where a batch of rows ends within one.
    assert 1000 <= m.operators.lattices.pack(rows, ["doc_id", "sentence_id"]).count() <= 1003


@pytest.mark.parametrize("per_block", [2, 1000])
def test_columns_stay_in_their_order(spark, per_block):
    df = spark.sql("SELECT 'x' token, id AS token_id, 7 sentence_id, 'd' doc_id, date_add(DATE'2020-01-01', int(-id)) day FROM range(9)")
    for order, want in (("token_id", 0), ("day", 8)):
        out = m.with_token_id(df, order, per_block)
        assert out.columns == ["token", "sentence_id", "doc_id", "day", "token_id"]
        first = out.where("token_id = 1").select(F.datediff(F.lit("2020-01-01"), "day")).collect()
        assert [r[0] for r in first] == [want] and out.count() == 9


def test_rows_that_cannot_be_packed_are_numbered(spark):
    df = spark.sql("SELECT 'd' doc_id, int(id div 20) sentence_id, id * 3 AS place, array('w') tokens FROM range(50)")
    for per_block in (3, 1000):
        got = m.with_token_id(df, "place", per_block).collect()
        assert {(r.place, r.token_id) for r in got} == {(3 * i, i % 20 + 1) for i in range(50)}
