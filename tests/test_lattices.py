import json
import random

import pytest
from pyspark.sql import functions as F, types as T

import morphloom as m
from fixtures import COOKS, COOKS_TREE, SEA, lattice
from morphloom.functions import int_or_null
from morphloom.schemas import DEP_COLUMNS, MD_COLUMNS


def decoded(spark, *rows):
    """``(md_lattice, dep_tree)`` pairs of documents 0, 1, ..."""
    return spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)], "doc_id string, md_lattice string, dep_tree string"
    )


def md_rows(spark, text):
    return m.explode_md(decoded(spark, (text, None))).orderBy("sentence_id", "position").collect()


def test_one_sentence(spark):
    df = m.explode_md(decoded(spark, (lattice(COOKS), None)))
    assert df.columns == ["doc_id", "sentence_id", *MD_COLUMNS, "position"]
    rows = df.orderBy("position").collect()
    assert len(rows) == 6 and {r.sentence_id for r in rows} == {1}
    assert (rows[1].token, rows[1].lemma) == ("Tbxym", "Tbx")
    assert all(isinstance(rows[0][c], str) for c in MD_COLUMNS)


def test_blank_line_separates_sentences(spark):
    rows = md_rows(spark, lattice(COOKS, SEA))
    assert [r.sentence_id for r in rows] == [1] * 6 + [2] * 3
    assert [r.position for r in rows] == [1, 2, 3, 4, 5, 6, 1, 2, 3]


@pytest.mark.parametrize("text", ["", "\n", "\n\n\n", None])
def test_empty_lattice(spark, text):
    df = m.explode_md(decoded(spark, (text, None)))
    assert df.count() == 0 and "sentence_id" in df.columns
    assert m.parse(decoded(spark, (text, text)), dependency=True).count() == 0


def test_blank_lines_at_the_ends_and_in_runs(spark):
    rows = md_rows(spark, "\n\n" + lattice(COOKS) + "\n\n\n\n" + lattice(SEA) + "\n\n")
    assert sorted({r.sentence_id for r in rows}) == [1, 2]


def test_a_line_of_blanks_is_a_row(spark):
    assert [(r.sentence_id, r["from"]) for r in md_rows(spark, "a\n \nb\n\r\nc")] == [
        (1, "a"),
        (1, " "),
        (1, "b"),
        (1, "\r"),
        (1, "c"),
    ]


def test_short_and_long_lines(spark):
    short, long_, tab, two, inner = md_rows(
        spark,
        "\n".join(["0\t1\ta\tb\tNN", "\t".join("012345678"), "0\t1\ta\tb\tNN\tNN\t_\t", "x\t\t", "\t\tz"]),
    )
    assert (short.cpostag, short.postag, short.feats, short.token_id) == ("NN", None, None, None)
    assert long_.token_id == "7"
    assert (tab.feats, tab.token_id) == ("_", None)
    assert (two["from"], two.to, two.token) == ("x", "", None)
    assert (inner["from"], inner.to, inner.token) == ("", "", "z")


def brute_force(text, width):
    """Line by line, as the format is defined."""
    out, sentence, position, gap = [], 1, 0, False
    for line in text.split("\n"):
        if line == "":
            gap = gap or bool(out)
            continue
        if gap:
            sentence, position, gap = sentence + 1, 0, False
        fields = line.split("\t")
        if fields[-1] == "":
            fields.pop()
        position += 1
        out.append((sentence, position, *(fields + [None] * width)[:width]))
    return out


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("\n\n\t\tab \r", k=rng.randint(0, 40))) for _ in range(n)]


def test_decode_agrees_with_brute_force(spark):
    texts = random_texts(400, 1)
    got = {}
    for r in m.explode_md(decoded(spark, *[(t, None) for t in texts])).collect():
        got.setdefault(int(r.doc_id), []).append(
            (r.sentence_id, r.position, *(r[c] for c in MD_COLUMNS))
        )
    for i, text in enumerate(texts):
        assert sorted(got.get(i, []), key=lambda r: r[:2]) == brute_force(text, 8), repr(text)


def test_dependencies_agree_with_brute_force(spark):
    mds, deps = random_texts(400, 2), random_texts(400, 3)
    table = m.parse(decoded(spark, *zip(mds, deps)), dependency=True)
    got = {}
    for r in table.collect():
        got.setdefault(int(r.doc_id), []).append((r.sentence_id, r.token_id, r.token, r.deprel))
    for i, (md, dep) in enumerate(zip(mds, deps)):
        arcs = {r[:2]: r[9] for r in brute_force(dep, 8)}
        want = [(s, p, f[2], arcs.get((s, p))) for s, p, *f in brute_force(md, 8)]
        assert sorted(got.get(i, []), key=lambda r: r[:2]) == want


def test_coerce_int(spark):
    values = ["3", " 12 ", "3.7", "-3.7", "1e2", ".5", "_", "", "1d", "1f", "0x1A", "x", "NaN"]
    values += ["99999999999", "2147483647", "-2147483648", "1e400", None]
    want = [3, 12, 3, -3, 100, 0] + [None] * 8 + [2147483647] + [None] * 3
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.v for r in m.coerce_int(df, ["v", "absent"]).orderBy("i").collect()]
    assert got == want
    md = m.coerce_int(m.explode_md(decoded(spark, (lattice(COOKS), None))), ["from", "to", "token_id"])
    types = {f.name: f.dataType for f in md.schema}
    assert types["from"] == types["to"] == types["token_id"] == T.IntegerType()
    assert types["lemma"] == T.StringType()


def test_dependency_rows(spark):
    dep = m.explode_dep(decoded(spark, (None, lattice(COOKS_TREE))))
    assert dep.columns == ["doc_id", "sentence_id", *DEP_COLUMNS, "position"]
    rows = m.coerce_int(dep, ["id", "head"]).orderBy("position").collect()
    assert (rows[2].head, rows[2].deprel, rows[1].head) == (0, "ROOT", 3)


def both_ways(spark, md, dep):
    """The in-row and the two-table join must agree."""
    rows = decoded(spark, (md, dep))
    order = ["sentence_id", "token_id"]
    one = m.parse(rows, dependency=True).orderBy(*order).collect()
    two = m.morpheme_table(
        m.attach_dependencies(m.explode_md(rows), m.explode_dep(rows))
    ).orderBy(*order).collect()
    assert one == two
    report = m.alignment_report(m.explode_md(rows), m.explode_dep(rows)).orderBy("sentence_id").collect()
    assert report == m.response_alignment(rows).orderBy("sentence_id").collect()
    return one, report


def test_attach_dependencies(spark):
    rows, report = both_ways(spark, lattice(COOKS), lattice(COOKS_TREE))
    assert len(rows) == 6
    assert (rows[2].head_token_id, rows[2].deprel) == (0, "ROOT")
    assert [tuple(r) for r in report] == [("0", 1, 6, 6, 6, "ok")]


def test_shorter_tree(spark):
    rows, report = both_ways(spark, lattice(COOKS), lattice(COOKS_TREE[:3]))
    assert [r.head_token_id for r in rows] == [2, 3, 0, None, None, None]
    assert [tuple(r) for r in report] == [("0", 1, 6, 3, 3, "length_differs")]


def test_longer_tree_and_missing_sentence(spark):
    rows, report = both_ways(spark, lattice(COOKS[:2], SEA), lattice(COOKS_TREE))
    assert [r.head_token_id for r in rows] == [2, 3, None, None, None]
    assert [r.status for r in report] == ["length_differs", "dep_missing"]
    assert [(r.n_md, r.n_dep, r.n_aligned) for r in report] == [(2, 6, 2), (3, 0, 0)]


def test_surplus_tree_sentences_are_dropped(spark):
    rows, report = both_ways(spark, lattice(COOKS), lattice(COOKS_TREE, COOKS_TREE))
    assert len(rows) == 6 and [r.status for r in report] == ["ok"]


@pytest.mark.parametrize("dep", [None, ""])
def test_no_tree(spark, dep):
    rows, report = both_ways(spark, lattice(COOKS), dep)
    assert [r.deprel for r in rows] == [None] * 6
    assert [r.status for r in report] == ["dep_missing"]


def test_output_schema(spark):
    plain = m.parse(decoded(spark, (lattice(COOKS), None)))
    full = m.parse(decoded(spark, (lattice(COOKS), None)), dependency=True)
    for df, dependency in ((plain, False), (full, True)):
        empty = m.empty_parse(spark, dependency)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in empty.schema]
        assert empty.count() == 0
    assert tuple(plain.orderBy("token_id").collect()[1]) == (
        "0", 1, 2, "Tbxym", "Tbx", "NN", "NN", "gen=M|num=P",
    )


def test_documents_without_rows_disappear(spark):
    rows = decoded(spark, (lattice(SEA), None), ("", None), (None, None))
    assert m.summary(m.parse(rows)).first() == (3, 1)


def test_repeated_ids_are_parsed_apart(spark):
    rows = spark.createDataFrame(
        [("a", lattice(SEA), 1), ("a", lattice(COOKS), 2)], "doc_id string, md_lattice string, doc_order int"
    )
    table = m.parse(rows)
    assert table.columns[:2] == ["doc_id", "doc_order"]
    assert {(r.doc_order, r.sentence_id, r.n) for r in table.groupBy("doc_order", "sentence_id").agg(
        F.count("*").alias("n")
    ).collect()} == {(1, 1, 3), (2, 1, 6)}


def test_trees_of_repeated_ids_are_not_mixed(spark):
    rows = spark.createDataFrame(
        [("a", lattice(SEA), lattice(COOKS_TREE[:1]), 1), ("a", lattice(COOKS), lattice(COOKS_TREE), 2)],
        "doc_id string, md_lattice string, dep_tree string, doc_order int",
    )
    with pytest.raises(Exception, match="several trees for document a"):
        plain = rows.drop("doc_order")
        m.attach_dependencies(m.explode_md(plain), m.explode_dep(plain)).collect()
    joined = m.morpheme_table(m.attach_dependencies(m.explode_md(rows), m.explode_dep(rows)))
    order = ["doc_order", "sentence_id", "token_id"]
    assert joined.orderBy(*order).collect() == m.parse(rows, dependency=True).orderBy(*order).collect()


def test_batches_can_be_put_together(spark):
    one = m.parse(decoded(spark, (lattice(COOKS), None)))
    two = m.parse(decoded(spark, (lattice(SEA), None)))
    assert one.unionByName(two).count() == 9


def test_token_ids_restart_per_sentence(spark):
    df = spark.createDataFrame(
        [("a", s, i) for i, s in enumerate([1, 1, 1, 2, 2, 3])], "doc_id string, sentence_id int, place int"
    )
    got = m.with_token_id(df, "place").orderBy("place").collect()
    assert [r.token_id for r in got] == [1, 2, 3, 1, 2, 1]


@pytest.mark.parametrize("rows_per_block", [1, 3, 7, 1000])
def test_token_ids_in_blocks(spark, rows_per_block):
    """One sentence holds most rows and is numbered over many blocks."""
    rng = random.Random(5)
    rows = [("hot", 1, p) for p in rng.sample(range(-300, 300), 200)]
    rows += [(str(d), s, p) for d in range(5) for s in (1, 2) for p in rng.sample(range(50), 4)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, place long")
    got = {(r.doc_id, r.sentence_id, r.place): r.token_id for r in m.with_token_id(
        df, "place", rows_per_block
    ).collect()}
    groups = {}
    for d, s, p in sorted(rows):
        groups.setdefault((d, s), []).append(p)
    assert got == {(*k, p): i + 1 for k, ps in groups.items() for i, p in enumerate(ps)}


@pytest.mark.parametrize("rows_per_block", [7, 100_000])
def test_token_ids_of_sparse_order_values(spark, rows_per_block):
    """A sentence whose order values lie far apart, over the whole range of a bigint."""
    rng = random.Random(6)
    far = sorted({rng.randrange(-(2**63), 2**63) for _ in range(150)} | {-(2**63), 2**63 - 1, 0, -1, 1})
    rows = [("hot", 1, p) for p in far] + [("a", 1, 10**12), ("a", 1, 10), ("a", None, 5), (None, 1, 7)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, place long")
    got = [(r.doc_id, r.sentence_id, r.place, r.token_id) for r in m.with_token_id(df, "place", rows_per_block).collect()]
    want = [("hot", 1, p, i + 1) for i, p in enumerate(far)]
    want += [("a", 1, 10, 1), ("a", 1, 10**12, 2), ("a", None, 5, 1), (None, 1, 7, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_token_ids_by_timestamp_and_date(spark):
    df = spark.sql(
        "SELECT 'd' doc_id, 1 sentence_id, timestamp_micros(id * id * 977000) at, date_add(DATE'2020-01-01', int(id * 13)) day"
        " FROM range(300)"
    )
    for col in ("at", "day"):
        got = m.with_token_id(df, col, rows_per_block=10).orderBy(col).collect()
        assert [r.token_id for r in got] == list(range(1, 301))


def test_no_window_holds_a_long_sparse_sentence(spark):
    """A million rows with timestamps in one sentence: the windows are over blocks."""
    df = spark.sql("SELECT 'd' doc_id, 1 sentence_id, id * 1000003 AS at FROM range(1000000)")
    out = m.with_token_id(df, "at", rows_per_block=1000)
    assert out.agg({"token_id": "max"}).first()[0] == 1_000_000
    assert out.where("token_id <> at div 1000003 + 1").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(doc_id" not in plan


def test_dense_order_values_are_numbered_without_a_join(spark):
    df = spark.sql("SELECT 'd' doc_id, 1 sentence_id, id AS at FROM range(1000)")
    plan = m.with_token_id(df, "at")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    given = m.with_token_id(df, "at", rows_per_block=10, order_range=(0, 999)).orderBy("at").collect()
    assert [r.token_id for r in given] == list(range(1, 1001))


def test_keep_lattice(spark, tmp_path):
    log = str(tmp_path / "calls")

    def factory():
        def annotator(wire):
            with open(log, "a") as f:
                f.write("x")
            if wire == "\n\n":
                return json.dumps({"ma_lattice": "lost"})
            return json.dumps({"ma_lattice": "raw", "md_lattice": "0\t1\tw\tw\tNN\tNN\t_\t1\n\n"})

        return annotator

    docs = m.documents_from_strings(spark, {"a": "w", "b": " "})
    table, lattices = m.parse(docs, factory, keep_lattice=True)
    assert table.count() == 1
    assert [tuple(r) for r in lattices.collect()] == [("a", "raw")]
    with open(log) as f:
        assert len(f.read()) == 2  # once per document, although both tables were read


def test_parse_needs_something_to_parse(spark):
    with pytest.raises(ValueError, match="annotator_factory"):
        m.parse(m.documents_from_strings(spark, ["a"]))


def test_int_or_null_is_an_expression(spark):
    assert spark.range(1).select(int_or_null(F.lit("7"))).first()[0] == 7


@pytest.mark.parametrize("chars", [1, 7, 60, 500, 1_000_000])
def test_pieces_have_the_rows_of_the_whole(spark, chars):
    sentences = [f"{i}\t{i + 1}\tשלום{i}\tx\tNN\tNN\t_\t{i}\n\tb" for i in range(60)]
    texts = [
        "\n\n".join(sentences) + "\n\n",
        "\n\n\n\n" + "\n\n\n".join(sentences[:9]) + "\n" * 9,
        "\n" * 40,
        "",
        None,
        sentences[0] * 30,  # one sentence: no border
        "a\n\n \n\nb",
    ]
    rows = [(str(i % 5), i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id string, doc_order int, md_lattice string")
    pieces = m.cut_lattices(df, bytes_per_piece=chars)
    got, want = m.explode_md(pieces), m.explode_md(df)
    assert got.columns == want.columns and got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    longest = max(len(s.encode()) for s in sentences[:59] + [texts[5]])
    assert max(len((r.md_lattice or "").encode()) for r in pieces.collect()) <= chars + longest + 60
    trees = m.explode_dep(pieces, "md_lattice")
    assert trees.exceptAll(m.explode_dep(df, "md_lattice")).isEmpty()


def test_pieces_need_a_width(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, md_lattice string")
    with pytest.raises(ValueError):
        m.cut_lattices(df, bytes_per_piece=0)


def test_short_pieces_share_a_batch(spark):
    """One batch per piece cost many times what the cut does."""
    import pyarrow as pa

    class Rows:
        columns = ["doc_id", "md_lattice"]

        def select(self, *_):
            self.schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("_text", T.BinaryType())])
            return self

        def mapInArrow(self, run, schema):
            text = b"a\n\nb\n\nc\n\n" * 50
            batch = pa.RecordBatch.from_arrays(
                [pa.array(["x", "y", "z"]), pa.array([text, None, b"a"], pa.binary())], names=["doc_id", "_text"]
            )
            self.out = [*run([batch])]
            return self

    rows = Rows()
    m.cut_lattices(rows, bytes_per_piece=1)
    (batch,) = rows.out
    assert batch.num_rows == 152
    assert batch.column("doc_id").to_pylist() == ["x"] * 150 + ["y", "z"]
    assert batch.column("sentence_offset").to_pylist() == [*range(150), 0, 0]
    assert batch.column("_text").to_pylist() == [b"a", b"b", b"c"] * 50 + [None, b"a"]


def test_sparse_order_of_short_sentences_needs_no_tree(spark):
    rows = [(str(d), 1, i * -7_000_000_011, f"w{i}") for d in range(3) for i in range(12)]
    rows += [("long", 2, i * 5_000_000_000, f"w{i}") for i in range(70)] + [(None, 1, None, "a"), (None, 1, 4, "b")]
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, place long, token string")

    def joins(numbered):
        return numbered._jdf.queryExecution().optimizedPlan().toString().count("Join")

    assert joins(m.with_token_id(df.where("doc_id != 'long'"), "place", rows_per_block=10)) == 0
    numbered = m.with_token_id(df, "place", rows_per_block=10)
    assert joins(numbered) > 2
    got = {(r.doc_id, r.token): r.token_id for r in numbered.collect()}
    want = {(str(d), f"w{i}"): 12 - i for d in range(3) for i in range(12)}
    want |= {("long", f"w{i}"): i + 1 for i in range(70)} | {(None, "a"): 1, (None, "b"): 2}
    assert got == want
