import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import morphloom as m
from fixtures import morpheme_table, tagged
from morphloom.operators import features, skew


def counts(df):
    return {(r.doc_id, r.feature): r.n for r in df.collect()}


def names(df):
    return {r.feature for r in m.featnames(df).collect()}


def hebrew(spark):
    return tagged(
        spark,
        a=[("ה", "DEF"), ("ילד", "NN"), ("הלך", "VB"), ("ל", "PREPOSITION"), ("בית", "NN")],
        b=[("יום", "NN"), ("יפה.", "JJ"), ("מאוד", "RB")],
    )


def test_content_words_without_trailing_punctuation(spark):
    got = names(m.parsed_to_dfm(hebrew(spark), remove_stopwords=False))
    assert got == {"ילד", "הלך", "בית", "יום", "יפה", "מאוד"}


def test_sentence_final_lemma_is_cleaned_not_dropped(spark):
    df = tagged(spark, a=[("ילד", "NN"), ("בית", "NNT"), ("ספר.", "NN")])
    got = names(m.parsed_to_dfm(df))
    assert "ספר" in got and "ספר." not in got


@pytest.mark.parametrize(
    "word, want",
    [
        ("ספר״", "ספר"),
        ("בית־", "בית"),
        ("צה״ל", "צה״ל"),
        ("...", ""),
        ("a+=", "a"),
        ("a.b!?", "a.b"),
        (".a", ".a"),
        ("a. ", "a. "),
        ("a.\n", "a.\n"),
        ("a€", "a"),
        ("", ""),
        (None, None),
    ],
)
def test_strip_punct(spark, word, want):
    df = spark.createDataFrame([(word, word, "x.")], "lemma string, token string, pos string")
    assert tuple(m.strip_trailing_punct(df).first()) == (want, want, "x.")
    assert tuple(m.strip_trailing_punct(df, ["lemma"]).first()) == (want, word, "x.")


def test_emptied_rows(spark):
    df = morpheme_table(
        spark,
        [("a", 1, 1, "x", "...", "NN"), ("a", 1, 2, "y", None, "NN"), ("b", 1, 1, "!", "!", "NN")],
    )
    stripped = m.drop_emptied(m.strip_trailing_punct(df), "lemma")
    assert [r.token for r in stripped.collect()] == ["y"]
    # A NULL lemma keeps its document in the matrix, an emptied one does not.
    assert [r.doc_id for r in m.dfm_documents(df).collect()] == ["a"]
    assert counts(m.parsed_to_dfm(df)) == {}


def test_options(spark):
    df = morpheme_table(
        spark,
        [
            ("a", 1, 1, "Ha.", "ha.", "NN"),
            ("a", 1, 2, "Ha.", "ha", "NN"),
            ("a", 1, 3, ",", ",", "yyCM"),
            ("a", 1, 4, "The", "the", "DEF"),
        ],
    )
    dfm = m.parsed_to_dfm
    assert counts(dfm(df)) == {("a", "ha"): 2}
    assert counts(dfm(df, strip_trailing_punct=False)) == {("a", "ha."): 1, ("a", "ha"): 1}
    assert counts(dfm(df, pos_keep=["DEF"])) == {("a", "the"): 1}
    # The cleaning leaves nothing of the comma even where its tag is wanted.
    assert counts(dfm(df, pos_keep=["yyCM"], remove_punct=False)) == {}
    assert counts(dfm(df, heb_lemma=True, use_lemma=False)) == {("a", "ha"): 2}
    # Without the content pipeline neither cleaning, nor default tags, nor stopwords.
    bare = {("a", "ha."): 1, ("a", "ha"): 1, ("a", "the"): 1}
    assert counts(dfm(df, heb_lemma=False, stopwords=["the"])) == bare
    assert counts(dfm(df, heb_lemma=False, use_lemma=False, remove_punct=False)) == {
        ("a", "ha."): 2,
        ("a", ","): 1,
        ("a", "the"): 1,
    }


def test_stopwords_ignore_case_and_are_literal(spark):
    df = tagged(spark, a=[("THE", "NN"), ("the", "NN"), ("cat", "NN"), ("c*t", "NN")])
    left = m.remove_stopwords(df, ["The", "c*t", None])
    assert [r.token for r in left.collect()] == ["cat"]
    table = spark.createDataFrame([("tHE",), ("the",), (None,)], "word string")
    assert m.remove_stopwords(df, table).count() == 2
    # No list, no removal.
    for none in (None, [], table.limit(0)):
        assert m.remove_stopwords(df, none).count() == 4


def test_rows_without_a_token_are_no_stopwords(spark):
    df = morpheme_table(spark, [("a", 1, 1, None, "x", "NN")])
    assert m.remove_stopwords(df, ["x", "null"]).count() == 1


def test_documents_of_stopwords_only(spark):
    df = tagged(spark, a=[("the", "NN")], b=[("cat", "NN")], c=[("x", "DEF")])
    assert counts(m.parsed_to_dfm(df, stopwords=["the"])) == {("b", "cat"): 1}
    assert sorted(r.doc_id for r in m.dfm_documents(df).collect()) == ["a", "b"]


def test_features_are_folded_and_repeated_ids_add_up(spark):
    df = spark.createDataFrame([("a", ["Cat", "cat", "", None]), ("a", ["CAT", "dog"])],
                               "doc_id string, tokens array<string>")
    assert counts(m.dfm(df)) == {("a", "cat"): 3, ("a", "dog"): 1}


def test_topfeatures(spark):
    df = tagged(spark, a=[("b", "NN"), ("a", "NN"), ("c", "NN"), ("c", "NN")], b=[("C", "NN")])
    want = [("c", 3), ("a", 1)]
    assert [tuple(r) for r in m.topfeatures(m.parsed_to_dfm(df), 2).collect()] == want
    assert [tuple(r) for r in m.topfeatures(m.content_tokens(df), 2).collect()] == want
    many = tagged(spark, a=[(f"w{i:02}", "NN") for i in range(30)])
    assert m.topfeatures(m.parsed_to_dfm(many)).count() == 10


def skewed(spark, n=3000, words=40):
    """A third of all tokens are one word, and a third sit in one document."""
    rng = random.Random(9)
    rows = [
        (
            "hot" if rng.random() < 0.33 else f"d{rng.randint(0, 30)}",
            1,
            i,
            "hot" if rng.random() < 0.33 else f"w{rng.randint(0, words)}",
        )
        for i in range(n)
    ]
    return rows, spark.createDataFrame(
        rows, "doc_id string, sentence_id int, token_id int, token string"
    )


@pytest.mark.parametrize("stops", [["hot", "w3", "w4"], ["w3", "absent"], ["x" * 300]])
def test_stopword_list_too_big_to_broadcast(spark, stops):
    rows, _ = skewed(spark)
    rows += [("a", 1, 1, None), ("a", 1, 2, "x" * 300)] * 500
    df = spark.createDataFrame(rows, "doc_id string, sentence_id int, token_id int, token string")
    table = spark.createDataFrame([(w,) for w in stops], "word string")
    left = m.remove_stopwords(df, table, broadcast_rows=0)
    plan = left._jdf.queryExecution().executedPlan().toString().split("\n")
    anti = [line for line in plan if "LeftAnti" in line]
    assert anti and not any("Broadcast" in line for line in anti)  # the filter is, the list is not
    assert left.columns == df.columns
    want = [r for r in rows if r[3] not in stops]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)


def test_size_check(spark):
    table = spark.createDataFrame([("a" * 50,), ("b" * 50,)], "word string")
    assert skew.is_small(table, "word") and skew.is_small(table.limit(0), "word")
    assert not skew.is_small(table, "word", chars=99)
    assert not skew.is_small(table, "word", rows=1)


def test_stopwords_by_language(spark):
    df = tagged(spark, a=[("b", "NN"), ("a", "NN"), ("c", "NN")])
    table = spark.createDataFrame(
        [("he", "stopwords-iso", "A"), ("he", "other", "b"), ("en", "stopwords-iso", "c")],
        "lang string, source string, word string",
    )
    got = m.parsed_to_dfm(df, stopwords=table, lang="he").collect()
    assert {r.feature for r in got} == {"b", "c"}


def test_vectors_refuse_an_index_that_lacks_a_feature(spark):
    table = m.dfm(skewed(spark, 100)[1])
    index = features.feature_index(table).where("feature <> 'hot'")
    with pytest.raises(Exception, match="not in the index: hot"):
        m.dfm_vectors(table, index).collect()


def test_feature_index_numbers_all_features(spark):
    _, df = skewed(spark)
    got = features.feature_index(m.dfm(df)).collect()
    assert sorted(r.feature_index for r in got) == list(range(len(got)))
    assert {r.feature for r in got} == {r.feature for r in m.featnames(m.dfm(df)).collect()}
    by_number = [r.feature for r in sorted(got, key=lambda r: r.feature_index)]
    import hashlib

    assert by_number == sorted(by_number, key=lambda w: (hashlib.md5(w.encode()).hexdigest()[:3], w))


@pytest.mark.parametrize("buckets", [1, 3, 64, features.FEATURE_BUCKETS])
def test_top_features_by_bucket(spark, buckets):
    _, df = skewed(spark)
    for n in (0, 1, 5, 40, 100_000):
        want = [tuple(r) for r in m.topfeatures(df, n).collect()]
        assert [tuple(r) for r in m.topfeatures(df, n, buckets=buckets).collect()] == want
        counted = m.dfm(df)
        assert [tuple(r) for r in m.topfeatures(counted, n, buckets=buckets).collect()] == want


def test_top_features_by_bucket_of_even_and_odd_tables(spark):
    even = spark.createDataFrame([(f"w{i:03}",) for i in range(300)] * 2, "token string")
    # All totals are equal: no bucket can be ruled out, ties go by the feature.
    got = m.topfeatures(even, 3, buckets=1024).collect()
    assert [tuple(r) for r in got] == [("w000", 2), ("w001", 2), ("w002", 2)]
    assert m.topfeatures(even.limit(0), 3, buckets=8).count() == 0
    nulls = spark.createDataFrame([("a", 3), (None, 5), ("b", None)], "feature string, n long")
    want = [tuple(r) for r in m.topfeatures(nulls, 3).collect()]
    assert [tuple(r) for r in m.topfeatures(nulls, 3, buckets=8).collect()] == want
    with pytest.raises(ValueError):
        m.topfeatures(even, 3, buckets=0)


def test_few_features_are_counted_by_themselves(spark):
    """Of a large vocabulary with frequent words only those reach the second count."""
    words = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("top"), F.col("id") % 10))
        .otherwise(F.concat(F.lit("rare"), F.col("id")))
        .alias("token")
    )
    left = features._candidates(words, F.col("token"), F.lit(1), 5, 1 << 14)
    assert left.select("token").distinct().count() < 200
    assert m.topfeatures(words, 5, buckets=1 << 14).collect() == m.topfeatures(words, 5).collect()


def test_vectors_are_one_row_unless_a_width_is_given(spark):
    rows, df = skewed(spark)
    got = m.dfm_vectors(m.dfm(df)).collect()
    assert len(got) == len({r.doc_id for r in got}) and {r.block for r in got} == {0}
    assert sum(len(r.indices) for r in got) == m.dfm(df).count()


@pytest.mark.parametrize("per_block", [7, 1000])
def test_vectors(spark, per_block):
    rows, df = skewed(spark)
    table = m.dfm(df)
    index = {r.feature: r.feature_index for r in features.feature_index(table).collect()}
    docs = df.select("doc_id").union(spark.createDataFrame([("empty",)], "doc_id string")).distinct()
    got = m.dfm_vectors(table, docs=docs, features_per_block=per_block).collect()
    cells = {}
    for r in got:
        assert r.indices == sorted(r.indices) and len(r.indices) == len(r["values"]) <= per_block
        assert {i // per_block for i in r.indices} <= {r.block}
        for i, n in zip(r.indices, r["values"]):
            assert cells.setdefault((r.doc_id, i), n) == n
    want = Counter((d, index[t]) for d, _, _, t in rows)
    assert cells == want
    assert [(r.block, r.indices) for r in got if r.doc_id == "empty"] == [(0, [])]


def test_vectors_from_stored_tables(spark, tmp_path):
    _, df = skewed(spark, 300)
    m.dfm(df).write.parquet(str(tmp_path / "dfm"))
    table = spark.read.parquet(str(tmp_path / "dfm"))
    features.feature_index(table).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = m.dfm_vectors(table, index)
    assert got.select(F.sum(F.aggregate("values", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] == 300


def test_word_filter_rules_out_all_but_a_few(spark):
    """Rows that are shuffled: the listed words and a false share of about one in 32."""
    words = spark.range(20_000).selectExpr("concat('s', id) AS word")
    df = spark.range(60_000).selectExpr("concat(if(id % 3 = 0, 's', 't'), id) AS token", "id AS _cell")
    bits = skew.filter_bits(20_000)
    assert bits == 1 << 20
    table = skew.word_filter(words, "word", bits)
    assert table.count() == bits // 32768 and table.selectExpr("max(size(_filter_words)) n").first().n == 512
    maybe, other = skew.suspects(df, df["token"], table, bits)
    listed = {f"s{i}" for i in range(0, 20_000) if i % 3 == 0}
    found = {r.token for r in maybe.collect()}
    assert listed <= found and len(found) - len(listed) < 60_000 / 25
    assert maybe.count() + other.count() == 60_000 and maybe.columns == df.columns


def test_large_list_shuffles_suspects_only(spark):
    words = spark.range(5000).selectExpr("concat('W', id) AS word")
    df = spark.createDataFrame(
        [(t,) for t in ["w1", "W2", "W2", "x", "x", "", None, None, "w5000"] * 3], "token string"
    )
    left = m.remove_stopwords(df, words, broadcast_rows=100)
    got = sorted((r.token for r in left.collect()), key=str)
    assert got == sorted(["x", "x", "", None, None, "w5000"] * 3, key=str)
    plan = left._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union") :]
    before, after = union.split("SortMergeJoin", 1)
    assert "Exchange hashpartitioning(lower(token" not in before
    assert "Exchange hashpartitioning(lower(token" in after


def test_filter_size_is_bounded():
    assert skew.filter_bits(0) == skew.filter_bits(1) == 1 << 15
    assert skew.filter_bits(10**12) == skew.MAX_BITS
    assert skew.filter_bits(1 << 20) == 1 << 25
