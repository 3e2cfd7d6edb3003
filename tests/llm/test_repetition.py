import random

import pytest
from pyspark.sql import functions as F

from morphloom.llm import repetition as rp

SCHEMA = "doc_id long, text string"


def split(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    words = split(text)
    n = len(words)

    def found(length):
        seen = {}
        for i in range(n - length + 1):
            seen.setdefault(tuple(words[i : i + length]), []).append(i)
        return [i for at in seen.values() if len(at) > 1 for i in at]

    def cover(length):
        return len({j for i in found(length) for j in range(i, i + length)})

    lines, dup = [], 0
    for line in text.split("\n"):
        if split(line):
            dup += line in lines
            lines.append(line)
    longest = next((k for k in range(n, 0, -1) if found(k)), 0)
    repeated, covered = cover(3), cover(rp.MIN_REPEAT)
    failed = n < 50 or 100 * repeated > 50 * n
    good = covered <= rp.MAX_COVERED * n and longest <= max(rp.LONGEST_FREE, rp.MAX_LONGEST * n)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (n, sum(map(len, words)), symbols, dup, repeated, failed, not failed and good, covered, longest)


def texts():
    rng = random.Random(4)
    out = [None, "", " \n ", "a", "a a", "é\xa0b c", "x " * 120, "a b c " * 40, "#|\n#|\n \n#|"]
    for _ in range(60):
        words = ["w%d" % rng.randrange(rng.choice([3, 20, 400])) for _ in range(rng.randint(1, 150))]
        if rng.random() < 0.5:
            a = rng.randrange(len(words))
            words += words[a : a + rng.randint(1, 60)]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "\v"]) for w in words))
    return out


@pytest.mark.parametrize("batch", [40, 400_000])
def test_against_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(rp, "BATCH", batch)
    rows = [*enumerate(texts()), (None, "x y"), (1, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("clash"))
    got = [tuple(r) for r in rp.quality(df).collect()]
    assert sorted(got, key=str) == sorted(((d, *brute(t)) for d, t in rows), key=str)


def test_verdict():
    long = " ".join(f"w{i}" for i in range(100))
    rng = random.Random(1)
    plain = " ".join(f"v{rng.randrange(10**6)}" for _ in range(300))
    m = rp.measure([long + " " + plain + " " + long])
    assert m["longest_repeat"][0] == 100 and m["n_covered"][0] == 200


def different(name, n):
    return [f"{name}{i}" for i in range(n)]


@pytest.mark.parametrize(
    "passage, around, kept",
    [
        (0, 300, True),
        (10, 300, True),  # 6 % covered
        (240, 520, False),  # 48 % covered, and the base rule passes
        (40, 300, False),  # 21 % covered
        (25, 300, True),  # 14 % covered, shorter than LONGEST_FREE
        (70, 960, False),  # 13 % covered, but the longest repeat is 6 %
        (45, 960, True),
    ],
)
def test_rejects_what_the_base_rule_passes(spark, passage, around, kept):
    same = different("p", passage)
    third = around // 3
    words = different("a", third) + same + different("b", third) + same + different("c", third)
    row = rp.quality(spark.createDataFrame([(1, " ".join(words))], SCHEMA)).first()
    assert not row.base_failed and row.n_covered == (2 * passage if passage else 0)
    assert row.kept == kept


def test_empty_table(spark):
    assert rp.quality(spark.createDataFrame([], SCHEMA)).collect() == []
