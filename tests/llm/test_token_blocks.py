import random
import sys
import tracemalloc
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from morphloom.llm import token_blocks as tb

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
LETTERS = list(" ab.,'sSreT\n\té🙂中<|́ 　9ΣßİIÿí")


def odd_texts(n=3000):
    rng = random.Random(1)
    fixed = ["", " ", "<|endoftext|>", "a<|endoftext|>.b", "it's.", "...", "a..", ".", "don't, we'LL"]
    return fixed + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_words_encode_as_the_library():
    words = tb.Words(FILE, limit=500)
    for text in odd_texts():
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("percentile", [0.1, 0.9, 1.0])
def test_round_trip_of_blocks(n, percentile):
    rng = random.Random(n)
    ids = np.array([rng.choice([0, 7, 2**32 - 1, rng.randrange(2 ** rng.randint(1, 32))]) for _ in range(n)], "<u4")
    raw = tb.write_segment([None, 5], [n // 3, n - n // 3], ids, percentile=percentile)
    segment = tb.Segment(raw + b"\n")
    assert segment.ids().tolist() == ids.tolist()
    assert segment.doc_ids == [None, 5]
    assert segment.document(0).tolist() == ids[: n // 3].tolist()
    assert segment.document(1).tolist() == ids[n // 3 :].tolist()


@pytest.mark.parametrize("segment", [50, 1 << 24])
def test_files(spark, segment):
    texts = odd_texts(200)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, "none"), (2000, None), (3, "b"), (3, "a a"), (3, "b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash"))
    got = [tuple(r) for r in tb.round_trip(df, FILE, segment=segment).collect()]
    tokenizer = tb.Words(FILE).tokenizer
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_table(spark):
    assert tb.round_trip(spark.createDataFrame([], SCHEMA), FILE).collect() == []


def test_pieces_of_well_known_characters():
    rng, words = random.Random(4), tb.Words(FILE, limit=500)
    prose = list("  aabBsStT ßÿéÀÞ019,.")
    signs = prose + list(",,''\"-<|_rRvVmMlLdD\n")
    for i in range(9000):
        letters = [prose, signs, signs + list("×÷µª²\xa0\x85\x0b\x7f\u0301’")][i % 3]
        text = "".join(rng.choices(letters, k=rng.randint(1, 25)))
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want, repr(text)


def held(words):
    tables = [words, words.old]
    return sum(map(sys.getsizeof, tables)) + sum(sys.getsizeof(x) for t in tables for kv in t.items() for x in kv)


def test_table_of_words_stays_small():
    rng, words = random.Random(2), tb.Words(FILE)
    for _ in range(100):
        words.encode(" ".join("".join(rng.choices("abcdefgh", k=10)) for _ in range(10_000)))
    assert held(words) < 100e6


def test_long_words_are_not_kept():
    rng, words = random.Random(3), tb.Words(FILE)
    for _ in range(200):
        long = "".join(rng.choices("abé", k=5000))
        assert np.frombuffer(words.encode(long), "<u4").tolist() == words.tokenizer.encode(long, add_special_tokens=False).ids
    assert held(words) < 100_000


def test_texts_are_cut_at_blanks(monkeypatch):
    monkeypatch.setattr(tb, "PIECE", 5)
    words = tb.Words(FILE)
    for text in odd_texts(500):
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == want, repr(text)
        assert all(len(p) < 400 for p in words.pieces(text))


class Ids:
    """In place of the table of words: a text is its number of ids."""

    def pieces(self, text):
        rng = np.random.default_rng(int(text))
        yield rng.integers(0, 49_000, int(text)).astype("<u4").tobytes()


def test_files_are_packed_and_read_in_little_memory():
    docs = [(i, str(n)) for i, n in enumerate([1, 70_000, 511, 400_000, *range(4000, 5000)])] + [(None, "0")]
    tracemalloc.start()
    try:
        files = list(tb.segments(docs, Ids()))
        packed = tracemalloc.get_traced_memory()[1]
        segment = tb.Segment(files[0])
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        sums = segment.checksums().tolist()
        read = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    n = sum(int(t) + 1 for _, t in docs)
    assert len(files) == 1 and segment.n_ids == n
    assert packed < 8 * n and read < 6 * n
    parts = [b"".join([*Ids().pieces(t), b"\2\0\0\0"]) for _, t in docs]
    assert sums == [zlib.crc32(p) for p in parts]
    counts = [len(p) // 4 for p in parts]
    assert files[0] == tb.write_segment([d for d, _ in docs], counts, np.frombuffer(b"".join(parts), "<u4"))
    assert segment.doc_ids == [d for d, _ in docs]


@pytest.mark.parametrize("counts", [[], [0], [0, 0, 512, 0], [512 * 128, 0, 1], [1, 512 * 300, 0, 7]])
def test_checksums(counts):
    ids = np.arange(sum(counts), dtype="<u4") * 977
    segment = tb.Segment(tb.write_segment([None] * len(counts), counts, ids))
    ends = np.cumsum(counts, dtype=int)
    assert segment.checksums().tolist() == [zlib.crc32(ids[e - n : e].tobytes()) for n, e in zip(counts, ends)]
