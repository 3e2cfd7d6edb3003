import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from morphloom.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(docs, length=sd.LENGTH):
    """Per row: (doc_id, n_bytes, n_removed, n_spans, sha256) by comparing all strings."""
    least = {}
    ids = [np.inf if d is None else d for d, _ in docs]
    raw = [(t or "").encode() for _, t in docs]
    for d, t in zip(ids, raw):
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            least[w] = min(d, least.get(w, np.inf))
    out = []
    for (doc_id, _), d, t in zip(docs, ids, raw):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if least[t[s : s + length]] < d:
                gone[s : s + length] = True
        spans = sum(bool(gone[i] and (i == 0 or not gone[i - 1])) for i in range(len(t)))
        rest = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def documents():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(20) for _ in range(5)] + ["x" * 120, "ab" * 80, "=" * 51, prose(9)[:50]]
    docs = []
    for i in range(120):
        parts = [prose(rng.randint(0, 30)) for _ in range(3)]
        if i % 2:
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, 3), p[a:])
        docs.append((i, " ".join(parts)))
    docs += [(200 + i, docs[i][1]) for i in range(0, 40, 3)]  # exact copies
    docs += [(300 + i, docs[i][1].replace("a", "b", 2)) for i in range(0, 40, 5)]
    docs += [(400, None), (401, ""), (402, "x" * 49), (403, "x" * 50), (404, "x" * 3000)]
    docs += [(None, docs[1][1]), (5, docs[5][1]), (5, docs[5][1]), (405, prose(4000)), (406, "\0" * 60)]
    docs += [(407, "y\0" + "\0" * 60)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("cells, buckets, hot", [(1, 1, sd.HOT), (3, 5, sd.HOT), (16, 16, 0), (1, 4, 0), (5, 3, 8)])
def test_against_brute_force(spark, cells, buckets, hot):
    docs = documents() + [(2**63 - 1, "own " * 30)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("cell", F.lit("clash"))
    got = sd.remove_repeats(df, cells=cells, buckets=buckets, hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


@pytest.mark.parametrize("hot", [50, sd.HOT])
def test_a_footer_of_very_many_documents(spark, hot):
    """Thirty bytes in a third of the documents, between different neighbours; one
    neighbour in fifty is the same, so some strings around the footer repeat."""
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    after = [noise(60) for _ in range(50)]
    docs = []
    for i in range(3000):
        text = noise(rng.randint(40, 90))
        if i % 3 == 0:
            text += " -- sent from my little phone" + (rng.choice(after) if i % 4 else noise(30))
        docs.append((i, text))
    df = spark.createDataFrame(docs, SCHEMA)
    got = sd.remove_repeats(df, hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_strings_of_a_hot_anchor_are_spread():
    """No bucket gets all strings around a footer, and a string goes out once per cell."""
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    rng = random.Random(5)
    rows = [(i, bytes(rng.randrange(97, 120) for _ in range(60)) + b"=" * 30) for i in range(400)]
    rows += [(i + 1000, t) for i, t in rows]
    docs = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "cell": [0] * len(rows)})
    asked = sd._send_anchors(16)(docs)
    answers = pa.concat_tables(
        sd._find_shared(20)(asked.filter(pa.compute.equal(asked["bucket"], b)))
        for b in set(asked["bucket"].to_pylist())
    )
    sent = sd._send_contexts(16)(docs, answers)
    bodies = [b for b in sent["body"].to_pylist() if b[:1] == b"s"]
    sizes = [len(sd._read_strings(b[1:])[0]) for b in bodies]
    assert len(sizes) == 16 and max(sizes) < sum(sizes) / 4
    strings = {bytes(x) for b in bodies for x in sd._read_strings(b[1:])[1]}
    assert len(strings) == sum(sizes)


def test_equal_contexts_are_compared(monkeypatch):
    """Contexts whose hashes are all equal are still told apart."""
    monkeypatch.setattr(sd, "row_hashes", lambda rows: np.zeros(len(rows), np.uint64))
    rows = np.zeros((6, 88), np.uint8)
    rows[[1, 4, 5], 3] = 7
    first = sd.alike(rows, np.array([5, 5, 5, 6, 5, 5]))
    assert first.tolist() == [0, 1, 2, 3, 4, 4]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sd.remove_repeats(df).collect() == []
    assert sd.deduplicated(df).columns == ["doc_id", "text"]


def test_deduplicated_keeps_columns(spark):
    long = "é" + " ".join(f"word{i}" for i in range(20))
    df = spark.createDataFrame(
        [(1, long, "a", 0), (2, "own start " + long, "b", 0), (3, long, "c", 0), (4, None, "d", 0)],
        "doc_id long, text string, row string, n_chars int",
    )
    rows = {r.doc_id: r for r in sd.deduplicated(df).collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1].text == long and rows[1].row == "a" and rows[1].n_chars == len(long)
    assert rows[2].text == "own start " and rows[2].n_chars == 10


def test_sort_orders_suffixes():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(0, 3, 4000), np.tile([1, 2], 300), np.zeros(500)])
    text = np.concatenate([text, text[100:900], np.zeros(80)]).astype(np.uint8)
    suffixes = rng.permutation(len(text) - 80)
    order, group = sd.deep_shallow_sort(text, suffixes, 50)
    raw = text.tobytes()
    found = [raw[s : s + 50] for s in suffixes[order]]
    assert found == sorted(found)
    for i in range(1, len(found)):
        assert (group[i] == i) == (found[i] != found[i - 1])


def test_messages_do_not_depend_on_shuffle_partitions(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 20 + "the same passage " * 5) for i in range(300)], SCHEMA)
    sent = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plan = sd.remove_repeats(docs)._jdf.queryExecution().analyzed().toString()
            sent.append(re.findall(r"pmod\(xxhash64\(.*?\), (\d+)\)", plan))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sent[0] and sent[0] == sent[1]
    assert sd.shares(0, 6) == (12, 12)
    assert sd.shares(10 * sd.CELL_BYTES, 2) == (10, 10 * sd.CELL_BYTES // sd.BUCKET_BYTES)
