import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from morphloom.llm import bpe_automaton
from morphloom.llm.bpe_automaton import Automaton

FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def merged(word, merges):
    """Byte-pair encoding by definition: every merge in turn, from the left."""
    parts = [bytes([b]) for b in word]
    for a, b in merges:
        out = []
        for p in parts:
            if out and out[-1] == a and p == b:
                out[-1] = a + b
            else:
                out.append(p)
        # a merge's own result is no part of it, so one pass from the left is enough
        parts = out
    return parts


def small(rng, letters=b"ab", n=14):
    """A random list of merges of parts that exist."""
    known, merges = [bytes([b]) for b in letters], []
    while len(merges) < n:
        pair = rng.choice(known), rng.choice(known)
        if b"".join(pair) not in known:
            merges.append(pair)
            known.append(b"".join(pair))
    ids = {label: i for i, label in enumerate(known)}
    return merges, Automaton({i: w for w, i in ids.items()}, [(ids[a], ids[b], ids[a + b]) for a, b in merges])


@pytest.mark.parametrize("seed", range(40))
def test_every_short_word_of_random_merges(seed):
    rng = random.Random(seed)
    merges, automaton = small(rng)
    for n in range(1, 11):
        for k in range(1 << n):
            word = bytes(b"ab"[k >> i & 1] for i in range(n))
            ids = automaton.encode(word)
            assert [automaton.labels[t] for t in ids] == merged(word, merges)
            assert automaton.decode(ids) == word


@pytest.mark.parametrize("seed", range(5))
def test_one_path_per_word(seed):
    """The automaton is deterministic and no other sequence of tokens that spells a word
    has all of its arcs."""
    rng = random.Random(seed)
    _, automaton = small(rng, n=8)

    def paths(word, state):
        if not word:
            return 1
        return sum(
            paths(word[len(label) :], automaton.target[t])
            for label, t in automaton.ids.items()
            if word.startswith(label) and automaton._arc(state, t)
        )

    for _ in range(60):
        assert paths(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))), 0) == 1


def test_one_state_per_merge():
    codec = bpe_automaton.Codec(FILE)
    assert len(codec.automaton.chain) == 1 + 50_000
    assert len(codec.automaton.ids) == 50_256


def odd_texts(n=3000):
    rng = random.Random(2)
    letters = list(" ab.\n\té🙂中0x'sth　\x85\x1c​") + ["<|endoftext|>", "the", "aaaa", "   ", "'re", "\U0003d000", "²"]
    fixed = ["", " ", "  ", " a", "a ", "\n\n", "<|endoftext|>", " <|endoftext|> ", "<|endoftext", "a\x00b", "ﬁ", "½ Ⅷ"]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_against_the_library(spark):
    texts = odd_texts()
    rows = [*enumerate(texts), (None, "no id"), (9000, None), (9001, "word, " * 30000), (1, texts[1]), (1, texts[1])]
    rows += [(9002, "a" * 200_000), (9003, " " * 100_000 + "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    library = Tokenizer.from_file(FILE)
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), raw, decoded))
    got = [(*r[:4], bytes(r[4]), r[5]) for r in bpe_automaton.encode_decode(df, FILE, output=True, limit=300).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    plain = [tuple(r) for r in bpe_automaton.encode_decode(df, FILE).collect()]
    assert sorted(plain, key=str) == sorted((w[:4] for w in want), key=str)


def test_pieces_of_a_long_text_in_blocks(monkeypatch):
    codec = bpe_automaton.Codec(FILE)
    text = "It's 3 o'clock,  isn't it?\n\n " * 300
    whole = codec.encode(text)
    monkeypatch.setattr(bpe_automaton, "_LONG", 100)
    monkeypatch.setattr(bpe_automaton, "PIECES", 7)
    assert codec.encode(text) == whole and codec.decode(whole) == text


def test_parts_of_characters_decode_to_replacements():
    codec, library = bpe_automaton.Codec(FILE), Tokenizer.from_file(FILE)
    for ids in ([10263], [447, 247, 10263], [50256, 220], [156, 128]):
        assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert bpe_automaton.encode_decode(spark.createDataFrame([], SCHEMA), FILE).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe_automaton.Codec(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="one merge"):
        Automaton({0: b"a", 1: b"aa"}, [(0, 0, 1), (0, 0, 1)])
