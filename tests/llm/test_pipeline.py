"""The stages of the pipeline, each against a plain version on what the one before kept."""

import hashlib

import numpy as np
import public_tokenizers
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline as cp
from morphloom.llm import langid, pieces
from morphloom.llm.common import keep, read

SF = "/root/testdata/sf0.001"


def left_of(docs, length=50):
    """(doc_id, text) after removing strings that a smaller doc_id has."""
    least = {}
    raw = {d: t.encode() for d, t in docs}
    for d, t in raw.items():
        for s in range(len(t) - length + 1):
            w = t[s : s + length]
            least[w] = min(d, least.get(w, d))
    out = {}
    for d, t in raw.items():
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if least[t[s : s + length]] < d:
                gone[s : s + length] = True
        text = bytes(b for b, g in zip(t, gone) if not g).decode(errors="ignore")
        if text.encode().split():
            out[d] = text
    return out


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns, stage = docs.columns, {}
    before = {r.doc_id: r for r in docs.collect()}
    for name, f in cp.STAGES[:-1]:
        docs = keep(f(spark, docs, SF))
        assert docs.columns == columns
        stage[name] = {r.doc_id: r for r in docs.collect()}
    known, unlike, bare, mixed = stage.values()

    assert len(known) >= 0.98 * len(before)
    rows = [(d, brute_fingerprint(r.text)) for d, r in known.items()]
    assert set(unlike) == {c for _, _, c in brute_components(rows)}
    assert {d: r.text for d, r in bare.items()} == left_of([(d, r.text) for d, r in unlike.items()])
    assert all(r.n_chars == len(r.text) for r in bare.values())

    labels = {r.doc_id: r for r in read(spark, SF, "labels").collect()}
    clean = {d for d in bare if d in labels and labels[d].quality == 1 and labels[d].toxic == 0}
    assert len(clean & set(mixed)) >= 0.98 * len(clean)
    toxic = {d for d in bare if d in labels and labels[d].toxic == 1}
    assert len(toxic & set(mixed)) <= 0.5 * len(toxic)

    model = pieces.Chunks(public_tokenizers.path("piece_bpe_32k.model")).model
    got = {r.doc_id: r for r in cp.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(got) == set(mixed)
    for d, r in mixed.items():
        ids = model.encode(r.text, add_bos=True, add_eos=True)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_stages_take_empty_tables(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, f in cp.STAGES:
        docs = keep(f(spark, docs, SF))
        assert docs.collect() == []


def test_rejected_languages(spark):
    docs = read(spark, SF, "documents")
    odd = spark.createDataFrame([(10**6, "12 || 34", "en", "s", 8), (10**6 + 1, None, "en", "s", None)], docs.schema)
    kept = {r.doc_id for r in langid.identified(docs.union(odd)).collect()}
    assert not kept & {10**6, 10**6 + 1}
