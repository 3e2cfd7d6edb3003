"""What the vectors write before they are read."""

import os
from urllib.parse import urlparse

import morphloom as m
from morphloom.operators.checkpoints import checkpoint_folder


def test_index_is_not_stored(spark):
    folder = urlparse(checkpoint_folder(spark)).path
    counts = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "doc_id string, feature string, n bigint"
    )
    before = set(os.listdir(folder))
    vectors = m.dfm_vectors(counts)
    # The counts and the vocabulary; the index is read once.
    assert len(set(os.listdir(folder)) - before) == 2
    assert {r.doc_id: sorted(r["values"]) for r in vectors.collect()} == {"a": [1, 2], "b": [3]}
