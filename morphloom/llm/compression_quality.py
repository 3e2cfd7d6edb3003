"""Quality by compression: does a text look more like good or like bad labelled text?

Two zstandard dictionaries are built, from good and from bad texts. A text is
compressed piece by piece with each (so that its own earlier text does not stand in for
a dictionary). The difference of the compressed sizes, divided by the size of the text,
is turned into a probability by a logistic curve that is fitted to labelled texts which
the dictionaries were not built from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from morphloom.llm.common import columns, texts
from morphloom.llm.langid import held_out
from morphloom.llm.training import sample

PER_CLASS = 800  # texts per label; half of them for the dictionaries, half for the curve
PIECE = 1024
DICTIONARY = 110 * 1024
LEVEL = 3
GOOD = 0.7


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(rows: list[bytes]) -> bytes:
    """Trained on the pieces; their text as it is, if there are too few to train on."""
    parts = [p for t in rows for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:]


class Difference:
    def __init__(self, good: bytes, bad: bytes):
        self.pair = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(body: bytes):
        options = {"write_content_size": False, "write_dict_id": False}
        if not body:
            return zstandard.ZstdCompressor(level=LEVEL, **options)
        data = zstandard.ZstdCompressionDict(body)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, **options)

    def __call__(self, text: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, per byte of text."""
        good, bad = self.pair
        saved = 0
        for p in pieces(text):
            saved += len(bad.compress(p)) - len(good.compress(p))
        return saved / max(1, len(text))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the curve for ``x``, by Newton's method with a slight penalty."""
    scale = x.std() or 1.0
    rows = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (weight * (p - y)) + 1e-3 * beta
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """(good dictionary, bad dictionary, slope, offset) from labels outside the held-out
    fold; None if a class has no text."""
    own = labels.where(~held_out(4, 2) & F.col("quality").isin(0, 1))
    own = own.groupBy("doc_id").agg(F.max("quality").alias("label"))
    counts, rows = sample(docs, own, per_class)
    split = {k: [(t or "").encode() for label, t in rows if label == k] for k in (0, 1)}
    if not all(split.values()):
        return None
    built = {k: dictionary(v[::2]) for k, v in split.items()}
    difference = Difference(built[1], built[0])
    rest = {k: v[1::2] or v for k, v in split.items()}
    x = np.array([difference(t) for k in (0, 1) for t in rest[k]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    share = {k: counts[k] / sum(counts.values()) / len(rest[k]) for k in (0, 1)}
    weight = np.where(y > 0, share[1], share[0]) * len(y)
    return built[1], built[0], *logistic(x, y, weight)


def score(docs: DataFrame, model, good: float = GOOD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 if the score is ``good``
    or more).

    Texts are compressed whole. A NULL text counts as empty; an empty one saves nothing
    with either dictionary and has the score of that. Without labelled text of both
    kinds every score is 0.5. A NULL id counts as held out, repeated rows have one score,
    an empty table gives an empty result, other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        difference = model and Difference(*model[:2])
        slope, offset = model[2:] if model else (0.0, 0.0)
        for batch in batches:
            x = np.array([difference(t) if model else 0.0 for t in texts(batch.column(1))], float)
            found = 1 / (1 + np.exp(-np.clip(slope * x + offset, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], schema=schema)

    rows = columns(docs).mapInArrow(run, "doc_id long, score double")
    return rows.select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= good).cast("int").alias("predicted"),
    )
