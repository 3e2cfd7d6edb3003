"""SentencePiece encoding and decoding with a table of distinct chunks.

If no piece of the vocabulary holds a whitespace marker after another character, no
piece can cross the border between a word and the marker of the next one. A text is
then the sequence of its marked words, each of which is segmented alike wherever it
stands: every distinct one is segmented and decoded once and its ids are joined back by
position. Each task keeps such a table for the texts it reads. The table is emptied
when it holds ``TABLE`` chunks, which costs time but changes nothing. (A table shared
by all tasks would need every word of every text shuffled twice, several times the
size of the texts.)
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from morphloom.llm.common import columns, tidy

MARK = "▁"
TABLE = 1_000_000

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class Chunks:
    """Ids (as little-endian 32-bit integers) and decoded text of marked words.

    A chunk goes by what follows its first marker.
    """

    def __init__(self, model_file: str, limit: int = TABLE):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.model = SentencePieceProcessor(model_file=model_file)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        normal, train = spec.normalizer_spec, spec.trainer_spec
        crossing = any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
        plain = normal.name == "identity" and not normal.precompiled_charsmap
        if (
            crossing
            or not plain
            or not (normal.add_dummy_prefix and normal.escape_whitespaces)
            or normal.remove_extra_whitespaces
            or train.treat_whitespace_as_suffix
        ):
            raise ValueError("pieces of this model may cross the borders of words")
        self.limit = limit
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.before = self.model.encode("a")
        self.skip = len(self.model.decode(self.before))

    def split(self, text: str) -> list[str]:
        if MARK in text or "  " in text or text[:1] == " " or text[-1:] == " ":
            found = _CHUNK.findall(MARK + text.replace(" ", MARK))
            return [c[1:] for c in found]
        return text.split(" ")

    def learn(self, chunks: list[str]) -> None:
        new = list(set(chunks).difference(self.ids))
        if not new:
            return
        if len(self.ids) + len(new) > self.limit:
            self.ids.clear()
            self.texts.clear()
            new = list(set(chunks))
        # an empty text has no ids, but a marker that nothing follows is a piece
        found = [
            ids if chunk else [self.model.piece_to_id(MARK)]
            for chunk, ids in zip(new, self.model.encode(new, num_threads=1))
        ]
        # behind another word the marker shows as a blank
        texts = self.model.decode([self.before + ids for ids in found], num_threads=1)
        for chunk, ids, text in zip(new, found, texts):
            self.ids[chunk] = array("I", ids).tobytes()
            self.texts[chunk] = text[self.skip :]

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids without begin and end, and the text that they decode to."""
        if not text:
            return b"", ""
        chunks = self.split(text)
        self.learn(chunks)
        decoded = "".join(map(self.texts.__getitem__, chunks))
        return b"".join(map(self.ids.__getitem__, chunks)), decoded[1:]


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    + [(n, pa.string()) for n in ("ids_sha256", "decoded_sha256")]
)
_OUTPUT = pa.schema([("ids", pa.binary()), ("decoded", pa.string())])


def encode_decode(
    docs: DataFrame, model_file: str, output: bool = False, limit: int = TABLE
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are those of the library with begin and end ids; they are digested as
    little-endian unsigned 32-bit integers. ``output`` adds ``ids`` in that form and
    ``decoded``. A NULL text counts as empty: it has the begin and end ids and decodes
    to an empty text. A NULL id stays NULL, repeated rows stay repeated, an empty table
    gives an empty result, other columns are ignored.
    """
    schema = pa.schema([*_SCHEMA, *_OUTPUT]) if output else _SCHEMA

    def run(batches):
        table = Chunks(model_file, limit)
        begin, end = (
            np.array([i], "<u4").tobytes() for i in (table.model.bos_id(), table.model.eos_id())
        )
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids, decoded = table.encode_decode(text or "")
                ids = begin + ids + end
                row = [doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest()]
                row.append(hashlib.sha256(decoded.encode()).hexdigest())
                rows.append(row + [ids, decoded] if output else row)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids binary, decoded string" if output else ""
    return columns(docs, "string").mapInArrow(tidy(run), ddl)
