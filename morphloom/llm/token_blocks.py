"""Token ids in files of patched frame-of-reference blocks.

A file is a *segment* of consecutive documents. Its ids are cut into blocks. Of each
block the minimum is subtracted; the rest is packed at the width that fits a given
share (``PERCENTILE``) of its values, and the values that need more are kept in a list
of exceptions, by position. All numbers are little-endian:

    magic "PFOR0001", u32 ids per block, u64 ids, u32 blocks, u32 documents
    u64 per block: where it starts, counted from the first block
    per document: u8 whether it has an id; i64 id; u64 number of ids (three lists)
    per block: u32 minimum, u8 width, u16 exceptions, packed low bits,
        u16 position and u32 value of each exception (two lists)

Files are written and read by Spark (one row of bytes is one file, closed by a line
feed), so any store that Spark writes to will do, and its committer leaves no file of a
failed task. Their order is that of the part and file numbers in their names.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from morphloom.llm.common import Remembered, columns, keep, shared_folder, tidy, worker_cache

MAGIC = b"PFOR0001"
BLOCK = 512
PERCENTILE = 0.9
SEGMENT = 1 << 24  # ids after which a file is closed, with the document that reaches it
TABLE = 400_000  # words whose ids a worker keeps, and as many older ones
LONG = 32  # characters of the longest word that is kept
PIECE = 1 << 20  # characters after which a text is cut, at a blank
END = 2
BEGIN = 64  # characters of a text that tell where it goes among those of its id

_HEAD = "<8sIQII"
_BLOCK = "<IBH"
_BLOCK_SIZE = struct.calcsize(_BLOCK)
_GROUP = 512  # blocks packed at once
_AHEAD = 128  # blocks whose ids are gathered before they are packed, or read at once


# What the byte-level alphabet shows a byte as: itself if it is printable, else a
# character behind the first 256, in turn.
_SHOWN = dict.fromkeys([*range(33, 127), *range(161, 173), *range(174, 256)])
_ALPHABET = {b: b for b in _SHOWN} | {
    b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _SHOWN)
}
_PARTS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
_CLOSING = tuple(".,;:!?")
_PLAIN = re.compile("[A-Za-zß-öø-ÿ]+")
# The pre-tokenizer's pattern for the characters that _KINDS knows, in lower case
_PIECES = re.compile(" ?+([a-zß-öø-ÿ]++|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ a-z0-9ß-öø-ÿ]++)")
_STOPS = ",."
# What a byte of Latin-1 is: " " blank, "a" letter or digit, "." one of _STOPS, "s" another
# sign, "?" unknown here (what NFC or another Unicode version may see otherwise, too)
_KINDS = bytes(
    ord(" " if c == " " else "." if c in _STOPS else "a" if c.isalnum() else "s")
    if c.isascii() and c.isprintable() or "À" <= c and c not in "×÷"
    else ord("?")
    for c in map(chr, range(256))
)


def _cut(text: str) -> list[str]:
    """Words of a text without white space but blanks.

    ASCII and Latin letters are cut at the pre-tokenizer's pieces, in lower case. That takes
    no pattern where full stops and commas have no other sign beside them.
    """
    try:
        kinds = text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return text.split(" ")
    if b"?" in kinds or "<|" in text:  # the latter may be an added token
        return text.split(" ")
    text = text.lower()
    if b".." in kinds or b".s" in kinds or b"s." in kinds:
        return _PIECES.findall(text)
    for stop in _STOPS:
        text = text.replace(stop, f" {stop} ")
    return text.split()


class Words(Remembered):
    """Ids (as little-endian 32-bit integers) of words, each encoded once.

    The pre-tokenizer drops white space and no token crosses it, so the ids of a text are
    those of its words between blanks, or of what :func:`_cut` makes of these. Runs of
    letters, single digits and runs of other signs are pieces of their own, as are signs
    after a letter, and a word of plain letters is one piece for the model, once it is in
    lower case. Words of over ``LONG`` characters are encoded each time, so that the table
    is bounded whatever the texts hold between blanks.
    """

    def __init__(self, tokenizer_file: str, limit: int = TABLE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenize = self.tokenizer.model.tokenize
        super().__init__(limit)

    def make(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.tokenize(word.lower())]).tobytes()
        if word.isascii() and word.isprintable() and "'" not in word and "<" not in word:
            parts = _PARTS.findall(word.lower())
            if len(parts) > 1:
                return b"".join([self[part] for part in parts])
            return array("I", [t.id for t in self.tokenize(word)]).tobytes()
        elif word[-1:] in _CLOSING and _PLAIN.fullmatch(word, 0, len(word) - 1):
            return self[word[:-1]] + self[word[-1]]
        elif _PLAIN.fullmatch(word):
            shown = word.lower().encode().decode("latin-1").translate(_ALPHABET)
            return array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        return self.make(word) if len(word) > LONG else super().__missing__(word)

    def pieces(self, text: str) -> Iterator[bytes]:
        """The ids of a text, some ``PIECE`` characters at a time."""
        for blank in "\n\t\r":
            text = text.replace(blank, " ")
        begin = 0
        while begin <= len(text):
            end = text.find(" ", begin + PIECE)
            if end < 0:
                end = len(text)
            yield b"".join(map(self.__getitem__, _cut(text[begin:end])))
            begin = end + 1

    def encode(self, text: str) -> bytes:
        return b"".join(self.pieces(text))


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, ``width`` low bits each, as rows of bytes."""
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(*values.shape, 4), axis=2)
    return np.packbits(bits[:, :, 32 - width :].reshape(len(values), -1), axis=1)


def _unpacked(rows: np.ndarray, width: int, block: int) -> np.ndarray:
    """The reverse of :func:`_packed`: of each value the eight bytes from its first one on."""
    rows = np.pad(rows, ((0, 0), (0, 8)))
    bit = np.arange(block) * width
    eight = np.ndarray((len(rows), rows.shape[1] - 7), ">u8", rows, 0, (rows.shape[1], 1))
    found = eight[:, bit >> 3].astype(np.uint64) >> (64 - width - (bit & 7)).astype(np.uint64)
    return (found & np.uint64((1 << width) - 1)).astype(np.uint32)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of ``ids``; the last is filled up with its own last value."""
    if not len(ids):
        return []
    short = -len(ids) % block
    rows = np.concatenate([ids, np.full(short, ids[-1])]).astype(np.uint32).reshape(-1, block)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    at = min(block - 1, int(np.ceil(percentile * block)) - 1)
    fitting = np.partition(rows, at, axis=1)[:, at].astype(np.float64)
    width = np.frexp(fitting)[1].astype(np.int64)  # bits of the value
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        for begin in range(0, len(which), _GROUP):
            part = which[begin : begin + _GROUP]
            values = rows[part]
            low = _packed(values, int(w)) if w else np.zeros((len(part), 0), np.uint8)
            row, position = np.nonzero(values.astype(np.uint64) >> np.uint64(w))
            bounds = np.searchsorted(row, np.arange(len(part) + 1))
            exceptions, position = values[row, position], position.astype("<u2")
            for i, b in enumerate(part):
                own = slice(bounds[i], bounds[i + 1])
                out[b] = b"".join(
                    (
                        struct.pack(_BLOCK, int(least[b]), int(w), bounds[i + 1] - bounds[i]),
                        low[i].tobytes(),
                        position[own].tobytes(),
                        exceptions[own].astype("<u4").tobytes(),
                    )
                )
    return out


class Packing:
    """A file in the making: ids are packed as they come, so that few of them wait as numbers."""

    def __init__(self, block: int = BLOCK, percentile: float = PERCENTILE):
        self.block, self.percentile = block, percentile
        self.has, self.doc_ids, self.counts = bytearray(), array("q"), array("Q")
        self.blocks: list[bytes] = []
        self.waiting: list[bytes] = []
        self.n_ids = self.n_waiting = 0

    def add(self, doc_id: int | None, pieces: Iterable[bytes]) -> None:
        """A document, its ids as little-endian 32-bit integers."""
        before = self.n_ids
        for piece in pieces:
            self.waiting.append(piece)
            self.n_ids += len(piece) // 4
            self.n_waiting += len(piece) // 4
            if self.n_waiting >= _AHEAD * self.block:
                self._pack(self.n_waiting // self.block * self.block)
        self.has.append(doc_id is not None)
        self.doc_ids.append(doc_id or 0)
        self.counts.append(self.n_ids - before)

    def _pack(self, n: int) -> None:
        raw = b"".join(self.waiting)
        self.blocks += pack(np.frombuffer(raw, "<u4", n), self.block, self.percentile)
        self.waiting, self.n_waiting = [raw[4 * n :]], self.n_waiting - n

    def file(self) -> bytes:
        self._pack(self.n_waiting)
        starts = np.cumsum([0, *map(len, self.blocks)])[:-1]
        sizes = self.n_ids, len(self.blocks), len(self.counts)
        return b"".join(
            [
                struct.pack(_HEAD, MAGIC, self.block, *sizes),
                starts.astype("<u8").tobytes(),
                self.has,
                np.array(self.doc_ids, "<i8").tobytes(),
                np.array(self.counts, "<u8").tobytes(),
                *self.blocks,
            ]
        )


def write_segment(
    doc_ids: list[int | None], counts: list[int], ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE
) -> bytes:
    packing = Packing(block, percentile)
    ends = np.cumsum(counts)
    for doc_id, n, end in zip(doc_ids, counts, ends):
        packing.add(doc_id, [ids[end - n : end].astype("<u4").tobytes()])
    return packing.file()


def segments(docs: Iterable[tuple], table: Words, end: int = END, segment: int = SEGMENT) -> Iterator[bytes]:
    """The files of some documents (id, text), in their order; ids are ``None`` or numbers."""
    closing = np.array([end], "<u4").tobytes()
    packing = Packing()
    for doc_id, text in docs:
        packing.add(doc_id, itertools.chain(table.pieces(text or ""), [closing]))
        if packing.n_ids >= segment:
            raw, packing = packing.file(), Packing()
            yield raw
    if packing.counts:
        yield packing.file()


class Segment:
    """A file, read: its documents at once, its ids by block. ``raw`` is any buffer."""

    def __init__(self, raw):
        magic, self.block, self.n_ids, n_blocks, n_docs = struct.unpack_from(_HEAD, raw)
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        self.raw, at = raw, struct.calcsize(_HEAD)

        def numbers(kind, n):
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += found.nbytes
            return found

        self.starts = numbers("<u8", n_blocks)
        has, ids = numbers(np.uint8, n_docs), numbers("<i8", n_docs)
        self.ids_of_docs = pa.array(ids, pa.int64(), mask=has == 0)
        self.counts = numbers("<u8", n_docs).astype(np.int64)
        self.body = at

    @property
    def doc_ids(self) -> list[int | None]:
        return self.ids_of_docs.to_pylist()

    def blocks(self, which: np.ndarray) -> np.ndarray:
        """Ids of some blocks, a row each; the index leads to them."""
        heads = [struct.unpack_from(_BLOCK, self.raw, self.body + int(self.starts[b])) for b in which]
        out = np.zeros((len(which), self.block), np.uint32)
        widths = np.array([h[1] for h in heads], np.int64)
        data = [self.body + int(self.starts[b]) + _BLOCK_SIZE for b in which]
        for w in np.unique(widths):
            size = (self.block * int(w) + 7) // 8
            mine = np.flatnonzero(widths == w)
            for begin in range(0, len(mine) if w else 0, _GROUP):
                part = mine[begin : begin + _GROUP]
                rows = np.stack([np.frombuffer(self.raw, np.uint8, size, data[i]) for i in part])
                out[part] = _unpacked(rows, int(w), self.block)
            for i in mine:
                if n := heads[i][2]:
                    position = np.frombuffer(self.raw, "<u2", n, data[i] + size)
                    out[i, position] = np.frombuffer(self.raw, "<u4", n, data[i] + size + 2 * n)
        return out + np.array([h[0] for h in heads], np.uint32)[:, None]

    def ids(self) -> np.ndarray:
        return self.blocks(np.arange(len(self.starts))).ravel()[: self.n_ids].astype("<u4")

    def checksums(self) -> np.ndarray:
        """crc32 of the ids of each document; few blocks are unpacked at a time."""
        ends, sums, doc = np.cumsum(self.counts), np.zeros(len(self.counts), np.int64), 0
        for first in range(0, len(self.starts), _AHEAD):
            start = first * self.block
            which = np.arange(first, min(first + _AHEAD, len(self.starts)))
            ids = self.blocks(which).ravel()[: self.n_ids - start].astype("<u4", copy=False)
            at = 0
            while at < len(ids):
                till = min(int(ends[doc]) - start, len(ids))
                sums[doc] = zlib.crc32(ids[at:till], int(sums[doc]))
                doc += till == ends[doc] - start
                at = till
        return sums

    def document(self, i: int) -> np.ndarray:
        """Ids of one document, from the blocks that hold it."""
        start, end = int(self.counts[:i].sum()), int(self.counts[: i + 1].sum())
        first, last = start // self.block, -(-end // self.block)
        found = self.blocks(np.arange(first, last)).ravel()
        return found[start - first * self.block : end - first * self.block].astype("<u4")


def write(docs: DataFrame, folder: str, tokenizer_file: str, end: int = END, segment: int = SEGMENT) -> None:
    """Encode every text and write the ids, in the order of ``doc_id``, to ``folder``.

    ``end`` is appended to each document. NULL ids come first; rows with one id are in
    the order of their texts. Texts are dealt out in ranges of ``doc_id`` and of how they
    begin, so that the texts of an id that very many rows share are dealt out, too.
    """

    def run(batches):
        table = worker_cache(("words", tokenizer_file), lambda: Words(tokenizer_file))
        docs = ((d.as_py(), t.as_py()) for batch in batches for d, t in zip(*batch.columns))
        for raw in segments(docs, table, end, segment):
            yield pa.RecordBatch.from_pydict({"segment": [raw]})

    begin = F.substring("text", 1, BEGIN)
    ordered = columns(docs, "string").repartitionByRange("doc_id", begin)
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(tidy(run), "segment binary")
    as_rows = files.select(F.col("segment").cast("string").alias("value"))
    as_rows.write.option("maxRecordsPerFile", 1).text(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of its ids as little-endian 32-bit integers)."""
    schema = pa.schema(
        [("part", pa.int64()), ("file", pa.int64()), ("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in ("within", "n_tokens", "ids_crc32")]
    )

    def run(batches):
        for batch in batches:
            for path, raw in zip(*batch.columns):
                place = re.search(r"part-(\d+)-.*?-c(\d+)[^/]*$", path.as_py()).groups()
                segment = Segment(raw.as_buffer())
                n, counts = len(segment.counts), segment.counts
                part, file = (np.full(n, int(x)) for x in place)
                starts = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, pa.int64())
                        for c in (part, file, segment.ids_of_docs, starts, counts, segment.checksums())
                    ],
                    schema=schema,
                )

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    ddl = ", ".join(f"{n} long" for n in schema.names)
    found = keep(files.mapInArrow(tidy(run), ddl))
    # one row per file, then one per part: small tables
    sizes = found.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("base"))
    offsets = sizes.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).join(parts, "part")
    offsets = offsets.select("part", "file", (F.col("base") + F.col("skip")).alias("base"))
    return found.join(offsets, ["part", "file"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer_file: str, folder: str | None = None, **options) -> DataFrame:
    """Write the ids of ``docs`` to files and describe the documents from what they hold.

    A NULL text counts as empty and has the end id only; repeated rows are documents of
    their own; an empty table gives files without documents and an empty result; other
    columns are ignored. The folder is a new one in the shared folder by default.
    """
    folder = folder or shared_folder(docs.sparkSession)
    write(docs, folder, tokenizer_file, **options)
    return read_documents(docs.sparkSession, folder)
