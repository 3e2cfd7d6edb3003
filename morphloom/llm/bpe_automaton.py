"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton accepts exactly one sequence of tokens for every string of bytes: the one
that byte-pair encoding gives. It is compiled from the list of merges. At first one
state has an arc to itself for each byte. Then each merge (u, v) -> uv in turn puts its
gadget in: the state that u leads to is copied without its arc v, all arcs u are led to
the copy, and every state that has an arc u gets an arc uv to where v leads. What was
read as u, v can then only be read as uv.

A copy shares the arcs of the state that it was made from: it holds only the label it
lacks. All arcs of a label lead to one state, so whether a state has an arc follows from
the labels that the state and those it was copied from lack; the answers are kept in a
table of transitions. A word is read from left to right with the vocabulary's trie,
longer arcs first. Every prefix of it is spelled by one accepted sequence only, so a place
in the word has one state, and one from which the end was not reached is not tried again.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from morphloom.llm.common import columns, worker_cache

TABLE = 400_000  # words, and as many transitions, that a worker keeps
PIECES = 1 << 16  # pieces of a text that are looked up at once
_LONG = 1_000_000  # characters of a text whose pieces are not listed at once

# The pre-tokenizer's pattern.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_FAR = re.compile("[԰-\U0010ffff]")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of the vocabulary file stands for: printable ones for
    themselves, the others by the characters behind the first 256, in turn."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _unassigned() -> re.Pattern:
    """Characters that this Python's Unicode tables do not know: the pattern's letters may
    then differ from the library's."""
    ranges, start = [], None
    for cp in range(0x110001):
        new = cp < 0x110000 and unicodedata.category(chr(cp)) == "Cn"
        if new and start is None:
            start = cp
        elif not new and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class Automaton:
    """The automaton of a vocabulary (label of each token id) and its merges, by rank."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.left: dict[int, int] = {}
        self.born: dict[int, int] = {}  # merge that made a label, -1 for a byte
        self.target = {t: 0 for t, label in labels.items() if len(label) == 1}
        self.born = dict.fromkeys(self.target, -1)
        # State 0 is the start. The copies that one label's arcs were led to, one after the
        # other, are a chain: its first state was copied from ``base``.
        self.chain = [-1]
        self.owner: list[int] = []
        self.base: list[int] = []
        self.lacks: list[dict[int, int]] = []  # label: first state of the chain without it
        self.made: list[list[int]] = []  # merges at which the states of a chain were made
        self.states: list[list[int]] = []
        for rank, (u, v, uv) in enumerate(merges):
            if uv in self.born or labels[uv] != labels[u] + labels[v]:
                raise ValueError(f"token {uv} is not made by one merge of its parts")
            if u not in self.target or v not in self.target or not self._arc(self.target[u], v):
                continue  # u is never followed by v, so the merge never takes place
            self._gadget(rank, u, v, uv)
        self.moves: dict[int, bool] = {}
        self.ids = {labels[t]: t for t in self.target}
        self.trie: dict[int, int] = {}
        self.token = [-1]
        for label, t in self.ids.items():
            node = 0
            for byte in label:
                node = self.trie.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = t

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        before = self.target[u]
        copy, chain = len(self.chain), self.chain[before]
        if chain < 0 or self.owner[chain] != u:
            chain = len(self.owner)
            self.owner.append(u)
            self.base.append(before)
            self.lacks.append({})
            self.made.append([])
            self.states.append([])
        self.chain.append(chain)
        self.lacks[chain][v] = copy
        self.made[chain].append(rank)
        self.states[chain].append(copy)
        self.target[u] = copy
        self.left[uv], self.born[uv] = u, rank
        self.target[uv] = before if u == v else self.target[v]

    def _arc(self, state: int, t: int) -> bool:
        """Whether ``state`` has an arc ``t``: neither it nor one that it was copied from
        lacks it, back to the merge that made ``t``, when it had an arc of t's left part."""
        while True:
            chain = self.chain[state]
            if chain < 0:
                return True
            if self.lacks[chain].get(t, state + 1) <= state:
                return False
            rank = self.born[t]
            if rank < self.made[chain][0]:
                state = self.base[chain]
            else:
                last = bisect_right(self.made[chain], rank) - 1
                state = min(state, self.states[chain][last])
                t = self.left[t]

    def encode(self, word: bytes) -> list[int]:
        """The labels of the path that spells ``word``."""
        if word in self.ids:
            return [self.ids[word]]
        if len(self.moves) > TABLE:
            self.moves.clear()
        moves, target, n = self.moves, self.target, len(word)
        at, states, path = [0], [0], []
        ahead, dead = [self._starting(word, 0)], bytearray(n + 1)
        while at[-1] < n:
            state = states[-1]
            while ahead[-1]:
                end, t = ahead[-1].pop()  # the longest first
                if dead[end]:
                    continue
                key = state << 20 | t
                found = moves.get(key)
                if found is None:
                    found = moves[key] = self._arc(state, t)
                if found:
                    at.append(end)
                    states.append(target[t])
                    path.append(t)
                    ahead.append(self._starting(word, end))
                    break
            else:
                dead[at.pop()] = 1
                del states[-1], path[-1], ahead[-1]
        return path

    def _starting(self, word: bytes, begin: int) -> list[tuple[int, int]]:
        """(end, token) of the tokens that stand in ``word`` at ``begin``."""
        trie, token, node, found = self.trie, self.token, 0, []
        for end in range(begin, len(word)):
            node = trie.get(node << 8 | word[end], 0)
            if not node:
                break
            if token[node] >= 0:
                found.append((end + 1, token[node]))
        return found

    def decode(self, ids) -> bytes:
        """What the arcs of ``ids`` are labelled with."""
        return b"".join(map(self.labels.__getitem__, ids))


class Codec(dict):
    """The ids (little-endian 32-bit integers) of pieces of texts, each encoded once."""

    def __init__(self, tokenizer_file: str, limit: int = TABLE):
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, decoder = spec["model"], spec["pre_tokenizer"], spec["decoder"]
        added = spec["added_tokens"]
        if (
            spec["normalizer"]
            or model["type"] != "BPE"
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix"))
            or any(model.get(k) for k in ("end_of_word_suffix", "byte_fallback", "ignore_merges"))
            or (pre["type"], decoder["type"]) != ("ByteLevel", "ByteLevel")
            or pre["add_prefix_space"]
            or not pre.get("use_regex", True)
            or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        ):
            raise ValueError("not a plain byte-level vocabulary")
        byte, vocab = byte_alphabet(), model["vocab"]
        labels = {t: bytes(byte[c] for c in token) for token, t in vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.automaton = Automaton(labels, merges)
        self.added = {a["content"]: a["id"] for a in added}
        self.labels = labels | {t: token.encode() for token, t in self.added.items()}
        found = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(found)})") if found else None
        self.file, self.limit = tokenizer_file, limit
        self.unknown = self.library = None

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[piece] = array("I", self.automaton.encode(piece.encode())).tobytes()
        return ids

    def pieces(self, text: str):
        """Lists of the pieces that the pre-tokenizer cuts ``text`` into."""
        if _FAR.search(text):
            if self.unknown is None:
                self.unknown = _unassigned()
            if self.unknown.search(text):
                if self.library is None:
                    from tokenizers.pre_tokenizers import ByteLevel

                    self.library = ByteLevel(add_prefix_space=False)
                yield [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
                return
        if len(text) < _LONG:
            yield PATTERN.findall(text)
            return
        found = (m.group() for m in PATTERN.finditer(text))
        while part := list(islice(found, PIECES)):
            yield part

    def encode(self, text: str) -> bytes:
        parts = self.cut.split(text) if self.cut else [text]
        out = []
        for part in parts:
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
            elif part:
                out += (b"".join(map(self.__getitem__, p)) for p in self.pieces(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ``ids``; bytes that are no UTF-8 show as U+FFFD."""
        labels = map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(labels).decode("utf-8", "replace")


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    + [(n, pa.string()) for n in ("ids_sha256", "decoded_sha256")]
)
_OUTPUT = pa.schema([("ids", pa.binary()), ("decoded", pa.string())])


def encode_decode(
    docs: DataFrame, tokenizer_file: str, output: bool = False, limit: int = TABLE
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are those of the library without special tokens around them, though a special
    token that stands in a text has its own id; they are digested as little-endian
    unsigned 32-bit integers. ``output`` adds ``ids`` in that form and ``decoded``. A NULL
    text counts as empty: it has no ids and decodes to an empty text. A NULL id stays
    NULL, repeated rows stay repeated, an empty table gives an empty result, other columns
    are ignored. No shuffle: each task works on the rows that it reads, and the automaton
    and the table of pieces, of up to ``limit``, live as long as their worker.
    """
    schema = pa.schema([*_SCHEMA, *_OUTPUT]) if output else _SCHEMA

    def run(batches):
        codec = worker_cache(("bpe", tokenizer_file, limit), lambda: Codec(tokenizer_file, limit))
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(i) for i in range(2))):
                ids = codec.encode(text.as_py() or "")
                decoded = codec.decode(ids)
                row = [doc_id.as_py(), len(ids) // 4, hashlib.sha256(ids).hexdigest()]
                row.append(hashlib.sha256(decoded.encode()).hexdigest())
                rows.append(row + [ids, decoded] if output else row)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids binary, decoded string" if output else ""
    return columns(docs, "string").mapInArrow(run, ddl)
