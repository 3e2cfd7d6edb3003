"""Exact substring removal: bytes of long strings that an earlier document also holds.

Every string of LENGTH bytes contains an anchor: the least hash among its GRAM-byte
grams, the leftmost if several are equal. Equal strings have equal anchors, so it is
enough to compare strings that share one. The work runs over *cells* of documents
(by a hash of the id) and *buckets* of anchors:

1. each cell sends its distinct anchors (four bytes each) to the buckets, which answer
   with the anchors that other cells have too;
2. each cell sends the contexts of such anchors (the bytes of all strings that have the
   anchor), every distinct context once, with its smallest id; the bucket sorts all
   suffixes of its contexts that start such a string, finds the ones with a common
   prefix of LENGTH bytes, and answers with the starts that an earlier document has;
3. each cell marks and removes the covered bytes of its documents.

A passage that very many documents share is sent once per cell, however many hold it.
An anchor of more than HOT runs, such as one in a footer that very many documents hold
between other neighbours, has too many contexts for one bucket. Its strings are taken by
themselves then: each cell sends every distinct one once, with its smallest id, to the
bucket of the string's own hash.
The texts are shuffled once, to the cells; that exchange serves all three steps.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from morphloom.llm.common import NO_ID, tidy

LENGTH = 50
GRAM = 16
SHALLOW = 16
HOT = 50_000  # runs of an anchor whose contexts one bucket compares
CELL_BYTES = 16_000_000
BUCKET_BYTES = 8_000_000

_SPAN = LENGTH - GRAM + 1  # grams in a string
_CONTEXT = 88  # bytes of a context, padded to words of eight: LENGTH + _SPAN - 1 = 84
_PAD = b"\0" * 128
_CHUNK = 1 << 15  # positions hashed at once, so that the work stays in the cache


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_POWERS = [np.uint64(p) for p in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, by doubling: 1, 2, 4, 8, 16 bytes."""
    h, width = _BYTES[data], 1
    for power in _POWERS:
        h = h[: len(h) - width] * power + h[width:]
        width *= 2
    return _mixed(h)


class Cell:
    """The documents of one cell, one after the other in the order of their ids.

    ``starts`` and ``ends`` bound the documents in ``data``. For each anchor: ``hash``,
    ``first`` (where the first of its strings starts), ``count`` (of its strings, which
    start one byte after the other) and ``doc`` (the document's place).
    """

    def __init__(self, table: pa.Table):
        ids = [NO_ID if x is None else x for x in table.column("doc_id").to_pylist()]
        texts = [x or b"" for x in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.order = order
        self.ids = np.array([ids[i] for i in order], np.int64)
        valid = table.column("doc_id").is_valid().to_pylist()
        self.has_id = [valid[i] for i in order]
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        if lengths.sum() >= 1 << 32:
            raise ValueError("a cell has 4 GB or more: use more cells")
        self.data = np.frombuffer(b"".join([texts[i] for i in order]) + _PAD, np.uint8)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self._anchors()

    def _anchors(self) -> None:
        valid = np.zeros(len(self.data), np.int8)  # whether a string starts here
        long = self.ends - self.starts >= LENGTH
        np.add.at(valid, self.starts[long], 1)
        np.add.at(valid, self.ends[long] - LENGTH + 1, -1)
        valid = np.cumsum(valid, dtype=np.int8).view(bool)
        low = np.uint64(2 * _CHUNK - 1)
        places = np.arange(2 * _CHUNK, dtype=np.uint64)
        runs = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.uint64)]
        for begin in range(0, len(self.data) - LENGTH, _CHUNK):
            at = np.flatnonzero(valid[begin : begin + _CHUNK])
            if not len(at):
                continue
            hashes = gram_hashes(self.data[begin : begin + _CHUNK + LENGTH])
            key = (hashes & ~low) | places[: len(hashes)]
            width = 1
            while width * 2 <= _SPAN:
                key = np.minimum(key[: len(key) - width], key[width:])
                width *= 2
            key = np.minimum(key[: len(key) - (_SPAN - width)], key[_SPAN - width :])
            anchor = (key[at] & low).astype(np.int64)
            new = np.ones(len(at), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
            place = np.flatnonzero(new)
            count = np.diff(np.append(place, len(at)))
            runs[0].append(np.column_stack([at[place] + begin, count, anchor[place] + begin]))
            runs[1].append(hashes[anchor[place]])
        (first, count, anchor), hashes = np.concatenate(runs[0]).T, np.concatenate(runs[1])
        # a run that a chunk's end has cut is one run
        new = np.ones(len(first), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + count[:-1])
        place = np.flatnonzero(new)
        self.hash, self.first = hashes[place], first[place]
        self.count = np.add.reduceat(count, place) if len(place) else count
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def contexts(self, which: np.ndarray) -> np.ndarray:
        """Bytes of all strings of these anchors, padded with zeros."""
        rows = sliding_window_view(self.data, _CONTEXT)[self.first[which]]
        rows[np.arange(_CONTEXT) >= (self.count[which] + LENGTH - 1)[:, None]] = 0
        return rows

    def repeated(self, shared: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Anchors that occur twice here or are ``shared``, and how they are alike.

        Returns the anchors and, for each, the place among them of the first one with
        the same context, which has the smallest id; and whether its hash has more than
        one context here.
        """
        order = np.argsort(self.hash, kind="stable")
        sorted_hash = self.hash[order]
        same = sorted_hash[1:] == sorted_hash[:-1]
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        which = np.flatnonzero(twice if shared is None else twice | shared)
        if not len(which):
            return which, which, np.zeros(0, bool)
        first = alike(self.contexts(which), self.count[which])
        heads = np.flatnonzero(first == np.arange(len(first)))
        _, place, number = np.unique(self.hash[which], return_inverse=True, return_counts=True)
        several = np.bincount(place[heads], minlength=len(number)) > 1
        return which, first, several[place]


    def alike_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of these anchors the place among them of the first one with the same
        context; and the anchors that are the first ones."""
        first = alike(self.contexts(which), self.count[which])
        return first, which[first == np.arange(len(first))]

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct strings of these anchors, in order; their least ids; and for each string
        of each anchor its place among them, its anchor's place in ``which`` and its offset."""
        n = self.count[which].astype(np.int64)
        owner = np.repeat(np.arange(len(which)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        rows = sliding_window_view(self.data, LENGTH)[self.first[which][owner] + offset]
        distinct, place = distinct_rows(rows)
        least = np.full(len(distinct), NO_ID, np.int64)
        np.minimum.at(least, place, self.ids[self.doc[which[owner]]])
        return distinct, least, place, owner, offset


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct strings among rows of LENGTH bytes, and each row's place among them."""
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, LENGTH))).ravel()
    distinct, place = np.unique(whole, return_inverse=True)
    return distinct.view(np.uint8).reshape(-1, LENGTH), place.ravel()


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row, whose length is a multiple of eight."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    total = np.zeros(len(rows), np.uint64)
    for i in range(words.shape[1]):
        word = words[:, i] * _BYTES[0]
        word ^= word >> np.uint64(32)
        total += word * _BYTES[2 * i + 1]
    return _mixed(total)


def alike(rows: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each context the place of the first equal one. Contexts meet by hash and are
    compared; other ones of the same hash may part equal ones, which does no harm."""
    hashes = row_hashes(rows)
    order = np.argsort(hashes, kind="stable")  # the first of equal ones comes first
    words = np.ascontiguousarray(rows).view(np.uint64)
    new = np.ones(len(order), bool)
    new[1:] = np.diff(count[order]) != 0
    for values in (hashes, *words.T):
        value = values[order]
        new[1:] |= value[1:] != value[:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return first


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position, as numbers in the order of the bytes."""
    return sliding_window_view(text, 8)[at].view(">u8")[:, 0].astype(np.uint64)


def _equal_bytes(differ: np.ndarray) -> np.ndarray:
    """Number of leading zero bytes of 64-bit words."""
    # without the bit after the leading one the float cannot be rounded up
    exponent = ((differ & ~(differ >> np.uint64(1))).astype(np.float64).view(np.int64) >> 52) - 1023
    return np.where(differ == 0, 8, 7 - (exponent >> 3))


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int):
    """Length of the common prefix, ``depth`` at most, of suffixes that agree up to ``known``."""
    lcp = known.copy()
    open_ = np.flatnonzero(lcp < depth)
    while len(open_):
        at = lcp[open_]
        equal = _equal_bytes(_words(text, a[open_] + at) ^ _words(text, b[open_] + at))
        at += equal
        lcp[open_] = at
        open_ = open_[(equal == 8) & (at < depth)]
    return np.minimum(lcp, depth)


def deep_shallow_sort(
    text: np.ndarray, suffixes: np.ndarray, depth: int, shallow: int = SHALLOW
) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``suffixes`` by their first ``depth`` bytes, and for each place of it the
    first place whose suffix has the same ``depth`` bytes, which begins an interval of
    common prefixes of ``depth``. ``text`` ends in ``depth`` + 8 spare bytes.

    Shallow: multikey quicksort by words of eight bytes; only suffixes that are equal so
    far are compared by the next word, down to ``shallow`` bytes. Deep: the groups left
    become blind tries, all grown together level by level. A node keeps only the depth
    at which its suffixes first differ, found by their common prefix with one of them,
    and branches by that byte; bytes on the way are never looked at again, so a group of
    equal strings ends at once.
    """
    n = len(suffixes)
    word = _words(text, suffixes)
    order = np.argsort(word, kind="stable")
    group = np.zeros(n, np.int64)  # the first place of the group
    active = _split(group, np.arange(n), group, word[order])
    at = 8
    while at < shallow and len(active):
        word, parent = _words(text, suffixes[order[active]] + at), group[active]
        by = np.lexsort((word, parent))
        order[active] = order[active[by]]
        active = _split(group, active, parent, word[by])
        at += 8
    known = np.full(len(active), at, np.int64)
    while len(active):
        starts = np.flatnonzero(np.diff(group[active], prepend=-1))
        sizes = np.diff(np.append(starts, len(active)))
        here = suffixes[order[active]]
        # all agree up to what the parent knew; the first one stands for the group
        lcp = common_prefix(text, here[np.repeat(starts, sizes)], here, known, depth)
        node = np.repeat(np.minimum.reduceat(lcp, starts), sizes)
        going = node < depth
        active, node, here = active[going], node[going], here[going]
        byte, parent = text[here + node], group[active]
        by = np.lexsort((byte, parent))
        order[active] = order[active[by]]
        left = _split(group, active, parent, byte[by])
        known = node[np.searchsorted(active, left)] + 1
        active = left
    return order, group


def _split(group, active, parent, value):
    """Cut sorted groups where ``value`` changes; returns the places still in company."""
    if not len(active):
        return active
    new = np.ones(len(active), bool)
    new[1:] = (parent[1:] != parent[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(active)))
    group[active] = np.repeat(active[starts], sizes)
    return active[np.repeat(sizes > 1, sizes)]


def earlier_starts(rows: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each context a bit per string: whether a context with a smaller id has it."""
    first = alike(rows, count)
    heads, place = np.unique(first, return_inverse=True)
    text = np.concatenate([rows[heads].ravel(), np.zeros(LENGTH + 8, np.uint8)])
    n = count[heads].astype(np.int64)
    owner = np.repeat(np.arange(len(heads)), n)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    order, group = deep_shallow_sort(text, owner * _CONTEXT + offset, LENGTH)
    least = np.full(len(heads), NO_ID, np.int64)
    np.minimum.at(least, place, ids)
    interval = np.flatnonzero(group == np.arange(len(group)))
    smallest = np.minimum.reduceat(least[owner[order]], interval)
    sizes = np.diff(np.append(interval, len(order)))
    has = np.full((len(heads), _SPAN), NO_ID, np.int64)
    has[owner[order], offset[order]] = np.repeat(smallest, sizes)
    bits = np.zeros((len(ids), 64), bool)
    bits[:, :_SPAN] = has[place] < ids[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bucket and the bounds of each bucket in it."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


_MESSAGE = pa.schema([("bucket", pa.int32()), ("cell", pa.int32()), ("body", pa.binary())])
# What a message of the second step, or its answer, is about.
_CONTEXTS, _STRINGS, _ANCHORS = b"c", b"s", b"a"
_ANSWER = pa.schema([("cell", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())])


def _table(schema: pa.Schema, columns_: list[list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns_, schema.types)], schema=schema)


def _send_anchors(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        cell, out = Cell(docs), [[], [], []]
        hashes, runs = np.unique(cell.hash, return_counts=True)
        order, bounds = _by_bucket(hashes, buckets)
        for b in np.flatnonzero(np.diff(bounds)):
            part = order[bounds[b] : bounds[b + 1]]
            many = np.flatnonzero(runs[part] > 1)
            body = np.uint32(len(part)), hashes[part], many, runs[part][many]
            out[0].append(b)
            out[2].append(b"".join(x.astype(np.uint32).tobytes() for x in body))
        out[1] = [docs.column("cell")[0].as_py()] * len(out[0])
        return _table(_MESSAGE, out)

    return run


def _find_shared(hot: int):
    def run(messages: pa.Table) -> pa.Table:
        parts, runs = [], []
        for body in messages.column("body").to_pylist():
            part = np.frombuffer(body, np.uint32)
            n, part = part[0], part[1:]
            more = part[n:].reshape(2, -1)
            parts.append(part[:n])
            runs.append(np.ones(n, np.int64))
            runs[-1][more[0]] = more[1]
        sizes = np.array([len(p) for p in parts])
        values, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
        order = np.lexsort((owner, values))
        v, o = values[order], owner[order]
        shared = np.zeros(len(v), bool)
        other = (v[1:] == v[:-1]) & (o[1:] != o[:-1])
        shared[1:] |= other
        shared[:-1] |= other
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        total = np.add.reduceat(np.concatenate(runs)[order], starts)
        bits = np.empty((len(v), 2), bool)
        bits[order, 0] = shared
        bits[order, 1] = np.repeat(total, np.diff(np.append(starts, len(v)))) > hot
        bodies = [np.packbits(x).tobytes() for x in np.split(bits, np.cumsum(sizes)[:-1])]
        return _table(
            _ANSWER,
            [messages.column("cell").to_pylist(), messages.column("bucket").to_pylist(), bodies],
        )

    return run


def _send_contexts(buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = [[], [], []]
        if not docs.num_rows:
            return _table(_MESSAGE, out)
        cell = Cell(docs)
        hashes, place = np.unique(cell.hash, return_inverse=True)
        order, bounds = _by_bucket(hashes, buckets)
        known, hot = np.zeros((2, len(hashes)), bool)
        for b, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist()):
            part = order[bounds[b] : bounds[b + 1]]
            bits = np.unpackbits(np.frombuffer(body, np.uint8), count=2 * len(part)) > 0
            known[part], hot[part] = bits.reshape(-1, 2).T
        which, first, several = cell.repeated(known[place])
        send = (first == np.arange(len(first))) & (several | known[place[which]])
        send &= ~hot[place[which]]
        which = which[send]
        rows, count = cell.contexts(which), cell.count[which]
        order, bounds = _by_bucket(cell.hash[which], buckets)
        pack = zstandard.ZstdCompressor(level=1)
        for b in np.flatnonzero(np.diff(bounds)):
            part = order[bounds[b] : bounds[b + 1]]
            kept = np.arange(_CONTEXT) < (count[part] + LENGTH - 1)[:, None]
            body = [
                np.int64(len(part)).tobytes(),
                cell.ids[cell.doc[which[part]]].tobytes(),
                cell.first[which[part]].astype(np.uint32).tobytes(),
                count[part].astype(np.uint8).tobytes(),
                rows[part][kept].tobytes(),
            ]
            out[0].append(b)
            out[2].append(_CONTEXTS + pack.compress(b"".join(body)))
        if hot.any():
            strings, least, *_ = cell.strings(cell.alike_of(np.flatnonzero(hot[place]))[1])
            order, bounds = _strings_by_bucket(strings, buckets)
            for b in np.flatnonzero(np.diff(bounds)):
                part = order[bounds[b] : bounds[b + 1]]
                body = np.int64(len(part)).tobytes() + least[part].tobytes() + strings[part].tobytes()
                out[0].append(b)
                out[2].append(_STRINGS + pack.compress(body))
            # comes back as it is, so that the last step knows the anchors too
            out[0].append(docs.column("cell")[0].as_py() % buckets)
            out[2].append(_ANCHORS + hashes[hot].tobytes())
        out[1] = [docs.column("cell")[0].as_py()] * len(out[0])
        return _table(_MESSAGE, out)

    return run


def _strings_by_bucket(strings: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return _by_bucket(row_hashes(np.pad(strings, ((0, 0), (0, -LENGTH % 8)))), buckets)


def _read_contexts(body: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids = np.frombuffer(raw, np.int64, n, 8)
    first = np.frombuffer(raw, np.uint32, n, 8 + 8 * n)
    count = np.frombuffer(raw, np.uint8, n, 8 + 12 * n).astype(np.int64)
    rows = np.zeros((n, _CONTEXT), np.uint8)
    rows[np.arange(_CONTEXT) < (count + LENGTH - 1)[:, None]] = np.frombuffer(
        raw, np.uint8, offset=8 + 13 * n
    )
    return ids, first, count, rows


def _read_strings(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    strings = np.frombuffer(raw, np.uint8, offset=8 + 8 * n).reshape(n, LENGTH)
    return np.frombuffer(raw, np.int64, n, 8), strings


def _context_answers(bodies: list[bytes]) -> list[bytes]:
    parts = [_read_contexts(x) for x in bodies]
    ids, first, count, rows = (np.concatenate(x) for x in zip(*parts))
    bits = earlier_starts(rows, count, ids)
    bounds = np.cumsum([len(p[0]) for p in parts])[:-1]
    out = []
    for f, m in zip(np.split(first, bounds), np.split(bits, bounds)):
        some = m > 0
        out.append(f[some].tobytes() + m[some].tobytes())
    return out


def _string_answers(bodies: list[bytes]) -> list[bytes]:
    """For each message a bit per string: whether another cell has it with a smaller id."""
    parts = [_read_strings(x) for x in bodies]
    ids, strings = (np.concatenate(x) for x in zip(*parts))
    distinct, place = distinct_rows(strings)
    least = np.full(len(distinct), NO_ID, np.int64)
    np.minimum.at(least, place, ids)
    bounds = np.cumsum([len(p[0]) for p in parts])[:-1]
    return [np.packbits(x).tobytes() for x in np.split(least[place] < ids, bounds)]


_ANSWERS = {_CONTEXTS: _context_answers, _STRINGS: _string_answers, _ANCHORS: list}


def _find_earlier(messages: pa.Table) -> pa.Table:
    cells, buckets, bodies = (messages.column(c).to_pylist() for c in ("cell", "bucket", "body"))
    out = [None] * len(bodies)
    for kind, answers in _ANSWERS.items():
        here = [i for i, body in enumerate(bodies) if body[:1] == kind]
        for i, answer in zip(here, answers([bodies[i][1:] for i in here]) if here else []):
            out[i] = kind + answer
    return _table(_ANSWER, [cells, buckets, out])


def _hot_masks(cell: Cell, answers: list[tuple[int, bytes]], buckets: int) -> tuple[np.ndarray, ...]:
    """The anchors whose strings were compared by themselves, and the bits of those strings
    that an earlier document has."""
    anchors = [b[1:] for _, b in answers if b[:1] == _ANCHORS]
    if not anchors:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    which = np.flatnonzero(np.isin(cell.hash, np.frombuffer(b"".join(anchors), np.uint64)))
    first, heads = cell.alike_of(which)
    strings, least, place, owner, offset = cell.strings(heads)
    order, bounds = _strings_by_bucket(strings, buckets)
    elsewhere = np.zeros(len(strings), bool)
    for b, body in answers:
        if body[:1] == _STRINGS:
            part = order[bounds[b] : bounds[b + 1]]
            elsewhere[part] = np.unpackbits(np.frombuffer(body, np.uint8, offset=1), count=len(part)) > 0
    hit = elsewhere[place] | (least[place] < cell.ids[cell.doc[heads[owner]]])
    bits = np.zeros(len(heads), np.uint64)
    np.bitwise_or.at(bits, owner[hit], np.uint64(1) << offset[hit].astype(np.uint64))
    bits = bits[np.searchsorted(heads, which[first])]
    later = cell.ids[cell.doc[which]] > cell.ids[cell.doc[which[first]]]
    bits[later] = (np.uint64(1) << cell.count[which[later]].astype(np.uint64)) - np.uint64(1)
    return which, bits


def _covered(cell: Cell, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
    """Per byte of the cell whether it is removed."""
    change = np.zeros(len(cell.data) + 1, np.int32)
    bodies = [b[1:] for _, b in answers if b[:1] == _CONTEXTS]
    parts = [(len(b) // 12, b) for b in bodies]
    at = np.concatenate([np.frombuffer(b, np.uint32, n) for n, b in parts] or [np.zeros(0, np.uint32)])
    bits = np.concatenate([np.frombuffer(b, np.uint64, n, 4 * n) for n, b in parts] or [np.zeros(0, np.uint64)])
    order = np.argsort(at)
    at, bits = at[order].astype(np.int64), bits[order]

    mask = np.zeros(len(cell.first), np.uint64)
    mask[np.searchsorted(cell.first, at)] = bits
    which, first, _ = cell.repeated()
    if len(which):
        head = which[first]
        mask[which] = mask[head]
        later = cell.ids[cell.doc[which]] > cell.ids[cell.doc[head]]
        mask[which[later]] = (np.uint64(1) << cell.count[which[later]].astype(np.uint64)) - np.uint64(1)
    hot, bits = _hot_masks(cell, answers, buckets)
    mask[hot] = bits
    for offset in range(_SPAN):
        hit = cell.first[(mask >> np.uint64(offset)) & np.uint64(1) > 0] + offset
        change[hit] += 1  # starts of one offset are distinct
        change[hit + LENGTH] -= 1
    return np.cumsum(change[:-1], dtype=np.int32) > 0


_RESULT = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    + [("kept_sha256", pa.string())]
)


def _remove(buckets: int, carry: bool):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows, left, order = [], [], []
        if docs.num_rows:
            cell = Cell(docs)
            order = cell.order
            bodies = zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist())
            covered = _covered(cell, list(bodies), buckets)
            for i, (start, end) in enumerate(zip(cell.starts, cell.ends)):
                gone = covered[start:end]
                rest = cell.data[start:end][~gone].tobytes()
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                id_ = int(cell.ids[i]) if cell.has_id[i] else None
                digest = hashlib.sha256(rest).hexdigest()
                rows.append((id_, int(end - start), int(gone.sum()), spans, digest))
                left.append(rest.decode(errors="ignore") if carry else None)
        out = _table(_RESULT, [list(c) for c in zip(*rows)] or [[] for _ in _RESULT])
        if carry:
            out = out.append_column("left", pa.array(left, pa.string()))
            out = out.append_column("row", docs.column("row").take(pa.array(order, pa.int64())))
        return out

    return run


def shares(size: int, cores: int) -> tuple[int, int]:
    """Cells and buckets for so many bytes of text."""
    return max(2 * cores, -(-size // CELL_BYTES)), max(2 * cores, -(-size // BUCKET_BYTES))


def remove_repeats(
    docs: DataFrame,
    carry: bool = False,
    cells: int | None = None,
    buckets: int | None = None,
    hot: int = HOT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a string of LENGTH bytes that covers it also starts in a
    document with a smaller ``doc_id``; strings are judged on the input and may overlap,
    and none crosses documents. ``carry`` adds ``left``, the text that is left (a
    character cut in part goes from it as a whole), and ``row``, the row of ``docs``.

    ``cells``, ``buckets`` and ``hot`` (runs of an anchor whose contexts are compared
    together) bound what a task holds and never change the result. By default there is
    a cell per CELL_BYTES and a bucket per BUCKET_BYTES of text, which is summed up when the
    plan is built, and at least two per core. Every cell may send a message to every bucket,
    so their number grows with the square of the input, and does not depend on
    ``spark.sql.shuffle.partitions``.

    A NULL text counts as empty. A NULL id counts as larger than any other (but 2^63 - 1,
    with which it is equal). Rows with the same id count as one document's parts: none
    removes bytes of another. An empty table gives an empty result; other columns are
    ignored.
    """
    if cells is None or buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
        most_cells, most_buckets = shares(size, docs.sparkSession.sparkContext.defaultParallelism)
        cells, buckets = cells or most_cells, buckets or most_buckets
    ids, text = F.col("doc_id").cast("long"), F.col("text").cast("binary")
    placed = docs.select(
        # with the text, so that an id that very many rows have is spread over the cells
        F.pmod(F.xxhash64(ids, text), F.lit(cells)).cast("int").alias("cell"),
        ids.alias("doc_id"),
        text.alias("text"),
        *([F.struct(*[c for c in docs.columns if c != "text"]).alias("row")] if carry else []),
    )
    message, answer = "bucket int, cell int, body binary", "cell int, bucket int, body binary"
    anchors = placed.groupBy("cell").applyInArrow(tidy(_send_anchors(buckets)), message)
    shared = anchors.groupBy("bucket").applyInArrow(tidy(_find_shared(hot)), answer)
    contexts = (
        placed.groupBy("cell")
        .cogroup(shared.groupBy("cell"))
        .applyInArrow(tidy(_send_contexts(buckets)), message)
    )
    earlier = contexts.groupBy("bucket").applyInArrow(tidy(_find_earlier), answer)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if carry:
        result += f", left string, row {placed.schema['row'].dataType.simpleString()}"
    return (
        placed.groupBy("cell")
        .cogroup(earlier.groupBy("cell"))
        .applyInArrow(tidy(_remove(buckets, carry)), result)
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings taken out of their texts, and ``n_chars``, if
    there is one, brought up to date.

    A document none of whose words is left goes, as does one without text.
    """
    done = remove_repeats(docs, carry=True)
    values = {
        c: F.col("left") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns
    }
    if "n_chars" in values:
        values["n_chars"] = F.char_length("left").cast(docs.schema["n_chars"].dataType)
    return done.where(F.col("left").rlike(r"[^\x20\x09-\x0D]")).select(
        *[v.alias(c) for c, v in values.items()]
    )


# The rows of :func:`remove_repeats`: bytes as pairs of hex digits, strings as their text.
SQL = f"""
  WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {NO_ID}) AS id,
           lower(hex(encode(coalesce(text, '')))) AS bytes,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
  ),
  strings AS MATERIALIZED (
    SELECT r, id, i, substr(bytes, 2 * i + 1, {2 * LENGTH}) AS string
    FROM (SELECT r, id, bytes, unnest(generate_series(0, n - {LENGTH})) AS i FROM d)
  ),
  least AS (SELECT string, min(id) AS least FROM strings GROUP BY string),
  starts AS (
    SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -{LENGTH + 1}) + {LENGTH} AS new
    FROM strings JOIN least USING (string) WHERE least < id
  ),
  spans AS MATERIALIZED (
    SELECT r, min(i) AS a, max(i) + {LENGTH} AS b
    FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS span FROM starts)
    GROUP BY r, span
  ),
  left_ AS (  -- what is before each span and behind the last
    SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS begin_
    FROM (SELECT * FROM spans UNION ALL SELECT r, n, n FROM d)
  ),
  kept AS (
    SELECT r, string_agg(substr(bytes, 2 * begin_ + 1, 2 * (a - begin_)), '' ORDER BY a, begin_) AS bytes
    FROM left_ JOIN d USING (r) GROUP BY r
  )
  SELECT doc_id, CAST(n AS BIGINT) AS n_bytes,
         CAST(coalesce((SELECT sum(b - a) FROM spans s WHERE s.r = d.r), 0) AS BIGINT) AS n_removed,
         (SELECT count(*) FROM spans s WHERE s.r = d.r) AS n_spans,
         sha256(unhex(kept.bytes)) AS kept_sha256
  FROM d JOIN kept USING (r)"""
