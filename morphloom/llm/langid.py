"""Language of the words of a text by a linear-chain conditional random field.

The words of a text are a chain of states, one per language. A word speaks for the
languages by features of its letters: its n-grams of two to four bytes, its affixes
(n-grams bound to its start or end) and itself (a lexicon). Learned transitions say how
often neighbouring words change the language; training joins spans of different texts,
so that they are learned for code-switched text. The forward-backward algorithm gives
each word the probabilities of the languages given the whole text; a text has the
language with the largest mean over its words.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from morphloom.llm.common import columns, tidy
from morphloom.llm.training import sample

UNKNOWN = "und"
PER_LANGUAGE = 40  # texts that the model is fitted on
FEATURES = 1 << 16
ROUNDS = 20
SPAN = 12  # mean words of a span of training text
CHAIN = 64  # words of a training chain
TABLE = 300_000  # words whose scores a task keeps
LONG = 2048  # words of a chain from which on it is worked off in segments
REJECT = 0.5

_PIECES = 20_000
_CHARS = 1_500_000  # of the texts that are tagged at once; a longer one is alone
_MULTIPLIERS = [
    [np.uint64(0x9E3779B97F4A7C15 * (16 * n + k + 1) % 2**64 | 1) for k in range(n)] for n in range(5)
]


def letters(word: str) -> bytes:
    """What of a word speaks for its language: its letters, none of the other word signs."""
    word = word.lower()
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).encode()


def _slots(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)).astype(np.int64) % FEATURES


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of all words, one after the other, and which word each belongs to.

    A blank before and behind a word makes its outer n-grams affixes.
    """
    data = np.frombuffer(b"".join(b" " + w + b" " for w in words) + b"\0" * 8, np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(owner))
    slots = [_slots(np.array([zlib.crc32(w) for w in words], np.uint64) + np.uint64(1 << 40))]
    owners = [np.arange(len(words))]
    for n in (2, 3, 4):
        here = at[at + n <= ends]
        h = np.full(len(here), n, np.uint64)
        for k, m in enumerate(_MULTIPLIERS[n]):
            h += data[here + k] * m
            h ^= h >> np.uint64(31)
        slots.append(_slots(h))
        owners.append(owner[here])
    return np.concatenate(slots), np.concatenate(owners)


def scores(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Score of each word for each language; zero for a word without letters."""
    out = np.zeros((len(words), weights.shape[1]))
    for begin in range(0, len(words), _PIECES):
        part = words[begin : begin + _PIECES]
        slots, owner = features(part)
        for l in range(weights.shape[1]):
            out[begin : begin + len(part), l] = np.bincount(owner, weights[slots, l], len(part))
    out[[not w for w in words]] = 0
    return out


def posteriors(
    emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the states of each word given its chain, by forward-backward, and
    the expected number of each transition.

    ``emission`` holds the scores of the chains one after the other. All chains advance
    together, the longest ones alone at the end.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
    move = np.exp(transition - transition.max())
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    forward = np.empty_like(local)
    state = None
    for t in range(steps):
        at = starts[: live[t]] + t
        state = local[at] if t == 0 else (state[: live[t]] @ move) * local[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    expected = np.zeros_like(transition)
    back = np.zeros((len(lengths), local.shape[1]))
    for t in range(steps - 1, -1, -1):
        n = live[t]
        ending = live[t + 1] if t + 1 < steps else 0
        back[ending:n] = 1  # these chains end here
        at = starts[:n] + t
        ahead = back[:n].copy()
        if ending:
            seen = local[at[:ending] + 1] * back[:ending]
            pair = forward[at[:ending]].T @ (
                seen / ((forward[at[:ending]] @ move) * seen).sum(axis=1, keepdims=True)
            )
            expected += pair * move
            ahead[:ending] = seen @ move.T
            ahead[:ending] /= ahead[:ending].sum(axis=1, keepdims=True)
        back[:n] = ahead
        both = forward[at] * ahead
        forward[at] = both / both.sum(axis=1, keepdims=True)
    return forward, expected


def long_posteriors(emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """:func:`posteriors` of the states of one long chain, without a step per word.

    The chain is cut into about as many segments as a segment has words. The segments
    advance together, from every state they may begin in, to the products of their
    transitions; a scan over these gives the probabilities at all borders, from where the
    words of all segments are worked off together again.
    """
    n, k = emission.shape
    size = int(np.sqrt(n)) + 1
    m = -(-n // size)
    move = np.exp(transition - transition.max())
    local = np.ones((m * size, k))
    local[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    local = local.reshape(m, size, k)
    last = n - (m - 1) * size  # words of the last segment
    product = np.broadcast_to(np.eye(k), (m, k, k)).copy()
    for t in range(size):
        here = m if t < last else m - 1
        step = (product[:here] @ move) * local[:here, t, None]
        if t == 0:
            step[0] = np.diag(local[0, 0])  # nothing precedes the first word
        product[:here] = step / step.sum(axis=(1, 2), keepdims=True)
    ahead, behind = np.ones((m, k)), np.ones((m, k))
    for s in range(1, m):
        ahead[s] = ahead[s - 1] @ product[s - 1]
        ahead[s] /= ahead[s].sum()
    for s in range(m - 1, 0, -1):
        behind[s - 1] = product[s] @ behind[s]
        behind[s - 1] /= behind[s - 1].sum()
    forward = np.empty_like(local)
    state = ahead
    for t in range(size):
        step = (state @ move) * local[:, t]
        if t == 0:
            step[0] = local[0, 0]
        state = step / step.sum(axis=1, keepdims=True)
        forward[:, t] = state
    state = behind
    for t in range(size - 1, -1, -1):
        here = m if t < last else m - 1
        both = forward[:here, t] * state[:here]
        forward[:here, t] = both / both.sum(axis=1, keepdims=True)
        step = (local[:here, t] * state[:here]) @ move.T
        state[:here] = step / step.sum(axis=1, keepdims=True)
    return forward.reshape(m * size, k)[:n]


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, transition: np.ndarray):
        self.languages, self.weights, self.transition = languages, weights, transition


def fit(texts: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 5) -> Model | None:
    """The field of largest likelihood for labelled texts (language, text)."""
    languages = sorted({lang for lang, _ in texts})
    place = {lang: i for i, lang in enumerate(languages)}
    rng, spans = random.Random(seed), []
    for lang, text in texts:
        words = [w for w in map(letters, text.split()) if w]
        while words:
            n = 1 + int(rng.expovariate(1 / SPAN))
            spans.append((place[lang], words[:n]))
            words = words[n:]
    if not spans:
        return None
    rng.shuffle(spans)
    index: dict[bytes, int] = {}
    word = np.array([index.setdefault(w, len(index)) for _, s in spans for w in s])
    label = np.repeat([l for l, _ in spans], [len(s) for _, s in spans])
    lengths = np.full(-(-len(word) // CHAIN), CHAIN)
    lengths[-1] = len(word) - CHAIN * (len(lengths) - 1)
    n = len(languages)
    truth = np.zeros((n, n))
    inner = np.arange(1, len(word)) % CHAIN != 0
    np.add.at(truth, (label[:-1][inner], label[1:][inner]), 1)

    slots, owner = features(list(index))
    weights, transition = np.zeros((FEATURES, n)), np.zeros((n, n))
    squares, moves = np.full((FEATURES, n), 1e-6), np.full((n, n), 1e-6)
    for _ in range(rounds):  # AdaGrad on the whole sample
        emission = np.column_stack(
            [np.bincount(owner, weights[slots, l], len(index)) for l in range(n)]
        )[word]
        marginal, expected = posteriors(emission, lengths, transition)
        marginal[np.arange(len(word)), label] -= 1
        for l in range(n):
            per_word = np.bincount(word, marginal[:, l], len(index)) / len(word)
            g = np.bincount(slots, per_word[owner], FEATURES) + 1e-6 * weights[:, l]
            squares[:, l] += g * g
            weights[:, l] -= 0.2 * g / np.sqrt(squares[:, l])
        g = (expected - truth) / len(word) + 1e-4 * transition
        moves += g * g
        transition -= 0.2 * g / np.sqrt(moves)
    return Model(languages, weights.astype(np.float32), transition)


class Tagger:
    """Labels texts, keeping the scores of the distinct words seen so far."""

    def __init__(self, model: Model, limit: int = TABLE):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.emission = np.zeros((1024, len(self.model.languages)), np.float32)
        self.spoken = np.zeros(1024, bool)

    def learn(self, words: set[str]) -> None:
        new = list(words.difference(self.place))
        if self.place and len(self.place) + len(new) > self.limit:
            self.clear()
            new = list(words)
        begin, end = len(self.place), len(self.place) + len(new)
        if end > len(self.spoken):
            room = max(end, 2 * len(self.spoken)) - begin
            self.emission = np.concatenate(
                [self.emission[:begin], np.zeros((room, self.emission.shape[1]), np.float32)]
            )
            self.spoken = np.concatenate([self.spoken[:begin], np.zeros(room, bool)])
        for at, word in enumerate(new, begin):
            self.place[word] = at
        bare = [letters(w) for w in new]
        self.emission[begin:end] = scores(bare, self.model.weights)
        self.spoken[begin:end] = [bool(b) for b in bare]

    def words(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the languages for every word, and which words have letters."""
        self.learn(set().union(*split))
        at = np.fromiter((self.place[w] for words in split for w in words), np.int64)
        lengths = np.array([len(words) for words in split], np.int64)
        emission, transition = self.emission[at].astype(np.float64), self.model.transition
        long = np.flatnonzero(lengths > LONG)
        if not len(long):
            return posteriors(emission, lengths, transition)[0], self.spoken[at]
        found = np.empty_like(emission)
        whole = np.repeat(lengths <= LONG, lengths)
        found[whole] = posteriors(emission[whole], lengths[lengths <= LONG], transition)[0]
        ends = np.cumsum(lengths)
        for i in long:
            chain = slice(ends[i] - lengths[i], ends[i])
            found[chain] = long_posteriors(emission[chain], transition)
        return found, self.spoken[at]

    def texts(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [t.split() for t in texts]
        found, spoken = self.words(split)
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in split])
        n = np.bincount(owner[spoken], minlength=len(texts))
        mean = np.column_stack(
            [np.bincount(owner[spoken], found[spoken, l], len(texts)) for l in range(found.shape[1])]
        ) / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)  # the first language by name if several are best
        return [
            (self.model.languages[b], float(min(1.0, mean[i, b]))) if n[i] else (UNKNOWN, 0.0)
            for i, b in enumerate(best)
        ]


def held_out(folds: int = 5, fold: int = 0) -> Column:
    """Whether a document is kept from training; one without id always is."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit to a sample of ``per_language`` texts of each ``lang`` outside the held-out fold."""
    own = docs.where(~held_out()).select("doc_id", F.col("lang").alias("label"), "text")
    _, rows = sample(own, None, per_language)
    return fit([(lang, text) for lang, text in rows])


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("at", pa.int64())]
)


def _rows(model: Model | None, batches):
    """Language and score of each text, in blocks of a bounded number of words."""
    tagger = model and Tagger(model)

    def tagged(texts):
        return tagger.texts(texts) if tagger else [(UNKNOWN, 0.0)] * len(texts)

    for batch in batches:
        texts, size, out = [], 0, []
        for text in batch.column("text"):
            text = text.as_py() or ""
            if texts and size + len(text) > _CHARS:
                out += tagged(texts)
                texts, size = [], 0
            texts.append(text)
            size += len(text)
        out += tagged(texts) if texts else []
        yield batch, [lang for lang, _ in out], [score for _, score in out]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``score`` is the mean probability of the language over the words with letters. A
    text that is NULL or has no letter is ``und`` with score 0, as is every text if there
    was nothing to learn from. Only the text is an input. Ties go to the first language
    by name. A NULL id counts as held out, repeated rows are predicted alike, an empty
    table gives an empty result, other columns are ignored.
    """
    schema = pa.schema(list(_SCHEMA)[:3])

    def run(batches):
        for batch, langs, found in _rows(model, batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(found, pa.float64())],
                schema=schema,
            )

    rows = columns(docs, "string").mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``reject`` or more."""
    model = train(docs)
    schema = docs.schema

    def run(batches):
        for batch, langs, found in _rows(model, batches):
            good = [lang != UNKNOWN and score >= reject for lang, score in zip(langs, found)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(tidy(run), schema)
