"""Mixing documents to target weights of domains, by soft membership.

A classifier fitted to the labelled table gives each document the probabilities of the
domains. Every document gets a rate, how often it is to be taken; the tokens expected
of a domain are the sum of rate * tokens * probability. Projected gradient descent on
the squared distances from the targets finds rates of zero or more: each step sums one
vector of domains over all documents, and the rate of a document follows from its own
probabilities and the steps so far, so nothing but those sums leaves the executors.
"""

from __future__ import annotations

import re
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from morphloom.llm.common import columns, keep, tidy
from morphloom.llm.training import sample

PER_DOMAIN = 400  # labelled texts that the classifier is fitted on
TERMS = 2_000  # words it looks at, those that tell most
MIN_TEXTS = 5
STEPS = 30
TOLERANCE = 1e-3  # largest distance from a target, as a share of it
SPARSE = 5e-4  # penalty of the fit that chooses words
_WORD = re.compile(r"[^\W\d_]+")
_SYMBOLS = "#*$%&|<>!"
SHAPE = 5


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def shape(text: str, n_tokens: int) -> list[float]:
    """Shares of symbols, capitals and different words, and the length."""
    raw = np.frombuffer(text.encode(), np.uint8)
    capitals = np.count_nonzero((raw >= 65) & (raw <= 90)) / max(1, len(raw))
    symbols = sum(map(text.count, _SYMBOLS)) / max(1, len(raw))
    different = len(set(text.split())) / max(1, n_tokens) * np.log1p(n_tokens)
    return [20 * symbols, 5 * capitals, different, np.log1p(n_tokens) / 5, float(n_tokens < 20)]


class Classifier:
    """Multinomial logistic regression on the presence of words and the shape of a text."""

    def __init__(self, domains: list[str], terms: list[str], beta: np.ndarray, prior: np.ndarray):
        self.domains, self.terms, self.beta, self.prior = domains, terms, beta, prior

    def ready(self) -> "Classifier":
        self.place = {t: i for i, t in enumerate(self.terms)}
        return self

    def posterior(self, text: str, n_tokens: int) -> np.ndarray:
        found = [self.place[w] for w in words(text) & self.place.keys()]
        own = np.array([1.0, *shape(text, n_tokens)])
        z = self.beta[found].sum(axis=0) + own @ self.beta[len(self.terms) :] + self.prior
        p = np.exp(z - z.max())
        return p / p.sum()


def descend(x: np.ndarray, target: np.ndarray, rounds: int, sparse: float) -> np.ndarray:
    """Weights of a logistic regression; ``sparse`` is a penalty on a word's weight as such,
    which leaves words that tell little without any."""
    n_words = x.shape[1] - 1 - SHAPE
    beta, squares = np.zeros((x.shape[1], target.shape[1])), np.full((x.shape[1], target.shape[1]), 1e-8)
    for _ in range(rounds):
        z = x @ beta
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - target) / len(x) + 1e-4 * beta
        squares += g * g
        pace = 0.3 / np.sqrt(squares)
        beta -= pace * g
        words_ = beta[:n_words]
        words_[:] = np.sign(words_) * np.maximum(np.abs(words_) - sparse * pace[:n_words], 0)
    return beta


def fit(rows: list[tuple[str, str]], counts: dict[str, int], rounds: int = 200) -> Classifier | None:
    """From (domain, text); ``counts`` of all labelled rows give the prior.

    A first, penalised fit chooses the words; a second one weighs those alone."""
    domains = sorted({d for d, _ in rows})
    if not domains:
        return None
    y = np.array([domains.index(d) for d, _ in rows])
    seen = [words(t) for _, t in rows]
    number: dict[str, np.ndarray] = {}
    for d, ws in zip(y, seen):
        for w in ws:
            number.setdefault(w, np.zeros(len(domains)))[d] += 1
    texts_of = np.bincount(y, minlength=len(domains))
    frequent = sorted(w for w, n in number.items() if n.sum() >= MIN_TEXTS)
    share = np.array([number[w] for w in frequent]).reshape(-1, len(domains))
    mean = share.sum(axis=1) / len(rows)
    spread = ((share / texts_of - mean[:, None]) ** 2).sum(axis=1) / np.maximum(mean, 1e-9)
    terms = [frequent[i] for i in np.argsort(-spread, kind="stable")[:TERMS]]
    place = {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(rows), len(terms) + 1 + SHAPE))
    for i, ((_, text), ws) in enumerate(zip(rows, seen)):
        x[i, [place[w] for w in ws & place.keys()]] = 1
        x[i, len(terms) :] = [1.0, *shape(text, len(text.split()))]
    target = np.eye(len(domains))[y]
    beta = descend(x, target, rounds, SPARSE)
    told = np.abs(beta).sum(axis=1) > 0
    told[len(terms) :] = True
    terms = [t for t, kept in zip(terms, told) if kept]
    beta = descend(x[:, told], target, rounds, 0.0)
    own = np.array([counts[d] for d in domains], float)
    return Classifier(domains, terms, beta, np.log(own / own.sum()) - np.log(texts_of / len(rows)))


def domain() -> Column:
    """Domain of a row of ``labels``: toxic, poor or good."""
    return (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    )


def train(docs: DataFrame, labels: DataFrame, per_domain: int = PER_DOMAIN) -> Classifier | None:
    own = labels.select("doc_id", domain().alias("label")).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts, rows = sample(docs, own, per_domain)
    return fit([(d, t or "") for d, t in rows], counts)


def memberships(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """doc_id, digest of the text, n_tokens (words), p (probability of each domain)."""
    domains = model.domains if model else ["all"]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("digest", pa.int64()), ("n_tokens", pa.int64()), ("p", pa.list_(pa.float64()))]
    )

    def run(batches):
        ready = model and model.ready()
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text").to_pylist():
                n = len(text.encode().split()) if text else 0
                counts.append(n)
                found.append(ready.posterior(text or "", n) if ready else np.ones(len(domains)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(found, schema.field("p").type)],
                schema=schema,
            )

    whole = columns(docs, "string").select("doc_id", F.xxhash64(F.col("text")).alias("digest"), "text")
    return whole.mapInArrow(tidy(run), "doc_id long, digest long, n_tokens long, p array<double>")


def _move(step: list[float]) -> Column:
    return sum((F.col("p")[d] * F.lit(float(x)) for d, x in enumerate(step)), F.lit(0.0))


def rate(history: list[list[float]], most: float | None = None) -> Column:
    """The rate that the steps so far lead to: from 1, never below 0 nor above ``most``."""
    if not history:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in h]) for h in history])
    n = len(history[0])

    def step(r, h):
        move = sum((F.get(F.col("p"), F.lit(d)) * F.get(h, F.lit(d)) for d in range(1, n)), F.get(F.col("p"), F.lit(0)) * F.get(h, F.lit(0)))
        moved = F.greatest(F.lit(0.0), r - move)
        return moved if most is None else F.least(F.lit(float(most)), moved)

    return F.aggregate(steps, F.lit(1.0), step)


def solve(
    members: DataFrame,
    targets: np.ndarray,
    steps: int = STEPS,
    tolerance: float = TOLERANCE,
    most: float | None = None,
) -> list[list[float]]:
    """Steps of projected gradient descent that bring the expected tokens to ``targets``
    with rates of up to ``most``. A warning gives the totals if the steps end too far off.

    The squared distances are taken in the scale of the documents' second moments (the
    inverse of the sum of tokens * p * p'), in which all domains, rare or common,
    overlapping or not, have a curvature of one, and a step of one never overshoots.
    Where documents have come to a bound, the moments of those that can still move allow
    longer steps; one that turns out worse is taken back for the safe one.
    """
    n = len(targets)
    p = [F.col("p")[d] for d in range(n)]
    pairs = [(d, e) for d in range(n) for e in range(d, n)]
    history: list[list[float]] = []
    full = safe = None
    before = np.inf

    def moments(rated: DataFrame, free: Column, totals: list[Column]) -> tuple[np.ndarray, np.ndarray]:
        now = rated.agg(
            *totals, *[F.sum(F.when(free, F.col("n_tokens") * p[d] * p[e])) for d, e in pairs]
        ).first()
        sums = np.array([x or 0.0 for x in now])
        gram = np.zeros((n, n))
        for (d, e), x in zip(pairs, sums[len(totals) :]):
            gram[d, e] = gram[e, d] = x
        return sums[: len(totals)], gram

    for k in range(steps + 1):
        rated = members.select("n_tokens", "p", rate(history, most).alias("r"))
        totals = [F.sum(F.col("n_tokens") * F.col("r") * p[d]) for d in range(n)]
        have, gram = moments(rated, F.col("r") > 0, totals)
        rest = have - targets
        if full is None:
            full = gram + np.diag(1e-9 * np.diag(gram) + 1e-9)
        off = np.abs(rest) / np.maximum(targets, tolerance * targets.sum() + 1e-9)
        if (off[np.diag(full) > 1e-6] <= tolerance).all():
            break
        if k == steps:
            warnings.warn(f"after {steps} steps the totals are {have.tolist()}, the targets {targets.tolist()}")
            break
        far = rest @ np.linalg.solve(full, rest)
        if far > before:
            history[-1], before = safe, np.inf
            continue
        before, safe = far, list(np.linalg.solve(full, rest))
        if most is not None:
            r, move = F.col("r"), _move(safe)
            _, gram = moments(rated, ((r < most) | (move > 0)) & ((r > 0) | (move < 0)), [])
        gram += 1e-3 * full
        history.append(list(np.linalg.solve(gram, rest)))
    return history


def mix(docs: DataFrame, model: Classifier | None, weights: dict[str, float], relative: bool = False, most: float | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, n_tokens, domain probabilities p_<domain>, rate.

    ``weights`` are shares of all tokens that each domain is to have; with ``relative``
    they are shares of what the domain has now. No rate is above ``most``; a warning says
    so if the targets cannot be met. A domain that is not named is to have
    none, or to stay as it is. A NULL text has no tokens and does not matter for the
    targets; repeated rows and NULL ids count like others; without labels there is one
    domain, ``all``; an empty table gives an empty result; other columns are ignored.
    """
    domains = model.domains if model else ["all"]
    members = keep(memberships(docs, model))
    now = members.agg(*[F.sum(F.col("n_tokens") * F.col("p")[d]).alias(str(d)) for d in range(len(domains))]).first()
    have = np.array([x or 0.0 for x in now])
    if relative:
        targets = have * [weights.get(d, 1.0) for d in domains]
    else:
        named = np.array([weights.get(d, 0.0) for d in domains])
        targets = named / (named.sum() or 1.0) * have.sum()
    history = solve(members, targets, most=most)
    return members.select(
        "doc_id",
        "digest",
        "n_tokens",
        *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
        rate(history, most).alias("rate"),
    )


def copies(seed: int = 0) -> Column:
    """How often to take a document: its rate, rounded up with the chance of the rest,
    by a hash of the document."""
    u = F.pmod(F.xxhash64("doc_id", "digest", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    return F.floor(F.col("rate") + u).cast("long")


def thinned(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` without those whose rate, rounded by chance, is none; ``weights`` are
    relative. A filter takes no document twice: the rates are fitted with one as a bound,
    so that the documents left have the totals that were fitted, but for chance."""
    drawn = mix(docs, train(docs, labels), weights, relative=True, most=1.0)
    gone = drawn.where(copies() < 1).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_digest"))
    return docs.join(gone, same, "left_anti")
