"""Toxicity: a subsequence string kernel with Nyström landmarks and a linear support vector machine.

The kernel of two tokens counts their common three-letter subsequences, begin and end marks included, each
weighed by ``DECAY`` to the power of the letters it spans (``SPAN`` at most), normalised and raised to ``SHARPEN``;
so an insult with letters inserted, left out or replaced by signs still resembles its landmark.  Landmarks are
tokens of the labelled rows; K_mm^(-1/2) turns similarities to them into features (Nyström).

A sentence is as toxic as its most toxic token, a document as its most toxic sentence.  A document's label says
nothing about which of them earned it, so training alternates: the highest token of each toxic document is an
example, and so are, to the contrary, all tokens of clean documents; then the machine is fitted again.
As it is linear, a token has one value, which each task computes once per distinct token (``CACHE`` are kept).

The machine is fitted on at most ``SAMPLE`` labelled rows of at most ``SAMPLE_CHARS`` characters, those of
smallest hash, half of either label at most; scoring covers every whole text.

Defined cases: null and empty texts have no token and score 0; a null doc_id is not held out; rows labelled
twice are toxic if either label says so; without labels of both kinds every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import shielded, unshielded

DECAY, SPAN, SHARPEN = 0.7, 6, 4
LANDMARKS = 96
SAMPLE, SAMPLE_CHARS = 2_500, 50_000
ROUNDS = 5
CACHE = 400_000
#: Entries of the sparse map that are multiplied at once, and tokens mapped at once.
ENTRIES, TOKENS, BLOCK = 50_000, 1_000, 5_000
#: Tokens that share less than this with the landmarks are unlike all of them.
LEAST = 0.6
LETTERS = 35  # letter classes: gap, a to z, others by code, begin, end
BEGIN, END = 33, 34
_SINGLES = re.compile(r"(?<!\S)\S(?:\s+\S(?!\S)){2,}")
# Signs often written for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
# Spans of the second and third letter after the first, and their weights.
_STEPS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
_WEIGHTS = np.array([DECAY ** (k + 1) for _, k in _STEPS], dtype=np.float64)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bare(token: str) -> str:
    """A token in lower case without the signs around it, signs that look like letters read as letters."""
    return unicodedata.normalize("NFC", token.strip("#*%&$|<>.,;:!?\"'()[]").translate(LOOKALIKE).lower())


def letters(token: str) -> np.ndarray:
    """Letter classes of a token; signs and digits that stand for no letter are gaps."""
    plain = bare(token)
    codes = [ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 6 if c.isalpha() else 0 for c in plain]
    return np.array([BEGIN, *codes, END] if any(codes) else [], dtype=np.int64)


def subsequences(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse feature map: token number, subsequence code, weight; unit length per token."""
    owners, codes, weights = [], [], []
    pad = np.zeros(SPAN, dtype=np.int64)
    coded = [letters(token) for token in tokens]
    if not coded:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    flat = np.concatenate([np.concatenate([c, pad]) for c in coded])
    owner = np.repeat(np.arange(len(coded)), [len(c) + SPAN for c in coded])
    flat = np.concatenate([flat, pad])
    n = len(owner)
    first = flat[:n]
    for (j, k), weight in zip(_STEPS, _WEIGHTS):
        second, third = flat[j : n + j], flat[k : n + k]
        at = np.nonzero((first > 0) & (second > 0) & (third > 0))[0]
        owners.append(owner[at])
        codes.append((first[at] * LETTERS + second[at]) * LETTERS + third[at])
        weights.append(np.full(len(at), weight))
    owner, code, weight = np.concatenate(owners), np.concatenate(codes), np.concatenate(weights)
    key, where = np.unique(owner * LETTERS**3 + code, return_inverse=True)
    total = np.bincount(where, weight, minlength=len(key))
    owner, code = key // LETTERS**3, key % LETTERS**3
    norm = np.sqrt(np.bincount(owner, total**2, minlength=len(coded)))
    return owner, code, total / norm[owner]


@dataclass
class Table:
    """Maps of the landmarks by subsequence: begin and number of entries of each code, their landmarks and weights."""

    begin: np.ndarray
    number: np.ndarray
    landmark: np.ndarray
    weight: np.ndarray
    count: int


def landmark_table(landmarks: list[str]) -> Table:
    owner, code, weight = subsequences(landmarks)
    order = np.argsort(code, kind="stable")
    number = np.bincount(code, minlength=LETTERS**3)
    return Table(np.cumsum(number) - number, number, owner[order], weight[order], len(landmarks))


def similarities(tokens: list[str], table: Table) -> np.ndarray:
    """Sharpened kernel of tokens (rows) and landmarks."""
    owner, code, weight = subsequences(tokens)
    # Most subsequences are in no landmark; they only count for the token's length.
    met = table.number[code] > 0
    owner, code, weight = owner[met], code[met], weight[met]
    # No similarity exceeds the length of what is shared with all landmarks; tokens below LEAST count as unlike all.
    near = np.sqrt(np.bincount(owner, weight**2, minlength=len(tokens)))[owner] >= LEAST
    owner, code, weight = owner[near], code[near], weight[near]
    out = np.zeros(len(tokens) * table.count)
    for at in range(0, len(owner), ENTRIES):
        part = slice(at, at + ENTRIES)
        number = table.number[code[part]]
        entry = np.repeat(table.begin[code[part]] - np.cumsum(number) + number, number) + np.arange(number.sum())
        cell = np.repeat(owner[part], number) * table.count + table.landmark[entry]
        low = int(cell.min())
        out[low : int(cell.max()) + 1] += np.bincount(cell - low, np.repeat(weight[part], number) * table.weight[entry])
    return (out.reshape(len(tokens), table.count) ** SHARPEN).astype(np.float32)


def distinct_tokens(text: str | None) -> set[str]:
    """Tokens of a text; three or more single letters in a row also count as one token."""
    tokens = set((text or "").split())
    if sum(len(t) == 1 for t in tokens) > 1:
        tokens.update("".join(run.split()) for run in _SINGLES.findall(text))
    return tokens


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # of the similarities, after the Nyström map
    bias: float
    scale: float

    def __post_init__(self):
        self.table = landmark_table(self.landmarks)
        self.known: dict[str, float] = {}  # by token as written
        self.plain: dict[str, float] = {}  # by bare token

    def learn(self, tokens: set[str]) -> None:
        """Put the values of new tokens into the cache."""
        known, plain = self.known, self.plain
        if len(known) > CACHE // 2:
            known.clear()
        if len(plain) > CACHE:
            plain.clear()
        written = {t: bare(t) for t in tokens if t not in known}
        new = list({t for t in written.values() if t not in plain})
        for begin in range(0, len(new), TOKENS):
            part = new[begin : begin + TOKENS]
            plain.update(zip(part, (similarities(part, self.table) @ self.weights).tolist()))
        known.update((t, plain[b]) for t, b in written.items())

    def margins(self, texts: list[str | None]) -> list[float]:
        """Value of each text's most toxic token, a hundred texts at a time; -inf without tokens."""
        found = []
        for begin in range(0, len(texts), 100):
            split = [distinct_tokens(text) for text in texts[begin : begin + 100]]
            self.learn(set().union(*split))
            found += [max((self.known[t] for t in tokens), default=-np.inf) for tokens in split]
        return found

    def scores(self, texts: list[str | None]) -> list[float]:
        margin = np.clip(self.scale * (np.array(self.margins(texts)) + self.bias), -50, 50)
        return np.where(margin == -50, 0.0, 1 / (1 + np.exp(-margin))).tolist()


def contrasts(docs: list[set[str]], labels: np.ndarray) -> dict[str, float]:
    """How much more often, by documents, a token stands in toxic documents: log odds times the root of its count.

    Tokens of one toxic document, or not even e times as frequent there, get minus their count in clean documents.
    """
    toxic: Counter = Counter()
    clean: Counter = Counter()
    for tokens, label in zip(docs, labels):
        (toxic if label else clean).update(tokens)
    n_toxic, n_clean = labels.sum(), (1 - labels).sum()
    odds = lambda t: np.log((toxic[t] + 0.5) / n_toxic) - np.log((clean[t] + 0.5) / n_clean)
    return {t: float(odds(t) * toxic[t] ** 0.5 if toxic[t] > 1 and odds(t) > 1 else -clean[t]) for t in toxic.keys() | clean.keys()}


def train(rows: list[tuple[str, int]], count: int = LANDMARKS, rounds: int = ROUNDS) -> Model | None:
    """Fit on (text, label) rows; None without both labels."""
    labels = np.array([label for _, label in rows])
    if len(set(labels.tolist())) < 2:
        return None
    # Tokens of the same letters are one here, whatever signs stand around them.
    plain: dict[str, str] = {}
    docs = []
    for text, _ in rows:
        tokens = distinct_tokens(text)
        plain.update((t, bare(t)) for t in tokens if t not in plain)
        docs.append({plain[t] for t in tokens} - {""})
    telling = contrasts(docs, labels)
    named = sorted(telling, key=lambda t: (-telling[t], t))
    place = {t: i for i, t in enumerate(named)}
    held = [np.array([place[t] for t in tokens], dtype=np.int64) for tokens in docs]
    clean = np.unique(np.concatenate([at for at, label in zip(held, labels) if not label] or [np.zeros(0, np.int64)]))
    rank = np.array([telling[t] for t in named])
    del docs, plain
    suspicious = rank > 0  # only these can be what a toxic document is toxic for
    landmarks = list(dict.fromkeys(named[: count * 2 // 3] + named[::-1][: count // 3]))
    in_clean = np.bincount(np.concatenate([at for at, label in zip(held, labels) if not label] or [np.zeros(0, np.int64)]), minlength=len(named))
    own = [at[suspicious[at]] for at, label in zip(held, labels) if label]
    own = [at for at in own if len(at)]
    for last in (False, True):
        table = landmark_table(landmarks)
        value, vector = np.linalg.eigh(similarities(landmarks, table).astype(np.float64))
        root = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T
        mapped = np.empty((len(named), len(landmarks)), dtype=np.float32)
        for i in range(0, len(named), TOKENS):
            mapped[i : i + TOKENS] = similarities(named[i : i + TOKENS], table) @ root
        for _ in range(rounds):
            best = np.array([at[np.argmax(rank[at])] for at in own], dtype=np.int64)
            # A clean token weighs by its documents, and more if it looks like an insult by now.
            times = in_clean[clean] * (np.where(rank[clean] > 0.5 * np.median(rank[best]), 20.0, 1.0) if last else 1.0)
            y = np.r_[np.ones(len(best)), -np.ones(len(clean))]
            weights, _ = squared_hinge(mapped, np.concatenate([best, clean]), y, np.r_[np.ones(len(best)), times])
            rank = mapped @ weights
        hardest = clean[np.argsort(-np.maximum(rank[clean], 0) * in_clean[clean] ** 0.5, kind="stable")][: count // 4]
        if not last:
            landmarks = list(dict.fromkeys(landmarks + [named[i] for i in hardest]))
    model = Model(landmarks, root @ weights, 0.0, 1.0)
    model.known.update(zip(named, rank.tolist()) if len(named) <= CACHE else ())
    tops = np.array(model.margins([text for text, _ in rows]))
    tops = np.where(np.isfinite(tops), tops, tops[np.isfinite(tops)].min(initial=0.0))
    model.bias = -best_threshold(tops, labels)
    model.scale = float(2.0 / (np.median(np.abs(tops + model.bias)) or 1.0))
    return model


def squared_hinge(features: np.ndarray, rows: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear support vector machine on some rows of ``features``, by damped Newton steps over blocks of rows.

    Squared hinge loss, rows weighed by ``times``, classes balanced.
    """
    share = times / np.where(y > 0, 2 * max(1, times[y > 0].sum()), 2 * max(1, times[y < 0].sum()))
    width = features.shape[1]
    ridge = np.full(width + 1, penalty)
    ridge[-1] = 1e-9
    blocks = [slice(i, i + BLOCK) for i in range(0, len(rows), BLOCK)]

    def block(part: slice) -> np.ndarray:
        held = np.ones((len(rows[part]), width + 1))
        held[:, :-1] = features[rows[part]]
        return held

    def margins(w: np.ndarray) -> np.ndarray:
        return np.concatenate([block(part) @ w for part in blocks]) * y

    def loss(w: np.ndarray, margin: np.ndarray) -> float:
        return float((share * np.maximum(0, 1 - margin) ** 2).sum() + ridge @ w**2)

    w = np.zeros(width + 1)
    margin = margins(w)
    now = loss(w, margin)
    for _ in range(steps):
        square, right = np.diag(ridge), np.zeros(len(w))
        for part in blocks:
            inside = margin[part] < 1
            z = block(part)[inside]
            weighed = z.T * share[part][inside]
            square += weighed @ z
            right += weighed @ y[part][inside]
        move = np.linalg.solve(square, right) - w
        size, before = 1.0, now
        while True:
            margin = margins(w + size * move)
            now = loss(w + size * move, margin)
            if now <= before or size < 1e-4:
                break
            size /= 2
        w = w + size * move
        if before - now <= 1e-6 * before:
            break
    return w[:-1], float(w[-1])


def best_threshold(margin: np.ndarray, labels: np.ndarray) -> float:
    """Middle of the gap that gives the best F1 on the training rows."""
    order = np.argsort(-margin, kind="stable")
    hit = np.cumsum(labels[order])
    f1 = 2 * hit / (np.arange(1, len(order) + 1) + labels.sum())
    distinct = np.r_[margin[order][:-1] > margin[order][1:], True]
    best = int(np.argmax(np.where(distinct, f1, -1)))
    below = margin[order][best + 1] if best + 1 < len(order) else margin[order][best] - 1
    return float((margin[order][best] + below) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """The bounded sample of labelled rows that are not held out, as (text, label)."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    key = F.xxhash64(F.lit(8), "doc_id")
    either = [marked.where(F.col("toxic") == label).orderBy(key, "doc_id").limit(sample // 2) for label in (1, 0)]
    chosen = either[0].unionByName(either[1])
    short = docs.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    met = short.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "text").limit(sample)  # at most ``sample`` ids
    return [(row["text"], int(row["toxic"])) for row in met.collect()]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; texts are scored whole.

    Columns of ``docs`` that have these names come back as ``doc_score`` and ``doc_predicted``.
    """
    docs, hidden = shielded(docs, ("doc_id", "text"))
    if model is None:
        return unshielded(docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}), hidden)
    sent = docs.sparkSession.sparkContext.broadcast((model.landmarks, model.weights, model.bias, model.scale))

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*sent.value)
        for texts in batches:
            yield pd.Series(own.scores(list(texts)), dtype="float64")

    scored = docs.withColumn("score", toxic("text"))
    return unshielded(scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), hidden)


def detect(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on the labelled rows that are not held out and score every row of ``docs``."""
    return score(docs, train(training_rows(docs, labels, sample)))
