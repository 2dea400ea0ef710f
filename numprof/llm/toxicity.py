"""Toxicity: a counterfactual-regularised linear classifier of words.

Labelled documents that mention an identity term are copied with that term
swapped for others of its group and for a neutral word; fitting minimises
the log loss of the documents plus the squared change of their scores under
those swaps.  A group mention that merely goes along with toxic documents in
the sample so earns no weight of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, one_label, training_row, written
from .decontaminate import words_of

# Identity terms by group, each with its neutral word first.
IDENTITY_TERMS = {
    "gender": ("person", "man", "woman", "boy", "girl", "transgender", "nonbinary"),
    "genders": ("people", "men", "women", "boys", "girls", "males", "females"),
    "religion": ("believer", "christian", "muslim", "jew", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    "religions": ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    "faith": ("religious", "jewish", "islamic", "christianity", "islam", "judaism"),
    "origin": ("local", "african", "american", "asian", "european", "latino", "arab", "mexican", "chinese", "indian", "black", "white"),
    "orientation": ("single", "gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    "ability": ("patient", "blind", "deaf", "disabled", "autistic"),
    "status": ("citizens", "immigrants", "refugees", "foreigners", "migrants"),
    "age": ("adults", "elderly", "teenagers", "millennials"),
}

#: Labelled documents the model is fitted on, on average at most.
FIT_ROWS = 20_000
#: Words of the model, the fewest sampled documents a word must be in, and the
#: standard errors by which its rates in both classes must differ: with few
#: labels, words below that fit the sample and nothing else.
WORDS, MIN_DOCS, MIN_ERRORS = 4096, 4, 2.0
#: Weight of the squared score change under swaps, and of squared weights
#: (of the sum over documents, so a larger sample is bound less).
SWAP_PENALTY, L2 = 5.0, 0.3
STEPS, RATE = 400, 0.1


def swaps(words: set[bytes]) -> list[set[bytes]]:
    """Copies of a word set: its identity terms replaced by the next term of
    their group, by the one after, and by the group's neutral word."""
    terms = [(w, *_PLACE[w]) for w in words & _PLACE.keys()]
    if not terms:
        return []
    rest = words - {t[0] for t in terms}
    out = []
    for how in (lambda g, k: g[1 + k % (len(g) - 1)], lambda g, k: g[1 + (k + 1) % (len(g) - 1)], lambda g, k: g[0]):
        out.append(rest | {how(group, k) for _, group, k in terms})
    return out


_GROUPS = [tuple(w.encode() for w in g) for g in IDENTITY_TERMS.values()]
#: The identity terms, always words of the model.  A neutral word is one only
#: if the sample makes it one, so a swap for it is held to the bare document.
_PLACE = {w: (g, k) for g in _GROUPS for k, w in enumerate(g) if k}


@dataclass
class Model:
    words: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = 0.0

    def score(self, text: str | None) -> float:
        """Probability of label 1."""
        found = set(map(self.words.get, words_of(text), repeat(-1)))
        found.discard(-1)
        z = self.intercept + float(self.weights[list(found)].sum()) if found else self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _sums(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights[flat], n)


def fit(words: list[bytes], rows: list[list[int]], y: np.ndarray, copies: list[tuple[int, list[int]]],
        swap_penalty: float = SWAP_PENALTY, l2: float = L2) -> Model:
    """Gradient descent on weighted log loss, swap penalty and squared weights.

    ``rows`` are word numbers of the documents; ``copies`` are (document,
    word numbers of a swapped copy).
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    model = Model({w: k for k, w in enumerate(words)}, np.zeros(len(words)), float(np.log(prior / (1 - prior))))
    if not len(y) or not words or len(np.unique(y)) < 2:
        return model
    n = len(rows)
    flat, owner = np.array([w for r in rows for w in r], np.int64), np.repeat(np.arange(n), [len(r) for r in rows])
    # A swap changes only the words by which copy and document differ.
    up = [(c, w, s) for c, (d, swapped) in enumerate(copies) for s, part in ((1, set(rows[d]) - set(swapped)), (-1, set(swapped) - set(rows[d]))) for w in part]
    c_own, c_word, c_sign = (np.array(x, np.int64) for x in (zip(*up) if up else ([], [], [])))
    w, b = model.weights, model.intercept
    # The rarer class weighs more: by the root of the odds against it.
    odds = (1 - prior) / prior
    share = np.where(y == 1, max(odds, 1) ** 0.5, max(1 / odds, 1) ** 0.5)
    share /= share.sum()
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(_sums(w, flat, owner, n) + b, -30, 30)))
        e = (p - y) * share
        grad = np.bincount(flat, e[owner], len(w)) + l2 / n * w
        if len(c_own):
            change = np.bincount(c_own, c_sign * w[c_word], len(copies)) / len(copies)
            grad += 2 * swap_penalty * np.bincount(c_word, c_sign * change[c_own], len(w))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * e.sum(), 0.999 * vb + 0.001 * e.sum() ** 2
        rate = RATE * (1 - 0.999 ** t) ** 0.5 / (1 - 0.9 ** t)
        w = w - rate * m / (np.sqrt(v) + 1e-8)
        b = b - rate * mb / (np.sqrt(vb) + 1e-8)
    model.weights, model.intercept = w, float(b)
    return model


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
            words = set(words_of(text))
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.binary()), pa.array([y] * len(words), pa.float64())], names=["word", "y"])


def _document_rows(words: list[bytes]):
    number = {w: k for k, w in enumerate(words)}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lambda s: sorted(number[w] for w in s if w in number)
        for batch in batches:
            rows = []
            for l, y, text in zip(*(batch.column(c).to_pylist() for c in ("l", "y", "text"))):
                own = set(words_of(text))
                rows.append((str(l), y, known(own), [known(s) for s in swaps(own)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.list_(pa.list_(pa.int32())))],
                names=["l", "y", "words", "copies"])
    return step


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          fit_rows: int = FIT_ROWS, modulus: int = 3, held_out: int = 1, swap_penalty: float = SWAP_PENALTY) -> Model:
    """Fit on about ``fit_rows`` labelled rows that are not held out, drawn by
    a hash of the id; rows without a label or an id are left out.

    An id has one label, that of most of its rows, and every text of it
    counts once; if the drawn ids have many texts, these are drawn too.
    So the drawn labels are bounded by ``fit_rows`` and may be broadcast;
    words are counted by Spark, and the driver gets at most ``WORDS`` of
    them and the drawn documents as word numbers.
    """
    known = labels.filter(F.col(label_col).isNotNull() & training_row(id_col, modulus, held_out))
    known = one_label(known.select(F.col(id_col).alias("l"), F.col(label_col).cast("double").alias("y")))
    share = int(min(1.0, fit_rows / max(known.count(), 1)) * (1 << 30))
    drawn = known.filter(F.pmod(F.xxhash64("l"), F.lit(1 << 30)) < share)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), F.col("id") == F.col("l"))
    sample = bounded(written(sample.select("l", "y", "text").distinct(), "toxicity-sample"), fit_rows)
    counts = sample.mapInArrow(_document_words, "word binary, y double").groupBy("word").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).filter(F.col("pos") + F.col("neg") >= MIN_DOCS)
    total = sample.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    n_pos, n_neg = (total[0] or 0) + 1.0, (total[1] or 0) + 1.0
    # Difference of the rates in both classes, in standard errors.
    pos, neg = F.col("pos") / n_pos, F.col("neg") / n_neg
    z = F.abs(pos - neg) / F.sqrt((F.col("pos") + 1) / n_pos ** 2 + (F.col("neg") + 1) / n_neg ** 2)
    telling = counts.select("word", z.alias("z")).filter(F.col("z") >= MIN_ERRORS)
    words = sorted(bytes(r["word"]) for r in telling.orderBy(F.desc("z"), "word").limit(WORDS).select("word").collect())
    words = sorted({*words, *_PLACE})
    rows = sorted(tuple(r) for r in sample.mapInArrow(_document_rows(words), "l string, y double, words array<int>, copies array<array<int>>").collect())
    copies = [(k, c) for k, r in enumerate(rows) for c in r[3]]
    return fit(words, [r[2] for r in rows], np.array([r[1] for r in rows]), copies, swap_penalty)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
                    **options) -> DataFrame:
    """Per row of ``docs``: id, ``score`` (probability of label 1) and
    ``predicted``.

    A NULL, empty or wordless text scores as a text without known words;
    without usable labels every score is 0.5; repeated rows give repeated
    results; an empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t.as_py()) for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    out = d.mapInArrow(step, f"id {d.schema['id'].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
