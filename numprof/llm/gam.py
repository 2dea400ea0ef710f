"""Quality classifier: a generalised additive model with pairwise terms.

One pass over the texts measures each of them (``FEATURES``).  Labelled rows
are joined to the measurements, and a bounded sample of them is fitted by
cyclic boosting: round by round each feature in turn gets a tree of at most
three leaves on the current residuals, added to that feature's lookup table;
then the pairs with the strongest residual interaction get tables of their
own from trees of depth two.  Scoring looks up one bin per table and adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, one_label, training_row, written

FEATURES = ("log_words", "word_length", "longest_word", "distinct_words", "equal_neighbours", "capitals", "exclamations", "bars",
            "symbols", "digits", "stops", "non_ascii", "words_per_line", "repeated_lines", "brackets", "at_or_slash")
#: Labelled rows the model is fitted on, on average at most.
FIT_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE, L2, MIN_HESSIAN = 0.15, 2.0, 3.0

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HIGH = bytes(range(128, 256))


def measure(text: str | None) -> tuple[float, ...]:
    """The features of one text; all zero for NULL and for texts without words."""
    b = text.encode() if text else b""
    words = b.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, size = len(words), len(b)
    lines = [x for x in b.split(b"\n") if x.strip()]
    chars = sum(map(len, words))
    share = lambda drop: (size - len(b.translate(None, drop)))
    return (float(np.log1p(n)), chars / n, float(max(map(len, words))), len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
            share(_UPPER) / chars, b.count(b"!") / n, b.count(b"|") / n, share(b"#*$%&^~=+") / n, share(b"0123456789") / chars,
            share(b".,;:?") / n, share(_HIGH) / chars, n / len(lines), 1 - len(set(lines)) / len(lines), share(b"<>{}[]\\") / n, share(b"@/_") / n)


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, one double per feature) for every row of ``docs``."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t.as_py()) for t in batch.column(1)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows.T.copy())], names=["id", *FEATURES])

    return d.mapInArrow(step, f"id {d.schema['id'].dataType.simpleString()}, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    pair_edges: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        z = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (a, b), table in self.pairs.items():
            z += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + L2)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best (gain, first bin of the right side) of a run of bins; 0 if none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), 0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step per bin of a tree of at most three leaves."""
    out, leaves = np.zeros(len(g)), [(0, len(g))]
    for _ in range(2):
        best = max(((*_cut(g[a:b], h[a:b]), a, b) for a, b in leaves), default=(0, 0, 0, 0))
        gain, k, a, b = best
        if gain <= 0:
            break
        leaves.remove((a, b))
        leaves += [(a, a + k), (a + k, b)]
    for a, b in leaves:
        out[a:b] = RATE * g[a:b].sum() / (h[a:b].sum() + L2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree that cuts one axis, then each side on the other."""
    best = (0.0, np.zeros_like(g))
    for axis in (0, 1):
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        for k in range(1, len(gg)):
            gain, steps, whole = 0.0, np.zeros_like(gg), _gain(gg.sum(), hh.sum())
            for rows in (slice(0, k), slice(k, None)):
                gs, hs = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                add, c = _cut(gs, hs)
                gain += add + _gain(gs.sum(), hs.sum())
                for cols in ((slice(0, c), slice(c, None)) if add > 0 else (slice(None),)):
                    steps[rows, cols] = RATE * gs[cols].sum() / (hs[cols].sum() + L2)
            if gain - whole > best[0]:
                best = (gain - whole, steps if axis == 0 else steps.T)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on rows of features and 0/1 labels.

    Without rows, or with one label only, the model is a constant.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    model = Model(intercept=float(np.log(prior / (1 - prior))))
    if len(np.unique(y)) < 2:
        return model
    m = x.shape[1]
    model.edges, model.pair_edges = [_edges(x[:, j], BINS) for j in range(m)], [_edges(x[:, j], PAIR_BINS) for j in range(m)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(m):
            n = len(model.tables[j])
            g, h = slopes()
            step = _tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            model.tables[j] += step
            z += step[bins[j]]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        na, nb = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        return np.bincount(coarse[a] * nb + coarse[b], v, na * nb).reshape(na, nb)

    g, h = slopes()
    ranked = sorted(((_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(m) for b in range(a + 1, m)), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    model.pairs = {(a, b): np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            g, h = slopes()
            step = _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            model.pairs[a, b] += step
            z += step[coarse[a], coarse[b]]
    return model


def train(measured: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", fit_rows: int = FIT_ROWS,
          modulus: int = 5, held_out: int = 0) -> Model:
    """Fit on about ``fit_rows`` labelled rows that are not held out, drawn by
    a hash of the id; rows without a label or an id are left out.

    An id has one label, that of most of its rows, and rows of it with equal
    features count once; if the drawn ids have many rows, these are drawn too.
    """
    known = labels.filter(F.col(label_col).isNotNull() & training_row(id_col, modulus, held_out))
    known = one_label(known.select(F.col(id_col).alias("l"), F.col(label_col).cast("double").alias("y")))
    n = known.count()
    share = int(min(1.0, fit_rows / max(n, 1)) * (1 << 30))
    drawn = known.filter(F.pmod(F.xxhash64("l"), F.lit(1 << 30)) < share)
    rows = measured.join(drawn, F.col("id") == F.col("l")).select("l", "y", *FEATURES).distinct()
    rows = bounded(written(rows, "quality-sample"), fit_rows).orderBy("l", *FEATURES).select("y", *FEATURES).toPandas()
    return fit(rows[list(FEATURES)].to_numpy(float), rows["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
                   **options) -> DataFrame:
    """Per row of ``docs``: id, ``score`` (probability of label 1) and
    ``predicted``.

    A NULL, empty or blank text scores as a text without words; without
    usable labels every score is 0.5; repeated rows give repeated results;
    an empty table gives an empty result; other columns are ignored.
    """
    measured = written(measurements(docs, id_col, text_col), "quality-features")
    model = train(measured, labels, id_col=id_col, **options)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["id", "score"])

    out = measured.mapInArrow(step, f"id {measured.schema['id'].dataType.simpleString()}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
