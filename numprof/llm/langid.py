"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the
counts of the bytes that follow.  The code length of a byte is read from the
longest context that the language has seen: a byte seen there has
probability n / (N + D), any other takes the escape D / (N + D), D being the
number of distinct bytes (symbols, see below) seen, times its probability in the next shorter
context, scaled to the bytes not yet ruled out.  The probabilities of every
context add up to one, so code lengths are exact; statistics are frozen, so
they are worked out once, for every context of any language, into a table
that scoring reads with array operations.  Languages whose tables would be
too large together get a table in blocks, read one after the other.

Bytes are lower-cased (ASCII) and written in an alphabet of ``CLASSES``
symbols: the most frequent bytes of the training texts have a symbol each,
any other byte is two symbols, its high and its low half.  So every one of
the 256 byte values keeps its own code, in contexts too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, written

ORDER = 3
#: Symbols; windows of ORDER + 1 symbols are the model's only input.
CLASSES = 64
#: The first symbols are halves of bytes, the others whole bytes.
HALVES = 16
#: Labelled texts drawn for each language, on average at most.
TRAIN_DOCS = 4000
#: Symbols counted or scored by one array step; longer texts take several.
STEP_SYMBOLS = 1 << 19
#: Bytes of a block's table, unless one language needs more (68 MB at most).
TABLE_BYTES = 1 << 27
#: Bytes of rows that a task holds while it reads one block after the other.
RUN_BYTES = 1 << 25
UNKNOWN = "und"

_LOWER = bytes(b | 32 if 65 <= b <= 90 else b for b in range(256))
_PAD = b"\n" * ORDER


def alphabet(frequent: list[int]) -> np.ndarray:
    """The symbols of every byte, two columns: those of ``frequent`` (at most
    CLASSES - HALVES bytes) have one and -1, the others their two halves."""
    code = np.stack([np.arange(256) >> 4, np.arange(256) & 15], axis=1).astype(np.int8)
    code[frequent, 0] = HALVES + np.arange(len(frequent))
    code[frequent, 1] = -1
    return code


def _symbols(data: bytes, code: np.ndarray) -> np.ndarray:
    """The symbols of ``data``, in order."""
    both = code[np.frombuffer(data, np.uint8)].reshape(-1)
    return both[both >= 0]


def _windows(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each symbol after the first ``order``, the number whose
    base-CLASSES digits are its context and, last, the symbol itself."""
    c = symbols.astype(np.int32)
    w = c[order:].copy()
    for k in range(1, order + 1):
        w += c[order - k:len(c) - k] * CLASSES ** k
    return w


def _pieces(text: bytes, code: np.ndarray) -> Iterator[np.ndarray]:
    """The symbols of a text in pieces of at most STEP_SYMBOLS, each behind the
    ORDER symbols before it."""
    context = _symbols(_PAD, code)[-ORDER:]
    for at in range(0, len(text), STEP_SYMBOLS // 2):
        piece = np.concatenate([context, _symbols(text[at:at + STEP_SYMBOLS // 2].translate(_LOWER), code)])
        context = piece[-ORDER:]
        yield piece


class Model:
    """Frozen statistics: ``cost[block * CLASSES + symbol, language]`` in bits,
    ``block`` of every context of ORDER symbols, and the ``code`` of bytes."""

    def __init__(self, languages: list[str], code: np.ndarray, block: np.ndarray, cost: np.ndarray):
        self.languages, self.code, self.block, self.cost = languages, code, block, cost

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        pending, owners, size = [], [], 0
        for k, text in enumerate(texts):
            for piece in _pieces(text, self.code):
                pending.append(piece)
                owners.append(k)
                size += len(piece)
                if size >= STEP_SYMBOLS:
                    self._add(total, pending, owners)
                    pending, owners, size = [], [], 0
        if pending:
            self._add(total, pending, owners)
        return total

    def _add(self, total: np.ndarray, pieces: list[np.ndarray], owners: list[int]) -> None:
        w = _windows(np.concatenate(pieces))
        costs = self.cost[self.block[w // CLASSES] * CLASSES + w % CLASSES]
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        # A window starts at its context; the last ORDER of a piece reach into the next one.
        cuts = np.stack([starts, ends - ORDER], axis=1).reshape(-1)
        costs = np.concatenate([costs, np.zeros((1, costs.shape[1]), costs.dtype)])
        np.add.at(total, owners, np.add.reduceat(costs, cuts, axis=0, dtype=np.float64)[::2])


def _decisions(texts: list[str | None], lengths: Callable[[list[bytes]], np.ndarray], languages: list[str]) -> list[tuple[str, float]]:
    """(language, score) per text; score is the posterior of the best
    language under equal priors, per text."""
    known = [bool(t) and any(map(str.isalpha, t)) for t in texts]
    bits = lengths([t.encode() if k else b"" for t, k in zip(texts, known)])
    out = []
    for k, row in zip(known, bits):
        if not k or not languages:
            out.append((UNKNOWN, 0.0))
            continue
        best = int(row.argmin())
        out.append((languages[best], float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum())))
    return out


def fit(languages: list[str], code: np.ndarray, lang: np.ndarray, window: np.ndarray, count: np.ndarray) -> Model:
    """The model of counts (language index, window, count)."""
    n_lang = len(languages)
    # Below the context of no symbol, every symbol is equally likely.
    prob = np.full((1, CLASSES, n_lang), 1 / CLASSES, np.float32)  # (block, symbol, language)
    block_of = np.zeros(1, np.int64)  # block of every context of this depth; unseen contexts share the shorter one's
    for depth in range(ORDER + 1):
        # Contexts are the last ``depth`` digits before the symbol's own.
        ctx = (window // CLASSES) % CLASSES ** depth
        order = np.argsort(ctx, kind="stable")
        seen, first = np.unique(ctx[order], return_index=True)
        first = np.append(first, len(order))
        shorter = block_of[seen % CLASSES ** (depth - 1)] if depth else np.zeros(len(seen), np.int64)
        found = np.empty((len(seen), CLASSES, n_lang), np.float32)
        for at in range(0, len(seen), 1024):
            end = min(at + 1024, len(seen))
            rows = order[first[at]:first[end]]
            counts = np.zeros((end - at, CLASSES, n_lang))
            np.add.at(counts, (np.searchsorted(seen[at:end], ctx[rows]), window[rows] % CLASSES, lang[rows]), count[rows])
            found[at:end] = _distribution(counts, prob[shorter[at:end]].astype(float))
        # Digit order: the new digit is the highest.
        block_of = np.tile(block_of, CLASSES) if depth else np.zeros(1, np.int64)
        block_of[seen] = len(prob) + np.arange(len(seen))
        prob = np.concatenate([prob, found])
    cost = -np.log2(np.maximum(prob, np.float32(1e-37)))
    return Model(languages, code, block_of.astype(np.int32), cost.reshape(-1, n_lang))


def _distribution(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities in contexts (first axis) with these counts, ``below``
    being those in the next shorter context."""
    total, distinct = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    unseen = np.where(counts > 0, 0, below)
    rest = unseen.sum(axis=1, keepdims=True)
    escapes = np.where(rest > 0, distinct, 0)
    own = np.where(counts > 0, counts, escapes * unseen / np.where(rest > 0, rest, 1)) / np.maximum(total + escapes, 1)
    return np.where(total > 0, own, below)


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        for t in batch.column("text"):
            total += np.bincount(np.frombuffer(t.as_py().encode().translate(_LOWER), np.uint8), minlength=256)
    yield pa.RecordBatch.from_pydict({"byte": pa.array(range(256), pa.int32()), "n": total})


def _window_counts(code: np.ndarray):
    def counted(found: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in found.items():
            w, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w)), pa.array(w.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "w", "n"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = {}, 0
        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for piece in _pieces(t.encode(), code):
                    found.setdefault(lang, []).append(_windows(piece))
                    size += len(piece)
                    if size >= 8 * STEP_SYMBOLS:
                        yield from counted(found)
                        found, size = {}, 0
        yield from counted(found)
    return step


def _blocks(contexts: dict[str, int]) -> list[list[str]]:
    """Languages in blocks whose tables stay within TABLE_BYTES even if no two
    languages share a context; a language's own table always does."""
    out, held = [], 0
    for lang in sorted(contexts):
        grown = held + contexts[lang]
        if out and grown * (len(out[-1]) + 1) * CLASSES * 4 <= TABLE_BYTES:
            out[-1].append(lang)
            held = grown
        else:
            out.append([lang])
            held = contexts[lang]
    return out


def train(docs: DataFrame, labelled: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          train_docs: int = TRAIN_DOCS) -> list[Model]:
    """Fit on about ``train_docs`` rows of each language, drawn by a hash of
    the id (and the text, so that a repeated id is not drawn as one).

    Windows are counted by the tasks and summed by Spark; the driver gets
    the distinct windows of one block of languages at a time.  Code lengths
    of a language do not depend on the others of its block, so the models
    of all blocks score as one.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("h"), labelled.alias("use"))
    rows = rows.filter("use AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, int(min(1.0, train_docs / n) * (1 << 30)))])
    sample = rows.filter((F.col("text") != "") & (F.col("h") < share[F.col("lang")])).select("lang", "text")
    frequent = sample.mapInArrow(_byte_counts, "byte int, n bigint").groupBy("byte").agg(F.sum("n").alias("n")).filter("n > 0")
    code = alphabet([r["byte"] for r in frequent.orderBy(F.desc("n"), "byte").limit(CLASSES - HALVES).collect()])
    counts = sample.mapInArrow(_window_counts(code), "lang string, w int, n bigint").groupBy("lang", "w").agg(F.sum("n").alias("n"))
    counts = written(counts, "windows")
    # Contexts of every depth, that of none and that of unseen ones.
    depths = [F.count_distinct(F.floor(F.col("w") / CLASSES) % CLASSES ** d) for d in range(1, ORDER + 1)]
    contexts = dict.fromkeys(sizes, 2) | {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(sum(depths, F.lit(2)).alias("n")).collect()}
    models = []
    for languages in _blocks(contexts):
        own = counts.filter(F.col("lang").isin(languages)).toPandas()
        index = {lang: k for k, lang in enumerate(languages)}
        models.append(fit(languages, code, own["lang"].map(index).to_numpy(np.int64), own["w"].to_numpy(np.int64), own["n"].to_numpy(np.float64)))
    return models


def predict(docs: DataFrame, models: list[Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``lang_pred``, ``score``.

    ``und`` with score 0 for a NULL text or one without a letter; without
    languages every text is ``und``; repeated rows give repeated results; an
    empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    languages = [lang for m in models for lang in m.languages]
    blocks = [docs.sparkSession.sparkContext.broadcast(m) for m in models]

    def lengths(texts: list[bytes]) -> np.ndarray:
        found = [np.zeros((len(texts), 0))]
        for block in blocks:
            found.append(block.value.lengths(texts))
            if len(blocks) > 1:
                block.__dict__.pop("_value", None)  # one block at a time; the next run loads it again
        return np.concatenate(found, axis=1)

    def decided(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = _decisions([t for b in run for t in b.column(1).to_pylist()], lengths, languages)
        return pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(0) for b in run]), pa.array([f[0] for f in found], pa.string()),
                                           pa.array([f[1] for f in found], pa.float64())], names=["id", "lang_pred", "score"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = [], 0
        for batch in batches:
            run.append(batch)
            held += batch.nbytes
            if len(blocks) < 2 or held >= RUN_BYTES:
                yield decided(run)
                run, held = [], 0
        if run:
            yield decided(run)

    return d.mapInArrow(released(step), f"id {d.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)
