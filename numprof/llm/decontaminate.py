"""Benchmark decontamination by a broadcast hash set of word n-grams.

The distinct word windows of the benchmark travel to every task as word ids
and 64-bit hashes.  A task maps the words of its documents to those ids,
hashes only the positions where a whole window of benchmark words stands,
looks the hash up, and compares the words themselves before it counts a hit.
Documents are never shuffled.

Each broadcast is bounded: a benchmark of more than ``max_windows`` words is
cut into blocks of their own, and an item longer than a block into pieces that
overlap, so that none of its windows is lost.  The documents are scanned once:
a task takes a run of them, holds it against one block after the other, each
loaded and dropped again, and passes the run on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, released

#: Words are runs of ASCII letters and digits and of all characters from U+0080 up.
WORD_RE = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
N = 10
#: Words of a block, so windows at most: about 60 MB in a task.
MAX_WINDOWS = 1 << 18
#: Bytes of text that a task holds against all blocks at once, if there are several.
RUN_BYTES = 32 << 20
#: Words that one vectorised step looks at.
STEP_WORDS = 1 << 19

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Byte table: A-Z lower-cased, other ASCII blanked out; bytes of other characters stay.
NORMAL = bytes(b | 32 if 65 <= b <= 90 else b if b in _KEEP or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(NORMAL).split() if text else []


class WindowSet:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int = N):
        self.vocab: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.items)}
        texts = [(number.get(i, -1), [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(t)]) for i, t in items]
        self.by_length = {}
        for k in sorted({min(n, len(ids)) for _, ids in texts} - {0}):
            fits = [(i, np.array(ids, np.int32)) for i, ids in texts if min(n, len(ids)) == k]
            table = np.concatenate([np.lib.stride_tricks.sliding_window_view(ids, k) for _, ids in fits])
            owner = np.concatenate([np.full(len(ids) - k + 1, i, np.int32) for i, ids in fits])
            for seed in range(100):  # another multiplier if two windows share a hash
                powers = _powers(k, seed)
                hashes = _hash(table, powers)
                order = np.lexsort((owner, hashes))
                same = hashes[order[1:]] == hashes[order[:-1]]
                if (table[order[1:]][same] == table[order[:-1]][same]).all():
                    break
            else:
                raise RuntimeError("no collision-free multiplier found")
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            # Items of window j: owner[ends[j]:ends[j + 1]], -1 for a NULL id.
            self.by_length[k] = (powers, hashes[order[first]], table[order[first]], owner[order], np.append(first, len(order)))


def _powers(k: int, seed: int) -> np.ndarray:
    p = pow(0x9E3779B97F4A7C15, 2 * seed + 1, 1 << 64)
    return np.array([pow(p, j, 1 << 64) for j in range(1, k + 1)], np.uint64)


def _hash(rows: np.ndarray, powers: np.ndarray) -> np.ndarray:
    return (rows.astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)


def find(windows: WindowSet, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Per document its hit word spans (merged, in order) and the items found."""
    ids = []
    starts = [0]
    for words in docs:
        ids += map(windows.vocab.get, words, repeat(0))
        ids.append(0)  # no window reaches into the next document
        starts.append(len(ids))
    a = np.array(ids, np.int32)
    starts = np.array(starts)
    known = np.concatenate(([0], np.cumsum(a == 0)))
    hits: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for k, (powers, hashes, table, owner, ends) in windows.by_length.items():
        if len(a) < k:
            continue
        at = np.flatnonzero(known[k:] == known[:-k])
        for part in np.array_split(at, max(1, len(at) // STEP_WORDS + 1)):
            if not len(part):
                continue
            rows = a[part[:, None] + np.arange(k)]
            h = _hash(rows, powers)
            j = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            good = np.flatnonzero(hashes[j] == h)
            good = good[(rows[good] == table[j[good]]).all(axis=1)]
            doc = np.searchsorted(starts, part[good], "right") - 1
            for d, p, w in zip(doc.tolist(), (part[good] - starts[doc]).tolist(), j[good].tolist()):
                spans, found = hits.setdefault(d, ([], set()))
                spans.append((p, p + k))
                found.update(windows.items[i] for i in owner[ends[w]:ends[w + 1]].tolist() if i >= 0)
    return [(merged(hits[d][0]), hits[d][1]) if d in hits else ([], set()) for d in range(len(docs))]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` less the characters from the first to the last word of each span."""
    marks = [m.span() for m in WORD_RE.finditer(text.translate(_LOWER))]
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:marks[s][0]])
        at = marks[e - 1][1]
    return "".join(out) + text[at:]


_LOWER = {c: c + 32 for c in range(65, 91)}


def _scan(blocks: list, names: list[str], text: str, spans: str, items: str, count: str, cut: bool):
    """A mapInArrow step that adds the hits of all ``blocks`` (broadcasts of
    window sets) to ``spans`` and ``items`` and gives the columns ``names``;
    ``cut``: with the spans cut out."""

    def scanned(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sizes = [[([], set())] * b.num_rows for b in run], {}
        for block in blocks:
            for k, batch in enumerate(run):
                docs = [words_of(t) for t in batch.column(text).to_pylist()]
                sizes[k] = list(map(len, docs))
                new = find(block.value, docs)
                found[k] = [(merged(s + t) if s and t else s or t, i | j) for (s, i), (t, j) in zip(found[k], new)]
            if len(blocks) > 1:
                block.__dict__.pop("_value", None)  # one block at a time; the next run loads it again
        for k, (batch, hits) in enumerate(zip(run, found)):
            texts = batch.column(text).to_pylist() if cut else []
            counts = [{"n_words": n, "n_hit": sum(e - b for b, e in s)} for n, (s, _) in zip(sizes[k], hits)]
            arrays = {spans: pa.array([[x for span in s for x in span] for s, _ in hits], pa.list_(pa.int32())),
                      items: pa.array([sorted(i) for _, i in hits], pa.list_(pa.string())),
                      count: pa.array(counts, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64())]))}
            if cut:
                arrays[text] = pa.array([without_spans(t, s) if s else t for t, (s, _) in zip(texts, hits)], pa.string())
            yield pa.RecordBatch.from_arrays([arrays[n] if n in arrays else batch.column(n) for n in names], names=names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = [], 0
        for whole in batches:
            for batch in _slices(whole, text):
                run.append(batch)
                held += batch.nbytes
                if len(blocks) < 2 or held >= RUN_BYTES:
                    yield from scanned(run)
                    run, held = [], 0
        if run:
            yield from scanned(run)

    return released(step)


def _slices(batch: pa.RecordBatch, text: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text, or one longer text."""
    sizes = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, max_windows: int, n: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of at most ``max_windows`` words (or one window),
    so of at most that many windows; the driver holds one block at a time."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL").distinct()
    block, room = [], max_windows
    for row in items.orderBy("i", "t").toLocalIterator():
        for size, piece in _pieces(row["t"], max_windows, n):
            if block and size > room:
                yield block
                block, room = [], max_windows
            block.append((row["i"], piece))
            room -= size
    yield block


def _pieces(text: str, max_windows: int, n: int) -> Iterator[tuple[int, str]]:
    """(words at most, text) of an item, in pieces that share n - 1 words if it is longer than a block."""
    if len(text) // 2 + 1 <= max_windows:
        yield len(text) // 2 + 1, text
        return
    words = words_of(text)
    step = max(1, max_windows - n + 1)
    for at in range(0, max(1, len(words) - n + 1) if len(words) > max_windows else 1, step):
        part = words[at:at + step + n - 1] if len(words) > max_windows else words
        yield len(part), b" ".join(part).decode()


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
         n: int = N, max_windows: int = MAX_WINDOWS, texts: str = "keep") -> tuple[DataFrame, str, str, str]:
    """``docs`` plus three columns, and their names: a struct of n_words and
    n_hit, the hit spans (word numbers, start and end by turns), and the items.

    ``texts``: ``keep``, ``drop`` the column, or ``cut`` the spans out.
    """
    count, spans, items = (fresh(docs, f"__{x}") for x in ("count", "spans", "items"))
    fields = [f for f in docs.schema if not (texts == "drop" and f.name == text_col)]
    added = T._parse_datatype_string(f"`{count}` struct<n_words:bigint,n_hit:bigint>, `{spans}` array<int>, `{items}` array<string>")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*fields, *added]])
    sc = docs.sparkSession.sparkContext
    blocks = []
    for block in _blocks(benchmark, item_col, item_text_col, max_windows, n):
        blocks.append(sc.broadcast(WindowSet(block, n)))
        blocks[-1].__dict__.pop("_value", None)  # the driver holds one block at a time
    return docs.mapInArrow(_scan(blocks, schema.names, text_col, spans, items, count, texts == "cut"), schema), count, spans, items


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256,
    contaminated, and ``items`` and ``spans`` themselves.

    A NULL or empty text has no words and no hits; an item of fewer than n
    words is one window; an item without words or with a NULL text never
    hits; a NULL item_id marks words as hit but is not listed; an empty
    benchmark hits nothing; repeated rows give repeated results.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out, count, spans, items = scan(d, benchmark, "text", texts="drop", **options)
    return out.select(F.col("id").alias(id_col), F.col(count)["n_words"].alias("n_words"), F.col(count)["n_hit"].alias("n_hit"),
                      F.size(items).cast("bigint").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
                      (F.col(count)["n_hit"] > 0).alias("contaminated"), F.col(items).alias("items"), F.col(spans).alias("spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or
    with the hit spans cut out of their texts (``"spans"``); same columns.

    NULL and empty texts have no hits and stay; repeated rows are decided
    alike; an empty benchmark leaves all rows as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove: documents or spans")
    out, count, _, _ = scan(docs, benchmark, text_col, texts="cut" if remove == "spans" else "keep", **options)
    kept = out if remove == "spans" else out.filter(F.col(count)["n_hit"] == 0)
    return kept.select(*docs.columns)
