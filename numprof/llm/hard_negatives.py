"""Hard negatives by a secondary-sort shuffle of pair scores.

Anchors (a stated query set) meet all rows in blocks: a cell of the grid
(anchor block x row block) holds a bounded number of both, and its scores are
one exact matrix product.  A cell passes on only what can be in the result:
for each anchor the best rows of its own label, and, in a second pass that
knows the anchor's positives, for each positive's window the best rows of
other labels.  Both limits are the result's own, so nothing is lost, and no
cell emits its pairs.

What is left is shuffled once by anchor and sorted within partitions by one
packed key: anchor, descending score, positives before negatives, id.  An
iterator streams over it: a positive opens its window, negatives that lie in
open windows are emitted, a full or passed window closes.  No anchor is ever
held: only its open windows are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: LOW * positive <= WHOLE * negative <= HIGH * positive.
LOW, HIGH, WHOLE = 30, 90, 100
#: Rows and anchors of a cell; scores that a task holds at once.
CELL_ROWS, CELL_ANCHORS, STEP_SCORES = 1 << 15, 1 << 12, 1 << 22


# --- packed keys: bytes that sort as (anchor, descending score, kind, id)

def pack_int(v: int) -> bytes:
    """An integer of any size as bytes that sort in its order."""
    m = abs(v)
    body = m.to_bytes((m.bit_length() + 7) // 8)
    if v < 0:
        return (0x8000 - len(body)).to_bytes(2) + bytes(255 - b for b in body)
    return (0x8000 + len(body)).to_bytes(2) + body


def unpack_int(key: bytes, at: int) -> tuple[int, int]:
    """The integer packed at ``at`` and where it ends."""
    n = int.from_bytes(key[at:at + 2]) - 0x8000
    body = key[at + 2:at + 2 + abs(n)]
    v = int.from_bytes(body) if n >= 0 else -int.from_bytes(bytes(255 - b for b in body))
    return v, at + 2 + abs(n)


def pack(anchor: int, score: int, negative: bool, row_id: int | None) -> bytes:
    """Key of a pair; a NULL id comes last."""
    return anchor.to_bytes(8) + pack_int(-score) + bytes([negative]) + (b"\xff\xff" if row_id is None else pack_int(row_id))


def unpack(key: bytes) -> tuple[int, int, bool, int | None]:
    score, at = unpack_int(key, 8)
    return int.from_bytes(key[:8]), -score, key[at] == 1, None if key[at + 1:] == b"\xff\xff" else unpack_int(key, at + 1)[0]


# --- scores of a cell

def quantised(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    """floor(scale * x) per component as a matrix, short vectors padded with
    zeros: floats where products and sums stay exact in them, else integers of any size."""
    lists = vectors.combine_chunks()
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    dim = int(sizes.max(initial=0))
    with np.errstate(over="ignore"):
        floors = np.floor(values * scale)
    if len(floors) and np.abs(floors).max() ** 2 * max(dim, 1) >= 1 << 52:
        floors = np.array([math.floor(x * scale) if abs(x) < 1 << 53 else int(x) * scale for x in values.tolist()], object)
    out = np.zeros((len(sizes), dim), floors.dtype)
    where = np.arange(dim) < sizes[:, None]
    out[where] = floors[offsets[0]:offsets[-1]]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``."""
    dim = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (a, b))
    exact = a.dtype != object and b.dtype != object and (
        np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(dim, 1) < 1 << 53)
    if exact:
        return (a @ b.T).astype(np.int64)
    return np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a], object).reshape(len(a), len(b))


def best(score: np.ndarray, n: int) -> np.ndarray:
    """Indices of the first n by descending score, ties by index; ``score``
    stands in id order."""
    if len(score) <= n:
        return np.argsort(-score, kind="stable")
    if score.dtype == object:
        return np.argsort(-score, kind="stable")[:n]
    least = np.partition(score, len(score) - n)[len(score) - n]
    some = np.flatnonzero(score >= least)
    return some[np.argsort(-score[some], kind="stable")][:n]


def _window(top: int) -> tuple[int, int]:
    """Least and greatest score of a negative for a positive of score ``top``."""
    return -(-LOW * top // WHOLE), HIGH * top // WHOLE


def _cell(negatives: bool, scale: int, n_positives: int, n_negatives: int):
    """cogroup step over (anchors, rows) of a cell: packed keys of the pairs
    that may count."""

    def step(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        keys: list[bytes] = []
        if anchors.num_rows and rows.num_rows:
            ids = rows["id"].to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            rows, ids = rows.take(pa.array(order)), [ids[i] for i in order]
            labels, number = rows["label"].to_numpy(), rows["row"].to_numpy()
            b, a = quantised(rows["v"], scale), quantised(anchors["v"], scale)
            own_label, own = anchors["label"].to_pylist(), anchors["row"].to_pylist()
            tops = anchors["tops"].to_pylist()
            chunk = max(1, STEP_SCORES // len(ids))
            for at in range(0, len(own), chunk):
                for k, s in enumerate(scores(a[at:at + chunk], b), at):
                    same = labels == own_label[k]
                    if not negatives:
                        pick = np.flatnonzero(same & (number != own[k]))
                        found = pick[best(s[pick], n_positives)].tolist()
                    else:
                        pick = np.flatnonzero(~same)
                        pick = pick[np.argsort(-s[pick], kind="stable")]
                        down, found = -s[pick], set()
                        for top in tops[k] or ():
                            low, high = _window(unpack(top)[1])
                            start, end = np.searchsorted(down, -high, "left"), np.searchsorted(down, -low, "right")
                            found.update(pick[start:min(end, start + n_negatives)].tolist())
                    keys += [pack(own[k], int(s[i]), negatives, ids[i]) for i in found]
        return pa.table({"anchor": pa.array([int.from_bytes(k[:8]) for k in keys], pa.int64()), "key": pa.array(keys, pa.binary())})

    return step


def _stream_tops(n: int):
    """The first n keys of every anchor, of keys in order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, 0
        for batch in batches:
            keys = []
            for key in batch.column(0).to_pylist():
                anchor, seen = (anchor, seen + 1) if key[:8] == anchor else (key[:8], 1)
                if seen <= n:
                    keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array([int.from_bytes(k[:8]) for k in keys], pa.int64()), pa.array(keys, pa.binary())], names=["anchor", "key"])

    return step


def _stream_negatives(n: int):
    """Keys in order to result rows; holds the open windows of one anchor."""
    names = ["anchor", "positive", "rank", "negative", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def long(v: int) -> int | None:
        return v if -1 << 63 <= v < 1 << 63 else None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for batch in batches:
            out: list[tuple] = []
            for key in batch.column(0).to_pylist():
                at, score, negative, row_id = unpack(key)
                if at != anchor:
                    anchor, windows = at, []
                if not negative:
                    windows.append([*_window(score), score, row_id, 0])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1]:
                        w[4] += 1
                        out.append((at, w[3], w[4], row_id, long(w[2]), long(score)))
                windows = [w for w in windows if w[4] < n and w[0] <= score]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)], names=names)

    return step


def _sorted_by_key(keys: DataFrame) -> DataFrame:
    """Secondary sort: all keys of an anchor in one partition, in order."""
    return keys.repartition("anchor").sortWithinPartitions("key").select("key")


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                   label: Column | None = None, scale: int = SCALE, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: the condition for the query set; ``label``: an expression to
    take instead of the label column.  Scores are integer inner products of
    the components floor(scale * x).  A row with a NULL label or vector, or
    with a NULL or non-finite component takes no part; a vector that is
    shorter than another counts as padded with zeros; a NULL id is no anchor
    and comes last among equal scores.  Repeated rows are rows of their own,
    so a copy of the anchor is its positive; scores beyond 64 bits rank
    exactly and are returned as NULL; an empty table gives no rows.
    """
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), (F.col(label_col) if label is None else label).cast("bigint").alias("label"),
                          x.alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    known = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(known, F.lit(False)))
    # Numbered as read back from the files, so that a repeated task numbers alike.
    rows = written(rows, "vectors").withColumn("row", F.monotonically_increasing_id())
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("is_anchor") & F.col("id").isNotNull())).first()
    grid_a = max(1, -(-n_anchors // cell_anchors))
    grid_r = max(1, -(-n // cell_rows), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // 2048)))
    deal = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    anchors = written(rows.filter("is_anchor AND id IS NOT NULL").select("row", "id", "label", "v"), "anchors")
    dealt_rows = rows.select("id", "label", "v", "row", deal(grid_r).alias("r"), every(grid_a).alias("a"))

    def grid(anchors: DataFrame, negatives: bool) -> DataFrame:
        dealt = anchors.select("row", "label", "v", "tops", deal(grid_a).alias("a"), every(grid_r).alias("r"))
        cells = dealt.groupBy("a", "r").cogroup(dealt_rows.groupBy("a", "r"))
        return cells.applyInArrow(_cell(negatives, scale, n_positives, n_negatives), "anchor bigint, key binary")

    none = F.lit(None).cast("array<binary>")
    tops = written(_sorted_by_key(grid(anchors.withColumn("tops", none), False)).mapInArrow(_stream_tops(n_positives), "anchor bigint, key binary"), "positives")
    windows = tops.groupBy("anchor").agg(F.collect_list("key").alias("tops"))
    keys = written(tops.unionByName(grid(anchors.join(windows, F.col("row") == F.col("anchor")), True)), "scores")
    schema = "anchor bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    out = _sorted_by_key(keys).mapInArrow(_stream_negatives(n_negatives), schema)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return out.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
