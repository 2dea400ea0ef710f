"""Matrix product over coordinate-form matrices ``(row_id, col_id, v)``.

``matmul_coo`` is the relational form: equi-join on the inner index and a
(partial) hash aggregate; its cost is sum_k nnz(A[:,k]) * nnz(B[k,:]) rows, the
right algorithm for sparse input.  ``matmul_tiled`` is the dense form: cells
are grouped into square tiles of at most ``block``² entries, tiles meet by
the inner tile index, each tile pair is multiplied with numpy inside the
task, and the products are summed as strips of cells by a grouped aggregate.
``matmul`` counts what either would do and takes the cheaper one.

One rule for both: a cell whose value is NULL, or that is not there, takes
part in no product; repeated cells add up; infinities and NaN follow IEEE
arithmetic over the cells that are there.  Both emit exactly the cells with
at least one matching inner index.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of one strip: the columns that the sum of the tiled form works on.
STRIP = 32

#: Rows of a join that one task makes, on average: up to 120 bytes each in its aggregate.
TASK_ROWS = 1 << 20

#: Cells that one task of a grouped matrix holds, on average: it may group them several times.
TASK_CELLS = 1 << 18

#: Partitions of one shuffle, at most (beyond, a task gets more rows).
MOST_TASKS = 100_000


def _present(m: DataFrame) -> DataFrame:
    return m.filter(F.col("row_id").isNotNull() & F.col("col_id").isNotNull() & F.col("v").isNotNull())


def _right_side(df: DataFrame, small_right: bool) -> DataFrame:
    """Broadcast only on the caller's word that the right matrix is small;
    otherwise a sort-merge join, so no static size estimate can turn a large
    matrix into a broadcast."""
    return F.broadcast(df) if small_right else df.hint("merge")


def tasks_for(df: DataFrame, rows: int, per_task: int) -> int:
    """Partitions for ``rows`` rows: ``per_task`` in each, at least one per core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return min(max(cores, -(-int(rows) // per_task)), max(cores, MOST_TASKS))


def _per_inner(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(k, m, n, rows)``: how many rows of ``a`` and of ``b`` have each ``k``, and
    m * n; both in one aggregate, so that no task sorts and joins what it has grouped."""
    ones = a.selectExpr("k", "1 AS m", "0 AS n").union(b.selectExpr("k", "0 AS m", "1 AS n"))
    counts = ones.groupBy("k").agg(F.sum("m").alias("m"), F.sum("n").alias("n"))
    return counts.select("*", (F.col("m").cast("double") * F.col("n")).alias("rows"))


def _join_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows that a join by ``k`` makes, and indices too heavy for one task."""
    return _per_inner(a, b).agg(F.coalesce(F.sum("rows"), F.lit(0.0)).alias("rows"), F.count_if(F.col("rows") > TASK_ROWS).alias("hot"))


def _deal(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``deal``, so that no inner index and deal makes
    many more than ``TASK_ROWS`` rows: of a heavy index, the side with more
    cells is dealt out by its cells and the other one copied to each deal.

    At most one index per ``TASK_ROWS`` rows of the join is heavy, so their
    list is small whatever the matrices.
    """
    heavy = _per_inner(a, b).filter(F.col("rows") > TASK_ROWS).select(
        F.col("k").alias("hk"), (F.col("m") >= F.col("n")).alias("deal_a"),
        F.least(F.ceil(F.col("rows") / TASK_ROWS), F.greatest("m", "n")).cast("int").alias("deals"))

    def side(m, dealt):
        m = m.join(F.broadcast(heavy), F.col("k") == F.col("hk"), "left")
        one = F.array(F.pmod(F.xxhash64("o", "v"), F.col("deals")).cast("int"))
        deals = F.when(F.col("hk").isNull(), F.array(F.lit(0))).when(dealt, one).otherwise(F.sequence(F.lit(0), F.col("deals") - 1))
        return m.select("k", "o", "v", F.explode(deals).alias("deal"))

    return side(a, F.col("deal_a")), side(b, ~F.col("deal_a"))


def matmul_coo(a: DataFrame, b: DataFrame, small_right: bool = False, cost: "ProductCost | None" = None) -> DataFrame:
    """C = A·B with C[r, c] = sum_k A[r, k]·B[k, c] (rectangular allowed).

    The join goes to as many tasks as its rows ask for (``TASK_ROWS`` in
    each), not as its input does: the aggregate of a task holds an entry for
    nearly every row that the join makes there.  An inner index that alone
    makes more is dealt out to several.  The rows are counted first, unless
    ``cost`` has them.
    """
    # the same columns in the same order: of a matrix times its transpose, one shuffle serves both sides
    left = _present(a).select(F.col("col_id").alias("k"), F.col("row_id").alias("o"), "v")
    right = _present(b).select(F.col("row_id").alias("k"), F.col("col_id").alias("o"), "v")
    on = ["k"]
    if not small_right:
        rows, hot = (cost.join_rows, cost.hot) if cost else _join_rows(left, right).first()
        if hot:
            left, right = _deal(left, right)
            on.append("deal")
        tasks = tasks_for(a, rows, TASK_ROWS)
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    right = _right_side(right.select(*on, F.col("o").alias("col_id"), F.col("v").alias("__b")), small_right)
    return (left.select(*on, F.col("o").alias("row_id"), F.col("v").alias("__a")).join(right, on)
            .groupBy("row_id", "col_id").agg(F.sum(F.col("__a") * F.col("__b")).alias("v")))


def _tiles(m: DataFrame, row_tile: str, col_tile: str, block: int) -> DataFrame:
    """One row per tile: its indices and its cells, repeats added up.

    Cells are shuffled once, by tile; the sum of repeats and the gathering
    of at most block² cells both work on that partitioning.
    """
    b = int(block)
    # floor division and a non-negative offset, also for negative indices
    local = F.expr(f"pmod(row_id, {b}) * {b} + pmod(col_id, {b})")
    cells = _present(m).select(F.expr(f"(row_id - pmod(row_id, {b})) div {b}").alias(row_tile),
                               F.expr(f"(col_id - pmod(col_id, {b})) div {b}").alias(col_tile),
                               local.cast("int").alias("i"), F.col("v").cast("double").alias("v"))
    return (cells.repartition(row_tile, col_tile)
            .groupBy(row_tile, col_tile, "i").agg(F.sum("v").alias("v"))
            .groupBy(row_tile, col_tile)
            .agg(F.collect_list(F.struct("i", "v")).alias("cells"))
            .select(row_tile, col_tile,
                    F.col("cells.i").alias(f"{row_tile}_{col_tile}_i"),
                    F.col("cells.v").alias(f"{row_tile}_{col_tile}_v")))


def _tile_products(block: int, width: int, strips: int):
    """mapInArrow step: tile pairs to strips ``(row_id, strip, c0, c1, ...)``."""
    import numpy as np
    import pyarrow as pa

    def dense(index, values):
        cells, on = np.zeros(block * block), np.zeros(block * block, bool)
        cells[index], on[index] = values, True
        return cells.reshape(block, block), on.reshape(block, block)

    def product(a, a_on, b, b_on):
        if np.isfinite(a).all() and np.isfinite(b).all():
            full = a_on.all() and b_on.all()
            return a @ b, np.ones((block, block), bool) if full else a_on.astype(float) @ b_on > 0
        # A zero that stands for an absent cell must not meet an infinity.
        out, on = np.zeros((block, block)), np.zeros((block, block), bool)
        for k in np.flatnonzero(a_on.any(axis=0) & b_on.any(axis=1)):
            cell = np.ix_(a_on[:, k], b_on[k])
            out[cell] += np.outer(a[a_on[:, k], k], b[k, b_on[k]])
            on[cell] = True
        return out, on

    names = ["row_id", "strip", *[f"c{j}" for j in range(width)]]

    def run(batches):
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            for p in range(batch.num_rows):
                sides = []
                for side in ("bi_bk", "bk_bj"):
                    sides += dense(col[f"{side}_i"][p].values.to_numpy(), col[f"{side}_v"][p].values.to_numpy())
                with np.errstate(all="ignore"):
                    values, on = product(*sides)
                pad = ((0, 0), (0, strips * width - block))
                values, on = (np.pad(x, pad).reshape(block * strips, width) for x in (values, on))
                rows = np.repeat(np.arange(block) + col["bi"][p].as_py() * block, strips)
                which = np.tile(np.arange(strips) + col["bj"][p].as_py() * strips, block)
                some = on.any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[some]), pa.array(which[some]),
                     *[pa.array(values[some, j], mask=~on[some, j], from_pandas=False) for j in range(width)]], names=names)

    return run


def _spread(a: DataFrame, b: DataFrame, block: int) -> tuple[int, bool]:
    """(copies, whether the right side is the one copied): how often one side's
    tiles must be repeated so that few inner tiles still fill all tasks.

    One pass over the inner index of ``b``; only if that is short, also the
    number of cells of both sides, to copy the smaller one.
    """
    tasks = 2 * a.sparkSession.sparkContext.defaultParallelism
    low, high, cells = b.agg(F.min("row_id"), F.max("row_id"), F.count(F.lit(1))).first()
    inner = 1 if low is None else (high - low) // block + 1
    if inner >= tasks:
        return 1, True
    return -(-tasks // inner), cells <= a.count()


def matmul_tiled(a: DataFrame, b: DataFrame, block: int = 128, small_right: bool = False) -> DataFrame:
    """C = A·B in tiles of ``block`` × ``block`` (see module docstring).

    A tile holds at most ``block``² cells whatever the matrix size (the
    default 128 gives 16384 cells, about 0.4 MB per tile pair), so no
    group grows with the data, and the tile pairs reach numpy in Arrow
    batches bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``
    (64 MB by default), so Python worker memory stays bounded too.  With few
    inner tiles (a tall matrix times a small one) the smaller side's tiles
    are copied and the other side's dealt over the copies, so that the
    products fill all tasks.
    """
    width = min(STRIP, block)
    strips = -(-block // width)
    copies, copy_right = (1, True) if small_right else _spread(a, b, block)
    ta, tb = _tiles(a, "bi", "bk", block), _tiles(b, "bk", "bj", block)
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    dealt = lambda c: F.pmod(F.hash(c), F.lit(copies)).alias("copy")
    ta = ta.select("*", dealt("bi") if copy_right else every)
    tb = tb.select("*", every if copy_right else dealt("bj"))
    pairs = ta.join(_right_side(tb, small_right), ["bk", "copy"]).select("bi", "bj", "bi_bk_i", "bi_bk_v", "bk_bj_i", "bk_bj_v")
    columns = [f"c{j}" for j in range(width)]
    schema = "row_id long, strip long, " + ", ".join(f"{c} double" for c in columns)
    sums = pairs.mapInArrow(_tile_products(block, width, strips), schema).groupBy("row_id", "strip").agg(*[F.sum(c).alias(c) for c in columns])
    cells = sums.select("row_id", "strip", F.posexplode(F.array(*columns)).alias("j", "v")).filter(F.col("v").isNotNull())
    col_id = F.expr(f"(strip - pmod(strip, {strips})) div {strips} * {block} + pmod(strip, {strips}) * {width} + j")
    return cells.select("row_id", col_id.alias("col_id"), "v")


#: Multiply-adds of a tile product that take as long as one row of the join
#: and its aggregate (``bench.py``: about 2e9 and 8e6 a second and core).
ROW_COST = 256


class ProductCost(NamedTuple):
    """What the two forms of a product would do, and the cheaper one; ``hot``
    inner indices make more rows of the join than one task should."""
    join_rows: int
    tile_ops: int
    method: str
    hot: int = 0


def product_cost(a: DataFrame, b: DataFrame, block: int = 128) -> ProductCost:
    """Measure a product: small aggregates of each side (one action).

    The join makes nnz(A[:,k]) * nnz(B[k,:]) rows for each inner index k; the
    tiled form block³ multiply-adds for each pair of tiles that meet.  Counts
    are taken per inner index, and of distinct tiles per inner tile, so a
    matrix that is dense in a few places counts as what it is there.
    """
    tile = lambda c: F.expr(f"({c} - pmod({c}, {int(block)})) div {int(block)}")
    cells = [_present(m).select(F.col(inner).cast("bigint").alias("k"), tile(outer).alias("o"))
             for m, inner, outer in ((a, "col_id", "row_id"), (b, "row_id", "col_id"))]
    tiles = [m.select(tile("k").alias("k"), "o").distinct() for m in cells]
    rows, hot, pairs, _ = _join_rows(*cells).crossJoin(_join_rows(*tiles).toDF("pairs", "hot_tiles")).first()
    ops = int(pairs) * block ** 3
    return ProductCost(int(rows), ops, "join" if rows * ROW_COST <= ops else "tiled", hot)


def matmul(a: DataFrame, b: DataFrame, block: int = 128) -> DataFrame:
    """C = A·B by the form that is cheaper for these matrices (measures them,
    see :func:`product_cost`): a dense product never takes the join, which
    makes a row for every scalar product; a sparse one never fills tiles."""
    cost = product_cost(a, b, block)
    return matmul_coo(a, b, cost=cost) if cost.method == "join" else matmul_tiled(a, b, block)


def array_rows_to_coo(df: DataFrame, id_col: str, arr: str, transpose: bool = False) -> DataFrame:
    """Rows of arrays as a coordinate matrix: row = ``id_col``, column = position."""
    long = df.select(F.col(id_col).cast("long").alias("__id"), F.posexplode(arr).alias("__pos", "v"))
    r, c = ("__pos", "__id") if transpose else ("__id", "__pos")
    return long.select(F.col(r).cast("long").alias("row_id"), F.col(c).cast("long").alias("col_id"),
                       F.col("v").cast("double").alias("v"))
