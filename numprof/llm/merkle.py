"""Merkle manifest of a data set, with inclusion proofs by pointer jumping.

Every row is a leaf; the leaves of a source make a tree of runs of ``FAN``
nodes, the tops of the sources make the tree that ends in the root.

1. Leaves are range-sorted by (source, id); their places within a source come
   from the row numbers of the sorted files and one sum per file and source.
2. Runs become parents level by level, each level a ``FAN``-th of the one
   below.  The leaves of a run stay together in one row from here on: they
   share all ancestors.
3. Every inner node starts with its parent and the siblings on the way there
   (its segment).  Rounds of self-joins replace the ancestor by the ancestor's
   ancestor and append its segment, so the distance doubles until all reach
   the root: log2(depth) joins of the inner nodes, a 15th of the rows.
4. A run's leaves take the segment of their run behind their own siblings.

All of it is DataFrame functions.  No level, source or tree is held in one
task: a run is, and a node's segments, at most FAN - 1 digests a level.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from numprof.plans.stats_join import attach_by_keys

from .common import written

#: Nodes that make one parent.
FAN = 16
#: Fields of a leaf, in order; the first two are the id and the source.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves for one sorted file.
FILE_ROWS = 1 << 20


class Manifest(NamedTuple):
    """``leaves``: one row per run of leaves, ``kids`` (array of ``id``,
    ``leaf``, ``other``: the digest of the changed row or NULL), its ``node``
    and source; ``nodes``: (node, anc, seg), an inner node, its parent and the
    siblings on the way; ``subroots``: (source, subroot, n_leaves); ``root``:
    the root digest, None of an empty table."""
    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def field(col: Column) -> Column:
    """``-`` for NULL, else byte count, ``:`` and value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``pos``, the place from 0 within ``group`` by ``order``,
    and ``total``, the rows of the group; NULL first, equal rows in any order.

    Rows are range-sorted into files; a row's place is its number in its file
    less the first of its group there, plus the group's rows in earlier files.
    """
    n = rows.count()
    # Equal rows are spread over files too: the salt stands last in the order.
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "__salt")]
    spread = rows.withColumn("__salt", F.xxhash64(F.monotonically_increasing_id()))
    files = max(1, -(-n // FILE_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, n // 4096))
    ordered = spread.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("__salt")
    ordered = written(ordered.withColumns({"__at": F.monotonically_increasing_id(), "__file": F.spark_partition_id()}), "ordered")
    counts = ordered.groupBy("__file", group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    in_group = Window.partitionBy(group)
    before = F.sum("__n").over(in_group.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__file", group, (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
                           F.sum("__n").over(in_group).alias("total"))
    out = attach_by_keys(ordered, written(counts, "places"), ["__file", group])
    return out.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__file", "__shift")


def _siblings(digests: Column, k: Column) -> Column:
    """What stands left and right of number ``k`` (from 0), each joined."""
    return F.struct(F.array_join(F.slice(digests, F.lit(1), k), "").alias("l"),
                    F.array_join(F.slice(digests, k + 2, F.lit(FAN)), "").alias("r"))


def _name(tree: Column, level: int, pos: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(str(level)), pos.cast("string"))


def _runs(nodes: DataFrame, kid: Column) -> DataFrame:
    """(tree, pos, total, kids) of the runs of (tree, pos, total, ...)."""
    grouped = nodes.groupBy("tree", F.expr(f"pos div {FAN}").alias("up"), "total")
    kids = F.sort_array(F.collect_list(F.struct(F.expr(f"pos % {FAN}").alias("k"), kid.alias("v"))))
    return grouped.agg(kids.alias("kids")).select("tree", F.col("up").alias("pos"), "total", F.col("kids.v").alias("kids"))


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """From (tree, pos, total, h, node) up to one node a tree: the tops
    (tree, h, node), and the edges (node, anc, seg) of each level."""
    tops, edges, level = [], [], 1
    while True:
        tops.append(nodes.filter("total = 1").select("tree", "h", "node"))
        nodes = nodes.filter("total > 1")
        if nodes.isEmpty():
            break
        runs = written(_runs(nodes, F.struct("h", "node")).withColumn("anc", _name(F.col("tree"), level, F.col("pos"))), "runs")
        edges.append(runs.select("anc", F.col("kids.h").alias("hs"), F.posexplode("kids").alias("k", "kid"))
                     .select(F.col("kid.node").alias("node"), "anc", F.array(_siblings(F.col("hs"), F.col("k"))).alias("seg")))
        nodes = runs.select("tree", "pos", F.expr(f"(total + {FAN - 1}) div {FAN}").alias("total"),
                            F.sha2(F.array_join("kids.h", ""), 256).alias("h"), F.col("anc").alias("node"))
        level += 1
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out, edges


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, changed: tuple[Column, str, Column] | None = None) -> Manifest:
    """The tree of ``docs``; ``fields``: the columns of a leaf, id and source first.

    ``changed`` (condition, column, value) names rows whose leaf is digested a
    second time with another value of that column, to be checked by
    :func:`proofs`.  NULL ids and sources come first; a NULL source is a
    source of its own; equal rows are leaves of their own, side by side; other
    columns of ``docs`` are ignored; an empty table has no root.
    """
    id_col, source = fields[:2]
    cols = [F.col(c) for c in fields]
    other = F.lit(None).cast("string")
    if changed is not None:
        when, name, value = changed
        other = F.when(when, leaf_digest([value if c == name else F.col(c) for c in fields]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), leaf_digest(cols).alias("leaf"), other.alias("other"))
    leaves = placed(rows, "source", ["id", "leaf"])
    # Sources are numbered in their order, by bytes, as trees of the runs.
    sources = leaves.groupBy("source").agg(F.max("total").alias("n"))
    sources = written(placed(sources.withColumn("all", F.lit(0)), "all", ["source"]), "sources")
    numbered = attach_by_keys(leaves, sources.select("source", F.col("pos").alias("tree")), ["source"])
    kid = F.struct("id", "leaf", "other")
    runs = _runs(numbered, kid)
    runs = written(runs.withColumn("node", _name(F.col("tree"), 0, F.col("pos"))), "leaf-runs")
    # A lone leaf is not digested again.
    h = F.when(F.col("total") == 1, F.col("kids")[0]["leaf"]).otherwise(F.sha2(F.array_join("kids.leaf", ""), 256))
    first = runs.select("tree", "pos", F.expr(f"(total + {FAN - 1}) div {FAN}").alias("total"), h.alias("h"), "node")
    tops, edges = _climb(first)
    tops = written(tops, "subroots")
    joined = tops.join(sources.select(F.col("pos").alias("p"), "source", "n", F.col("total").alias("trees")), F.col("tree") == F.col("p"))
    top_nodes = joined.select(F.lit("root").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("total"), "h", "node")
    root, more = _climb(written(top_nodes, "tops"))
    root = root.first()
    all_edges = None
    for e in edges + more:
        all_edges = e if all_edges is None else all_edges.unionByName(e)
    if all_edges is None:
        all_edges = first.limit(0).select("node", F.col("node").alias("anc"), F.array(F.struct(F.lit("").alias("l"), F.lit("").alias("r"))).alias("seg"))
    return Manifest(runs, written(all_edges, "edges"), joined.select("source", F.col("h").alias("subroot"), F.col("n").alias("n_leaves"), "tree"),
                    root["h"] if root else None)


def jump(nodes: DataFrame) -> DataFrame:
    """(node, seg): from (node, anc, seg) with a node's parent, the segments of
    all steps to the top, joined by doubling the ancestors' distance."""
    while True:
        ends = nodes.select(F.col("node").alias("anc"), F.col("anc").alias("__anc"), F.col("seg").alias("__seg"))
        # Only nodes that are an ancestor of some node are looked up.
        ends = ends.join(nodes.select("anc").distinct(), "anc", "left_semi")
        ends = written(ends, "ancestors")
        if ends.isEmpty():
            return nodes.select("node", "seg")
        far = attach_by_keys(nodes, ends, ["anc"])
        nodes = written(far.select("node", F.coalesce("__anc", "anc").alias("anc"),
                                   F.when(F.col("__seg").isNull(), F.col("seg")).otherwise(F.concat("seg", "__seg")).alias("seg")), "jumped")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (siblings left and right, per level) lead to."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["l"], h, step["r"]), 256))


def proofs(m: Manifest) -> DataFrame:
    """Per leaf: id, source, leaf, subroot, root, ``path`` (siblings left and
    right, per level from the leaf up), proof_sha256 (the digest of the
    siblings in that order), folded_root (from the changed leaf where there is
    one) and verified (whether it is the root)."""
    up = jump(m.nodes)
    runs = attach_by_keys(m.leaves, up, ["node"])
    runs = attach_by_keys(runs, m.subroots, ["tree"])
    none = F.array().cast("array<struct<l:string,r:string>>")
    leaves = F.col("kids.leaf")
    own = F.when(F.col("total") > 1, F.array(_siblings(F.col("leaves"), F.col("k")))).otherwise(none)
    rows = runs.select("source", "subroot", "total", F.coalesce("seg", none).alias("seg"), leaves.alias("leaves"), F.posexplode("kids").alias("k", "kid"))
    rows = rows.select("source", "subroot", "kid.id", "kid.leaf", "kid.other", F.concat(own, "seg").alias("path"))
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    joined = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    root = F.lit(m.root)
    return rows.select("id", "source", "leaf", "subroot", root.alias("root"), "path", F.sha2(joined, 256).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == root)
