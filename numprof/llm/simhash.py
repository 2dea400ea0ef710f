"""SimHash near-duplicates through vantage-point trees.

1. One pass over the texts gives a 64-bit fingerprint per row; copies are
   folded into distinct fingerprints before anything else is shuffled.
2. A vantage-point tree over a bounded sample of the fingerprints cuts the
   Hamming space into shards.  A fingerprint lives in one shard and visits
   the others that its ball can reach, by the triangle bounds of the tree.
   Shards that are still too large are cut again, each by a tree of its own
   sample, until none is; guests of a shard are dealt out to several tasks.
3. Each shard searches a vantage-point tree of its own for exact pairs and
   returns, instead of pairs, one link from each fingerprint to the smallest
   one it is connected with there.
4. Connected components of these links: each task replaces its links by
   stars, then large-star and small-star steps alternate over what the tasks
   have left, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprof.plans.stats_join import attach_by_keys

from .common import fresh, released, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Distinct fingerprints that a shard should hold; one with over SHARD_SLACK
#: times as many is cut again.  Guests beyond GUEST_RATIO times as many go to
#: further tasks, each with the residents.
SHARD_ROWS, SHARD_SLACK, GUEST_RATIO = 8192, 4, 64
#: Fingerprints of the sample that a shard tree is built from, per shard and
#: at most; the first tree is the only thing sent to every task.
SAMPLE_PER_SHARD, MAX_SAMPLE = 64, 1 << 20
#: Rows of a large shard that a task cuts at once.
CUT_ROWS = 1 << 17
#: Residents of a leaf within a shard, compared with its visitors directly.
LEAF_ROWS = 128
#: Links that a task turns into stars at once.
LINK_ROWS = 1 << 20
#: Hashes whose bits are counted at once.
STEP_HASHES = 1 << 16


def fingerprint(text: str | None, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text: a bit is 1 if set in over half of the shingle hashes.

    Only A-Z are lower-cased; ``bytes.split`` cuts at ASCII white space.  A
    text of fewer than k words is one shingle; without words it has print 0.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), STEP_HASHES):
        step = h[at:at + STEP_HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(step, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _prints(k: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])
    return step


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the print as a signed long."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(released(_prints(k)), f"id {d.schema['id'].dataType.simpleString()}, fp bigint")


# --- vantage-point trees over arrays of unsigned 64-bit prints

def _distance(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point).astype(np.int16)


def _vantage(prints: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and radius that cut ``prints`` most evenly, with few of
    them near the boundary; None if they cannot be cut."""
    best = None
    sample = prints if len(prints) <= 512 else rng.choice(prints, 512, replace=False)
    for point in rng.choice(prints, min(6, len(prints)), replace=False):
        d = _distance(sample, point)
        mu = int(np.median(d))
        if not (d > mu).any():
            mu = int(d.max()) - 1
        if mu < 0:
            continue
        inner = np.mean(d <= mu)
        score = min(inner, 1 - inner) - 0.5 * np.mean(np.abs(d - mu - 0.5) < MAX_BITS)
        if 0 < inner < 1 and (best is None or score > best[0]):
            best = (score, point, mu)
    return best and best[1:]


def shard_tree(sample: np.ndarray, leaf: int, seed: int = SEED) -> list[tuple]:
    """Nodes (point, radius, inner child, outer child); a child below 0 is the
    shard with number -1 - child.  A sample of one shard gives no node."""
    rng, nodes, shards = np.random.default_rng(seed), [], [0]

    def build(prints: np.ndarray) -> int:
        cut = _vantage(prints, rng) if len(prints) > leaf else None
        if cut is None:
            shards[0] += 1
            return -shards[0]
        d = _distance(prints, cut[0])
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (*cut, build(prints[d <= cut[1]]), build(prints[d > cut[1]]))
        return at

    build(sample)
    return nodes


def route(nodes: list[tuple], prints: np.ndarray, r: int, home: bool = True) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Yields (shard, indices of prints, whether they live there or visit).

    Of a pair within r bits that a node separates, the outer print visits the
    inner side; a visitor goes down every side that its ball touches.  So one
    of the two always meets the other in the other's home shard.  Without
    ``home`` all prints come as visitors.
    """
    todo = [(0 if nodes else -1, np.arange(len(prints)), home)]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if node < 0:
            yield -1 - node, at, home
            continue
        point, mu, inner, outer = nodes[node]
        d = _distance(prints[at], point)
        if home:
            todo += [(inner, at[d <= mu], True), (outer, at[d > mu], True), (inner, at[(d > mu) & (d <= mu + r)], False)]
        else:
            todo += [(inner, at[d <= mu + r], False), (outer, at[d > mu - r], False)]


def near_pairs(prints: np.ndarray, homes: np.ndarray, guests: np.ndarray, r: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within r bits, of two homes or of a home and a guest, found
    by a vantage-point tree over ``homes``; guests are pruned by its bounds."""
    todo = [(homes, guests)]
    while todo:
        h, g = todo.pop()
        cut = _vantage(prints[h], rng) if len(h) > LEAF_ROWS else None
        if cut is None:
            other = np.concatenate([h, g])
            for at in range(0, len(h), LEAF_ROWS):
                block = h[at:at + LEAF_ROWS]
                for to in range(0, len(other), 1 << 14):
                    part = other[to:to + (1 << 14)]
                    i, j = np.nonzero(np.bitwise_count(prints[block][:, None] ^ prints[part][None, :]) <= r)
                    yield block[i], part[j]
            continue
        point, mu = cut
        dh, dg = _distance(prints[h], point), _distance(prints[g], point)
        todo.append((h[dh <= mu], np.concatenate([g[dg <= mu + r], h[(dh > mu) & (dh <= mu + r)]])))
        todo.append((h[dh > mu], g[dg > mu - r]))


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n items the smallest index of its component."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            lo, hi = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            np.minimum.at(root, hi, lo)
            while (root[root] != root).any():
                root = root[root]
    return root


def _placed(prints: np.ndarray, nodes: list[tuple], r: int, shard: str = "", home: bool = True) -> Iterator[pa.RecordBatch]:
    """(shard, fp, home) of ``prints`` that live in ``shard``, or visit it,
    placed in the shards that ``nodes`` cut it into."""
    for part, at, lives in route(nodes, prints, r, home):
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{shard}{part}."] * len(at), pa.string()), pa.array(prints[at].view(np.int64)), pa.array(np.full(len(at), lives))],
            names=["shard", "fp", "home"])


def _first_cut(nodes: list[tuple], r: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _placed(batch.column(0).to_numpy().view(np.uint64), nodes, r)
    return step


#: Columns of the nodes of a tree.
_TREE = ("point", "radius", "inside", "outside")


def _trees(leaf: int):
    def build(sample: pa.Table) -> pa.Table:
        nodes = shard_tree(np.sort(sample["fp"].to_numpy()).view(np.uint64), leaf)
        point, *rest = zip(*nodes) if nodes else ((),) * 4
        columns = [np.array(point, np.uint64).view(np.int64), *(np.array(x, np.int64) for x in rest)]
        lists = [pa.array([c.tolist()], pa.list_(pa.int64())) for c in columns]
        return pa.table([pa.array([sample["shard"][0].as_py()]), *lists], names=["t", *_TREE])
    return build


def _next_cut(r: int):
    def cut(rows: pa.Table, trees: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.bool_())], names=["shard", "fp", "home"])
        shard, tree = rows["shard"][0].as_py(), [np.array(trees[name][0].as_py(), np.int64) for name in _TREE]
        nodes = list(zip(tree[0].view(np.uint64), *(x.tolist() for x in tree[1:])))
        prints, home = rows["fp"].to_numpy().view(np.uint64), rows["home"].to_numpy()
        found = [b for lives in (True, False) for b in _placed(prints[home == lives], nodes, r, shard, lives)]
        return pa.Table.from_batches(found)
    return cut


def _cut_again(placed: DataFrame, large: DataFrame, level: int, r: int, shard_rows: int) -> DataFrame:
    """``placed`` with the shards of ``large(s, homes, guests)`` cut by trees of their
    own samples.  A group is the sample of one shard, or its tree and
    about CUT_ROWS of its rows."""
    rows = placed.join(large, F.col("shard") == F.col("s"))
    wanted = F.least(F.lit(MAX_SAMPLE), SAMPLE_PER_SHARD * F.ceil(F.col("homes") / shard_rows))
    drawn = F.pmod(F.xxhash64("fp", F.lit(level)), F.lit(1 << 30)) < wanted / F.col("homes") * (1 << 30)
    trees = rows.filter(F.col("home") & drawn).select("shard", "fp").groupBy("shard").applyInArrow(
        _trees(SAMPLE_PER_SHARD), "t string, " + ", ".join(f"{x} array<bigint>" for x in _TREE))
    trees = written(trees.filter(F.size("point") > 0), "shard-trees")
    parts = F.ceil((F.col("homes") + F.col("guests")) / CUT_ROWS)
    dealt = trees.join(large, F.col("t") == F.col("s")).select("t", *_TREE, F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
    rows = rows.join(trees.select("t"), F.col("shard") == F.col("t"), "left_semi")
    rows = rows.select("shard", F.pmod(F.xxhash64("fp", F.lit(-level)), parts).alias("part"), "fp", "home")
    cut = rows.groupBy("shard", "part").cogroup(dealt.groupBy("t", "part")).applyInArrow(_next_cut(r), "shard string, fp bigint, home boolean")
    return placed.join(trees.select("t"), F.col("shard") == F.col("t"), "left_anti").unionByName(cut)


def _links(r: int):
    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["fp", "home"], ignore_index=True)
        prints = shard["fp"].to_numpy().view(np.uint64)
        home = shard["home"].to_numpy()
        pairs = near_pairs(prints, np.flatnonzero(home), np.flatnonzero(~home), r, np.random.default_rng(SEED))
        root = _roots(len(prints), pairs)
        linked = root != np.arange(len(prints))
        fp = shard["fp"].to_numpy()
        return pd.DataFrame({"u": fp[linked], "v": fp[root[linked]]})
    return search


def shards(prints: DataFrame, n: int, r: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, part, fp, home): every two of the n distinct ``prints`` within
    ``r`` bits are both in one (shard, part), where one of them lives.

    A part holds at most SHARD_SLACK x ``shard_rows`` residents, unless no
    point cuts them apart, and about GUEST_RATIO x ``shard_rows`` guests.
    """
    wanted = min(MAX_SAMPLE, SAMPLE_PER_SHARD * -(-n // shard_rows)) if n > shard_rows else 0
    if not wanted:
        return prints.select(F.lit("").alias("shard"), F.lit(0).alias("part"), "fp", F.lit(True).alias("home"))
    # The hash orders the prints, so the sample is the same in every run.
    share = int(min(1.0, wanted / n) * (1 << 30))
    drawn = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < share).orderBy("fp").toPandas()
    nodes = shard_tree(drawn["fp"].to_numpy().view(np.uint64), SAMPLE_PER_SHARD)
    placed = written(prints.select("fp").mapInArrow(_first_cut(nodes, r), "shard string, fp bigint, home boolean"), "shards")
    level, before = 0, None
    while True:
        level += 1
        sizes = placed.groupBy(F.col("shard").alias("s")).agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("guests"))
        large = written(sizes.filter((F.col("homes") > SHARD_SLACK * shard_rows) | (F.col("guests") > GUEST_RATIO * shard_rows)), "large-shards")
        cuttable = large.filter(F.col("homes") > SHARD_SLACK * shard_rows)
        state = cuttable.agg(F.count(F.lit(1)), F.sum("homes"), F.max("s")).first()
        if not state[0] or state == before:
            break
        before = state
        placed = written(_cut_again(placed, cuttable, level, r, shard_rows), "shards")
    if large.isEmpty():
        return placed.withColumn("part", F.lit(0))
    # Too many guests: each part has all residents and a share of the guests.
    parts = F.coalesce(F.ceil(F.col("guests") / (GUEST_RATIO * shard_rows)), F.lit(1))
    own = F.when(F.col("home"), F.sequence(F.lit(0).cast("bigint"), F.greatest(parts, F.lit(1)) - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("fp", F.lit(0)), F.greatest(parts, F.lit(1)))))
    return placed.join(large, F.col("shard") == F.col("s"), "left").select("shard", F.explode(own).alias("part"), "fp", "home")


def near_links(prints: DataFrame, n: int, r: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v) with u > v: links that connect the same prints as all pairs
    within ``r`` bits do.  ``prints`` has n rows of distinct ``fp``."""
    return shards(prints, n, r, shard_rows).groupBy("shard", "part").applyInPandas(_links(r), "u bigint, v bigint")


def _hung(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (u, v) as stars: each node, but for the least of its
    component among these links, with that least node."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    at = at.reshape(-1)
    root = _roots(len(names), iter([(at[:len(u)], at[len(u):])]))
    linked = root != np.arange(len(names))
    return names[linked], names[root[linked]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the links of a task, of about LINK_ROWS links at a time."""
    us, vs, held = [], [], 0
    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held > LINK_ROWS:
            u, v = _hung(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], len(u)
            if held > LINK_ROWS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                us, vs, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _hung(np.concatenate(us), np.concatenate(vs))], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for all nodes
    of ``links(u, v)``, in rounds until all links are stars.

    Before a shuffle each task replaces its links by stars, so a node brings
    one smaller neighbour for each task at most.  A round hangs every node and
    its smaller neighbours onto the least of them, and lifts links that end in
    a node which hangs itself; that join is split by Spark where many links
    end in one node.
    """
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        near = edges.select("u", "v").mapInArrow(released(_contracted), "u bigint, v bigint").groupBy("u").agg(F.collect_set("v").alias("vs"))
        # Small star: the node's own link comes first.
        hung = near.select(F.array_min("vs").alias("v"), F.posexplode(F.concat(F.array("u"), F.filter("vs", lambda v: v > F.array_min("vs")))).alias("i", "u"))
        hung = written(hung.select("u", "v", (F.col("i") == 0).alias("own")), "stars")
        # Large star, along the own link of each smaller node.
        up = hung.filter("own").select(F.col("u").alias("v"), F.col("v").alias("up"))
        edges = attach_by_keys(hung, up, ["v"])
        edges = written(edges.select("u", F.coalesce("up", "v").alias("v"), (F.col("own") & F.col("up").isNull()).alias("done")), "links")
        if edges.filter("NOT done").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, r: int = MAX_BITS,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, fp, root, first_id): per row the print, the least print of its
    component and the smallest id of the component."""
    rows = written(fingerprints(docs, id_col, text_col, k), "prints")
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("low")), "distinct-prints")
    roots = components(near_links(prints, prints.count(), r, shard_rows))
    labelled = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    labelled = written(labelled, "labels")
    first = written(labelled.groupBy("root").agg(F.min("low").alias("first_id")).withColumnRenamed("root", "r"), "first")
    named = written(labelled.join(first, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "root", "first_id"), "groups")
    return rows.join(named, F.col("fp") == F.col("f")).select("id", "fp", "root", "first_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    r: int = MAX_BITS, **options) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of r bits at most.

    NULL, empty and blank texts have print 0 and are linked like any other;
    repeated rows share a component; a component of NULL ids alone has a
    NULL component_id; an empty table gives an empty result; other columns
    of ``docs`` are ignored.
    """
    out = grouped(docs, id_col, text_col, k, r, **options)
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("first_id").alias("component_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                r: int = MAX_BITS, **options) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, that with the
    smallest id; same columns.

    Rows of a group that repeat that id count once; an id that stands on
    several texts may stay for several groups.  A row with a NULL id stays
    only if no row of its group has an id, and then one of them stays.
    """
    rows = written(grouped(docs, id_col, text_col, k, r, **options), "near-duplicates")
    key, name, own, chosen_fp = (fresh(docs, x) for x in ("__id", "__root", "__fp", "__f"))

    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    losers = written(rows.filter("id IS NOT NULL AND id <> first_id").select(F.col("id").alias(key)).distinct(), "losers")
    named = docs.filter(F.col(id_col).isNotNull())
    kept = named.join(losers, F.col(id_col) == losers[0], "left_anti")
    repeated = rows.filter("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n"), (F.min("fp") < F.max("fp")).alias("several"))
    repeated = written(repeated.filter("n > 1").select(F.col("id").alias(key), "several"), "repeated-ids")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_col])
    several = repeated.filter("several").select(key)
    if not several.isEmpty():
        # These ids do not tell rows apart; the print does.
        kept = kept.join(several, F.col(id_col) == several[0], "left_anti")
        chosen = rows.filter("id = first_id").join(several, F.col("id") == several[0], "left_semi")
        chosen = chosen.groupBy("id", "root").agg(F.min("fp").alias(chosen_fp)).withColumnsRenamed({"id": key, "root": name})
        mixed = named.join(several, F.col(id_col) == several[0], "left_semi").withColumn(own, fp(F.col(text_col)))
        mixed = mixed.join(written(chosen, "chosen"), (F.col(id_col) == F.col(key)) & (F.col(own) == F.col(chosen_fp))).dropDuplicates([name])
        kept = kept.unionByName(mixed.select(*docs.columns))
    if rows.filter("id IS NULL").isEmpty():
        return kept
    alone = rows.filter("first_id IS NULL").select(F.col("fp").alias(chosen_fp), F.col("root").alias(name)).distinct()
    nameless = docs.filter(F.col(id_col).isNull()).withColumn(own, fp(F.col(text_col)))
    nameless = nameless.join(alone, F.col(own) == F.col(chosen_fp)).dropDuplicates([name])
    return kept.unionByName(nameless.select(*docs.columns))
