"""Near-duplicates by MinHash with tensored banding, verified on full sets.

1. One pass gives each document the size of its shingle set, a 128-bit digest
   of it, and two small collections of half keys, each a hash of ``ROWS``
   minhashes.  Documents with the same set fold into one class.
2. Table keys are all pairs of a half from the first collection and one from
   the second: ``HALVES`` squared tables for 2 * HALVES * ROWS minhashes.  Only
   halves that two classes share are paired, so documents without near copies
   make no keys.  Buckets with the same members count once.
3. Links are confirmed on the full sets.  First, in a few tables, every member
   of a bucket meets the bucket's least member, and what links is joined to
   components.  Buckets that still hold several components overlap in
   clusters.  A cluster that fits into a tile is searched at once, so each set
   travels once; of a larger one every bucket is searched on its own: all
   members outside of its largest component meet all members, in tiles of
   bounded size.  A tile returns a spanning forest of its links.
4. Components of the links of both steps are the result: they connect all
   pairs that share a table and pass the check.

A pair at similarity s shares a table with probability
(1 - (1 - s**ROWS)**HALVES)**2: 0.99991 at 0.8, 0.999997 at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprof.plans.stats_join import attach_by_keys

from .common import released, written
from .simhash import components

SHINGLE_WORDS = 4
#: Links need 100 * intersection >= THRESHOLD * union.
THRESHOLD = 80
#: Minhashes of a half key, and half keys of each of the two collections.
ROWS, HALVES = 3, 14
SEED = 42
#: Shingles that a minhash step holds at once.
STEP_HASHES = 1 << 14
#: Bytes of sets on either side of a tile (or one longer set).
TILE_BYTES = 8 << 20
#: Tables of the first step: pairs of halves with equal number below this.
FIRST_TABLES = 4


def shingles(text: str | None, k: int = SHINGLE_WORDS) -> set[bytes]:
    """Distinct k-word shingles, A-Z lower-cased; fewer words are one shingle, no words none."""
    words = text.encode().lower().split() if text else []
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def hashed(found: set[bytes]) -> np.ndarray:
    """The set as sorted 64-bit hashes."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    h.sort()
    return h


_rng = np.random.default_rng(SEED)
_FLIP = _rng.integers(0, 1 << 64, 4096, np.uint64)
_ODD = _rng.integers(0, 1 << 64, 4096, np.uint64) | np.uint64(1)


def halves(h: np.ndarray, rows: int = ROWS, m: int = HALVES) -> np.ndarray:
    """2 * m half keys of a set of hashes: number i of the first collection at
    i, of the second at m + i.  Each hashes its number and ``rows`` minhashes."""
    n = 2 * m * rows
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), STEP_HASHES):
        part = h[at:at + STEP_HASHES]
        mixed = (part[None, :] ^ _FLIP[:n, None]) * _ODD[:n, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return np.array([xxhash.xxh3_64_intdigest(least[i * rows:(i + 1) * rows].tobytes(), seed=i) for i in range(2 * m)], np.uint64)


def _sketches(k: int, rows: int, m: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, keys = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), k)
                n.append(len(found))
                if found:
                    h = hashed(found)
                    cls.append(xxhash.xxh3_128_digest(h.tobytes()))
                    keys.append(halves(h, rows, m).view(np.int64))
                else:
                    cls.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "cls", "halves"])
    return step


def _sets(k: int):
    """(c, set) of documents that hold the class they were joined with."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_c, out_set, held = [], [], 0
            for c, cls, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = hashed(shingles(text.as_py(), k)).tobytes()
                if xxhash.xxh3_128_digest(raw) == cls:  # a repeated id may stand on other texts too
                    out_c.append(c)
                    out_set.append(raw)
                    held += len(raw)
                if held > TILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out_c, pa.int64()), pa.array(out_set, pa.binary())], names=["c", "set"])
                    out_c, out_set, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out_c, pa.int64()), pa.array(out_set, pa.binary())], names=["c", "set"])
    return step


def tile_links(c: list[int], sets: list[bytes], probe: list[bool], root: list[int], threshold: int) -> list[tuple[int, int]]:
    """Links of a tile that join components: each probe meets every member, by
    the sizes of all intersections in one pass.  Members of one ``root`` are
    joined already; a probe of a component that holds all is not looked at.
    """
    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    size = np.array([len(a) for a in arrays], np.int64)
    start = np.cumsum(size) - size
    # Hashes as dense numbers: a probe marks its own and adds up marks by member.
    number = np.unique(np.concatenate(arrays), return_inverse=True)[1].reshape(-1)
    names, group = np.unique(np.array(root), return_inverse=True)
    group = group.reshape(-1)
    links = []
    if all(probe):  # the largest component meets all others through them
        probe = group != np.bincount(group).argmax()
    marks = np.zeros(number.max(initial=-1) + 1, bool)
    count = np.bincount(group)
    # Members of small components first: what stays outside of the largest is looked at in any case.
    for i in sorted(np.flatnonzero(probe).tolist(), key=lambda i: count[group[i]]):
        if (group == group[i]).all():
            break
        own = number[start[i]:start[i] + size[i]]
        marks[own] = True
        common = np.add.reduceat(marks[number], start)
        marks[own] = False
        near = (100 * common >= threshold * (size + size[i] - common)) & (group != group[i])
        for j in np.flatnonzero(near).tolist():
            if group[j] != group[i]:
                links.append((c[i], c[j]))
                group[group == group[j]] = group[i]
    return links


def _tile(threshold: int):
    def step(tile: pa.Table) -> pa.Table:
        links = tile_links(tile["c"].to_pylist(), tile["set"].to_pylist(), tile["probe"].to_pylist(), tile["root"].to_pylist(), threshold)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})
    return step


def _keys(shared: DataFrame, first: bool) -> DataFrame:
    """(key, c): the table keys of classes with their shared halves ``us`` and ``vs``."""
    pairs = shared.select("c", F.explode("us").alias("u"), "vs").select("c", "u", F.explode("vs").alias("v"))
    if first:
        pairs = pairs.filter((F.col("u.i") == F.col("v.i")) & (F.col("u.i") < FIRST_TABLES))
    return pairs.select(F.xxhash64("u.h", "v.h").alias("key"), "c")


def _digest(col: str) -> list[Column]:
    """An order-free digest of a group's members: number, sum and xor of hashes."""
    h = F.xxhash64(col)
    return [F.count(F.lit(1)).alias("size"), F.sum(h.cast("decimal(20,0)")).alias("sum"), F.bit_xor(h).alias("xor")]


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set: number ``c``, digest, size, smallest id, halves."""
    classes = sketches.filter("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("halves").alias("halves"))
    return written(classes, "classes").withColumn("c", F.monotonically_increasing_id())


def _shared_halves(classes: DataFrame, m: int) -> DataFrame:
    """(c, us, vs) of classes with a shared half in both collections."""
    each = classes.select("c", F.posexplode("halves").alias("p", "h"))
    common = written(each.groupBy("h").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("h"), "shared-halves")
    own = each.join(common, "h", "left_semi").groupBy("c").agg(F.collect_list(F.struct((F.col("p") % m).alias("i"), "h", "p")).alias("hs"))
    pick = lambda cond: F.transform(F.filter("hs", cond), lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h")))
    own = own.select("c", pick(lambda x: x["p"] < m).alias("us"), pick(lambda x: x["p"] >= m).alias("vs"))
    return written(own.filter("size(us) > 0 AND size(vs) > 0"), "halves")


def _with_sets(rows: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """The full sets (c, set) of the classes in ``rows``, from the texts."""
    wanted = written(rows.select("c").distinct().join(classes.select("c", "cls", "id"), "c"), "candidates")
    joined = attach_by_keys(docs, wanted.withColumnRenamed("id", "wanted_id").select(F.col("wanted_id").alias("id"), "c", "cls"), ["id"], how="inner")
    sets = written(joined.select("c", "cls", "text").mapInArrow(released(_sets(k)), "c bigint, set binary"), "sets")
    if sets.count() > wanted.count():  # repeated rows
        sets = written(sets.dropDuplicates(["c"]), "sets")
    return sets


def _first_links(members: DataFrame, sets: DataFrame, n: DataFrame, threshold: int) -> DataFrame:
    """Links of every member to the least member of its bucket."""
    hubs = members.groupBy("key").agg(F.min("c").alias("hub"))
    pairs = members.join(hubs, "key").filter("c <> hub").select("hub", "c").distinct()
    pairs = written(pairs.join(n, "c"), "first-pairs")
    parts = pairs.groupBy("hub").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") * 8 / TILE_BYTES)).cast("int").alias("parts"))
    parts = written(parts, "parts")
    dealt = attach_by_keys(pairs, parts, ["hub"])
    rows = dealt.select("hub", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int").alias("part"), "c", F.lit(False).alias("probe"))
    rows = rows.unionByName(parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("hub").alias("c"), F.lit(True).alias("probe")))
    return _search(rows.withColumn("root", F.col("c")), ["hub", "part"], sets, threshold)


def _search(rows: DataFrame, tile: list[str], sets: DataFrame, threshold: int) -> DataFrame:
    """Links of the tiles of (tile..., c, probe, root)."""
    full = rows.join(sets.hint("shuffle_hash"), "c")
    return full.select(*tile, "c", "probe", "root", "set").groupBy(*tile).applyInArrow(_tile(threshold), "u bigint, v bigint")


def _rest_links(members: DataFrame, sets: DataFrame, n: DataFrame, threshold: int) -> DataFrame:
    """Links between the components (``root``) that buckets still hold."""
    # Buckets are nodes of their own, below all classes; keys that meet there would only make a cluster larger.
    bucket = F.col("key").bitwiseOR(F.lit(-1 << 63))
    clusters = components(members.select(F.col("c").alias("u"), bucket.alias("v")))
    clusters = clusters.filter("node >= 0").select(F.col("node").alias("c"), F.col("root").alias("cluster"))
    each = written(members.select("c", "root").distinct().join(clusters, "c").join(n, "c"), "clusters")
    sizes = each.groupBy("cluster").agg((F.sum("n") * 8 <= TILE_BYTES).alias("small"))
    sized = written(attach_by_keys(each, written(sizes, "cluster-sizes"), ["cluster"]), "sized-clusters")
    small = sized.filter("small").select("cluster", "c", F.lit(True).alias("probe"), "root")
    found = _search(small, ["cluster"], sets, threshold)
    large = sized.filter("NOT small").select("c")
    if large.isEmpty():
        return found
    return found.unionByName(_bucket_links(members.join(large, "c", "left_semi"), sets, n, threshold))


def _bucket_links(members: DataFrame, sets: DataFrame, n: DataFrame, threshold: int) -> DataFrame:
    """Links between the components of each bucket, bucket by bucket."""
    counts = members.join(n, "c").groupBy("key", "root").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    per_key = counts.groupBy("key").agg(F.max(F.struct("k", "root", "n")).alias("most"), F.sum("n").alias("n"))
    tiles = lambda total: F.greatest(F.lit(1), F.ceil(total * 8 / TILE_BYTES)).cast("int")
    per_key = written(per_key.select("key", F.col("most.root").alias("largest"), tiles(F.col("n") - F.col("most.n")).alias("probe_parts"), tiles(F.col("n")).alias("parts")), "bucket-sizes")
    dealt = attach_by_keys(members, per_key, ["key"])
    mine = lambda parts: F.pmod(F.xxhash64("c"), F.col(parts)).cast("int")
    upto = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    outside = F.col("root") != F.col("largest")
    probes = dealt.filter(outside).select("key", mine("probe_parts").alias("p"), upto("parts").alias("q"), "c", F.lit(True).alias("probe"), "root")
    # An outsider is in its own row of tiles already.
    others = dealt.withColumn("p", upto("probe_parts")).filter(~outside | (F.col("p") != mine("probe_parts")))
    others = others.select("key", "p", mine("parts").alias("q"), "c", F.lit(False).alias("probe"), "root")
    return _search(probes.unionByName(others), ["key", "p", "q"], sets, threshold)


def links(docs: DataFrame, classes: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD, m: int = HALVES) -> DataFrame:
    """(u, v): verified links between classes that connect the same classes as
    all verified pairs that share a table.  ``docs``: (id, text)."""
    n = classes.select("c", "n")
    shared = _shared_halves(classes, m)
    keys = _keys(shared, False)
    buckets = keys.groupBy("key").agg(*_digest("c")).filter("size > 1").groupBy("size", "sum", "xor").agg(F.min("key").alias("key"))
    members = written(keys.join(written(buckets.select("key"), "buckets"), "key"), "members")
    sets = _with_sets(members, docs, classes, k)
    first = _keys(shared, True).join(members.select("key").distinct(), "key", "left_semi")
    linked = written(_first_links(first, sets, n, threshold), "first-links")
    roots = components(linked)
    named = members.join(roots, F.col("c") == F.col("node"), "left").select("key", "c", F.coalesce("root", "c").alias("root"))
    named = written(named, "named")
    # Buckets of one component are done.
    open_keys = named.groupBy("key").agg((F.min("root") < F.max("root")).alias("open"))
    open_keys = written(open_keys.filter("open").select("key"), "open-buckets")
    rest = written(named.join(open_keys, "key", "left_semi"), "open-members")
    return linked.unionByName(written(_rest_links(rest, sets, n, threshold), "rest-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    threshold: int = THRESHOLD, rows: int = ROWS, m: int = HALVES) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id`` (smallest id
    reachable over links, itself included) and ``kept`` (whether it is its own).

    NULL texts and texts without words have the empty set and are linked with
    nothing; a text of fewer than k words is one shingle; repeated rows and
    rows with the same set share a component; a component of NULL ids alone
    has a NULL component_id and its rows are kept; an empty table gives an
    empty result; other columns of ``docs`` are ignored.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    sketches = written(d.mapInArrow(released(_sketches(k, rows, m)), f"id {id_type}, n bigint, cls binary, halves array<bigint>"), "sketches")
    classes = _classes(sketches)
    roots = components(links(d, classes, k, threshold, m))
    named = classes.join(roots, F.col("c") == F.col("node"), "left").select("cls", "id", F.coalesce("root", "c").alias("root"))
    named = written(named, "class-roots")
    first = written(named.groupBy("root").agg(F.min("id").alias("component_id")), "first-ids")
    labels = written(named.join(first, "root").select("cls", "component_id"), "class-components")
    out = sketches.select("id", "n", "cls").join(labels.withColumnRenamed("cls", "l"), F.col("cls") == F.col("l"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, by id; same columns.  An id that
    stands on several texts stays if any of its rows is kept."""
    kept = near_duplicates(docs, id_col, text_col, **options).filter("kept").select(F.col(id_col).alias("__kept")).distinct()
    kept = written(kept, "kept")
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("__kept")), "left_semi")
