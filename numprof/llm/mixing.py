"""Mixing sources to target weights by capped water-filling.

Sizes are word counts.  Every source's target is ``min(cap, level * weight)``
with one common water level, which is what clamping the sources over their
cap and resharing the excess by weight, until none is above, arrives at.
A target of r times the source's size is met by taking every document
floor(r) times and one more time for the documents whose seeded hash lies
below a cut, chosen so that the taken words come as near as whole documents
allow.

Only per-source sums and hash-bucket sums are shuffled; texts are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, written

#: Weights of the sources in code-point order (NULL last), repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 42
#: Bits of the sampling hash, and how many of them one narrowing round reads.
HASH_BITS, ROUND_BITS = 60, 12
#: Rows left in the boundary buckets of all sources at which narrowing ends.
FEW_ROWS = 1 << 16


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sampling_hash(id_: Column, text: Column, seed: int = SEED) -> Column:
    """60 bits of an md5 over seed, id and text; equal rows have equal hashes."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("~")), F.coalesce(text, F.lit("~")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def water_fill(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources(source, source_size)`` plus ``weight`` and ``target``.

    One row per source.  Ranking and levels are windows over all sources,
    sorted by one task: the table holds one short row per source, and the
    sort spills.
    """
    everything = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_fullness = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(by_fullness), F.lit(0.0))
    total = lambda c: F.sum(c).over(everything).cast("double")
    # If the sources before this one are clamped, the rest shares this level;
    # the levels rise up to the first source that is not clamped, then fall.
    level = (total("source_size") - before("cap")) / (total("weight") - before("weight"))
    levelled = ranked.withColumn("level", level).withColumn("caps", total("cap")).withColumn("all", total("source_size"))
    top = F.max("level").over(everything)
    target = F.when(F.col("caps") <= F.col("all"), F.col("cap")).otherwise(F.least(F.col("cap"), top * F.col("weight")))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the hash where the running size, in hash order, reaches
    ``part``, the running size before it, and the size at it.

    Narrows the hash range by 12 bits a round over bucket sums, so no task
    ever sorts a source; the last rows are summed by hash first.
    """
    need = plan.filter("part > 0").select("source", F.col("part").alias("rest"), F.lit(0).cast("bigint").alias("prefix"),
                                          F.lit(0).cast("bigint").alias("before"))
    bits = 0
    inside = lambda b: F.shiftright("h", HASH_BITS - b)
    named = lambda d: d.withColumnRenamed("source", "s")

    def near(b: int) -> DataFrame:
        # A source whose part is 0 has no row in ``need`` and drops out here.
        return rows.join(named(need), F.col("source").eqNullSafe(F.col("s")) & (inside(b) == F.col("prefix"))).drop("s")

    while bits < HASH_BITS:
        b = bits + ROUND_BITS
        sums = near(bits).groupBy("source", "before", "rest", inside(b).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("source").orderBy("bucket")
        run = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0))
        crossing = sums.withColumn("run", F.col("before") + run).filter(F.col("run") >= F.col("rest"))
        first = crossing.withColumn("k", F.row_number().over(w)).filter("k = 1")
        need = written(first.select("source", "rest", F.col("bucket").alias("prefix"), (F.col("run") - F.col("size")).alias("before"), "n"),
                       "mix-buckets")
        bits = b
        if (need.agg(F.sum("n")).first()[0] or 0) <= FEW_ROWS:
            break
        need = need.drop("n")
    need = need.drop("n")
    last = near(bits).groupBy("source", "before", "rest", "h").agg(F.sum("size").alias("at"))
    w = Window.partitionBy("source").orderBy("h")
    run = F.sum("at").over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("run", F.col("before") + run).filter(F.col("run") >= F.col("rest"))
    last = last.withColumn("k", F.row_number().over(w)).filter("k = 1")
    # The hash at the cut is taken only if that comes nearer than stopping before it.
    cut = F.when(F.col("run") - F.col("rest") < F.col("rest") - (F.col("run") - F.col("at")), F.col("h") + 1).otherwise(F.col("h"))
    return last.select("source", cut.alias("cut"))


def mixing_plan(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Per source: size, target, whole repetitions, and the hash below which a
    document is taken once more.  ``rows`` has source, size and h."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(sources, weights, max_epochs)
    size = F.nullif(F.col("source_size"), F.lit(0))
    whole = F.coalesce(F.floor(F.col("target") / size), F.lit(0)).cast("bigint")
    plan = written(filled.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    cuts = _cuts(rows, plan).withColumnRenamed("source", "s")
    joined = plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    return written(joined.select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut")), "mix-cuts")


def _times(h: Column, max_epochs: float = MAX_EPOCHS) -> Column:
    return F.least(F.col("whole") + (h < F.col("cut")).cast("bigint"), F.lit(int(max_epochs)).cast("bigint"))


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: id, ``size``, ``source_size``, ``target``,
    ``times`` (repetitions in the mix) and ``taken`` (words, repeats counted).

    A NULL or empty text has size 0 and takes 0 words; a NULL source is a
    source of its own, sorted last; repeated rows share one hash and are
    taken alike; an empty table gives an empty result; other columns of
    ``docs`` are not read.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               n_words(F.col(text_col)).alias("size"),
                               sampling_hash(F.col(id_col), F.col(text_col), seed).alias("h")), "mix-rows")
    plan = mixing_plan(rows, weights, max_epochs).withColumnRenamed("source", "s")
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", _times(F.col("h"), max_epochs).alias("times")) \
        .withColumn("taken", F.col("size") * F.col("times"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan takes it,
    with the columns of ``docs``.

    The per-source plan is joined to the rows where they lie if it is small
    enough to broadcast; only a plan beyond that makes the rows shuffle.
    NULL and empty texts have size 0 and are taken as often as others of their
    source; a NULL source is one of its own; repeated rows are taken alike; an
    empty table gives an empty mix.
    """
    size, h, source = n_words(F.col(text_col)), sampling_hash(F.col(id_col), F.col(text_col), seed), F.col(source_col)
    rows = written(docs.select(source.alias("source"), size.alias("size"), h.alias("h")), "mix-rows")
    plan = mixing_plan(rows, weights, max_epochs)
    own, s, hh, reps = docs.columns, fresh(docs, "__s"), fresh(docs, "__h"), fresh(docs, "__n")
    plan = plan.select(F.col("source").alias(s), F.struct("whole", "cut").alias(reps))
    times = F.least(F.col(reps)["whole"] + (F.col(hh) < F.col(reps)["cut"]).cast("bigint"), F.lit(int(max_epochs)).cast("bigint"))
    out = docs.withColumn(hh, h).join(plan, F.col(source_col).eqNullSafe(F.col(s)), "left").withColumn(reps, times.cast("int"))
    return out.filter(F.col(reps) > 0).withColumn(s, F.explode(F.array_repeat(F.lit(1), F.col(reps)))).select(*own)
