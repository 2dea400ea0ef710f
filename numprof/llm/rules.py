"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document.  The ledger keeps the
measurements and one failure bit per rule; a policy is a mask over those
bits, so a new policy version, or the ablation of a rule, never reads a text
again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh, written

#: Rule -> bit of the ledger.  Bits are never reused for another rule.
RULES = {
    "few_words": 0,        # under 50 words
    "repeated_words": 1,   # over half of the words lie in repeated 3-word windows
    "symbols": 2,          # over 1 symbol of #*$%&|<> for 10 words
    "word_length": 3,      # mean word length under 2 or over 15 code points
    "repeated_lines": 4,   # over half of the lines with words repeat an earlier one
    "capitals": 5,         # over 40 % of the word characters are upper-case letters
}

#: Policy version -> the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "word_length"),
    "v2": tuple(RULES),
}

#: Base columns every ledger row holds, in this order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a policy version, or of the named rules."""
    return sum(1 << RULES[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _measured(df: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """``df`` plus one struct column of measurements, and that column's name.

    Each array is projected as a column of its own and read more than once, so
    the optimiser keeps that projection and no lambda rebuilds an array for
    each of its elements (`tests/llm` holds the plan to that).
    Repeated windows are looked for only in texts whose windows are not all
    distinct; there they are found by one sort, never by comparing all pairs.
    """
    own = df.columns
    t, w, lines, win, s, m = (fresh(df, f"__{x}") for x in "t words lines win sorted m".split())
    c = F.col
    d = df.withColumn(t, F.coalesce(c(text_col), F.lit("")))
    d = d.withColumn(w, F.array_remove(F.split(c(t), r"[\x20\x09-\x0D]+"), ""))
    d = d.withColumn(lines, F.filter(F.split(c(t), "\n"), lambda x: x.rlike(WORD)))
    k = F.greatest(F.size(w) - 2, F.lit(0))
    d = d.withColumn(win, F.transform(F.slice(c(w), F.lit(1), k), lambda x, i: F.xxhash64(x, c(w)[i + 1], c(w)[i + 2])))
    repeats = F.size(F.array_distinct(win)) < F.size(win)
    d = d.withColumn(s, F.when(repeats, F.sort_array(F.arrays_zip(
        F.concat(c(win)), F.sequence(F.lit(1), F.greatest(F.size(win), F.lit(1)))))))
    hs, at = c(s)["0"], c(s)["1"]
    none = F.array(F.lit(None).cast("bigint"))
    around = F.arrays_zip(F.concat(hs), F.concat(at), F.concat(none, hs), F.slice(hs, F.lit(2), F.greatest(F.size(s), F.lit(1))))
    again = F.filter(around, lambda z: (z["0"] == z["2"]) | (z["0"] == z["3"]))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda z: F.array(z["1"], z["1"] + 1, z["1"] + 2))))
    without = lambda pattern: F.length(F.regexp_replace(c(t), pattern, ""))
    measured = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - without(r"[#*$%&|<>]+")).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.when(c(s).isNull(), F.lit(0)).otherwise(F.size(covered)).cast("bigint").alias("n_repeat_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.length(t) - without(r"[A-Z]+")).cast("bigint").alias("n_capitals"),
    )
    # A filter on the measurements must not be pushed below the arrays, where
    # each lambda would rebuild them; the (always true) row-number condition is a
    # barrier to that.
    return d.withColumn(m, F.when(F.monotonically_increasing_id() >= 0, measured)).select(*own, m), m


def _failures(m: str) -> Column:
    """The failure bits of a measurement column; integer arithmetic only."""
    x = lambda name: F.col(m)[name]
    failed = {
        "few_words": x("n_words") < 50,
        "repeated_words": 100 * x("n_repeat_words") > 50 * x("n_words"),
        "symbols": 10 * x("n_symbols") > x("n_words"),
        "word_length": (x("word_chars") < 2 * x("n_words")) | (x("word_chars") > 15 * x("n_words")),
        "repeated_lines": 2 * x("n_dup_lines") > x("n_lines"),
        "capitals": 100 * x("n_capitals") > 40 * x("word_chars"),
    }
    bits = [F.when(failed[r], F.lit(1 << b)).otherwise(F.lit(0)) for r, b in RULES.items()]
    return sum(bits[1:], bits[0]).cast("bigint")


def rule_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, the measurements, ``fail_bits``.

    A NULL or empty text has zero words and fails ``few_words``; repeated
    rows stay repeated; other columns of ``df`` are ignored; an empty input
    gives an empty ledger.
    """
    d, m = _measured(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    return d.select(F.col("id").alias(id_col), F.col(f"{m}.*"), _failures(m).alias("fail_bits"))


def stored_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger of ``df``, written below the shared folder and read back:
    policies and ablations of it no longer read a text.  Nulls, empties and
    repeats as in ``rule_ledger``."""
    return written(rule_ledger(df, id_col, text_col), "rule-ledger")


def apply_policy(ledger: DataFrame, policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """The ledger plus ``base_failed`` and ``kept`` under a policy version."""
    bits = F.col("fail_bits")
    return ledger.withColumns({"base_failed": bits.bitwiseAND(F.lit(mask("base"))) != 0,
                               "kept": bits.bitwiseAND(F.lit(mask(policy) | mask("base"))) == 0})


def ablations(ledger: DataFrame, policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects,
    and that the policy keeps without it.

    Computed from the counts of distinct bit patterns (at most 2 to the
    number of rules), so texts and measurements are not read again.
    """
    patterns = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    names = POLICIES[policy] if isinstance(policy, str) else policy
    full = mask(tuple(names))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r]).cast("bigint").alias("bit")) for r in names]))
    p = patterns.select("fail_bits", "n", rules.alias("r"))
    hit = F.col("fail_bits").bitwiseAND(F.lit(full).cast("bigint"))
    rest = F.col("fail_bits").bitwiseAND(F.lit(full).cast("bigint").bitwiseXOR(F.col("r.bit")))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return p.groupBy(F.col("r.rule").alias("rule")).agg(
        count(hit.bitwiseAND(F.col("r.bit")) != 0).alias("failing"),
        count(hit == F.col("r.bit")).alias("only_this"),
        count(rest == 0).alias("kept_without"))


def ablation_report(ledger: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """``ablations`` of several policy versions, each row under its ``policy``;
    an empty ledger gives no rows."""
    reports = [ablations(ledger, p).select(F.lit(p).alias("policy"), "*") for p in policies]
    return functools.reduce(DataFrame.unionByName, reports)


def quality_filter(df: DataFrame, text_col: str = "text", policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """The rows of ``df`` that a policy keeps, with the columns of ``df``
    (any extra column, whatever its name, passes through unchanged).

    NULL and empty texts have no words, fail the base rules and go; repeated
    rows are decided alike; an empty table gives an empty result.
    """
    d, m = _measured(df, text_col)
    return d.filter(_failures(m).bitwiseAND(F.lit(mask(policy) | mask("base"))) == 0).drop(m)
