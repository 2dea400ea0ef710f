"""The registered queries of the dealt operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, gam, hard_negatives, langid, merkle, mixing, rules, simhash, templates, tensor_minhash, token_planes, toxicity, warc,
)
from .common import shared_folder, table, training_row


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    learn = training_row("doc_id", 3, 1)
    out = langid.predict(docs, langid.train(docs, learn))
    return out.select("doc_id", (~learn).alias("held_out"), "lang_pred", "score")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to deduplicated archives and read back."""
    out = warc.archive(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rule ledger of every document under the current policy version."""
    out = rules.apply_policy(rules.stored_ledger(table(spark, sf_dir, "documents")))
    return out.select("doc_id", *rules.BASE, "base_failed", "kept", "fail_bits")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy version rejects, from the stored ledger of all documents."""
    return rules.ablation_report(rules.stored_ledger(table(spark, sf_dir, "documents")))


OP4_LEDGER = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
wins AS (SELECT rid, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM words
         WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM wins WHERE c IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice WHERE n > 1) GROUP BY rid),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
             length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')) AS n_capitals
      FROM d JOIN w USING (rid) LEFT JOIN covered USING (rid)),
f AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
             + 4 * (10 * n_symbols > n_words)::BIGINT
             + 8 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT
             + 16 * (2 * n_dup_lines > n_lines)::BIGINT
             + 32 * (100 * n_capitals > 40 * word_chars)::BIGINT AS fail_bits FROM m)
"""

OP4_SQL = OP4_LEDGER + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) != 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f
"""

ABLATIONS_SQL = OP4_LEDGER + r""",
p(policy, rule, bit, whole) AS (VALUES
  ('base', 'few_words', 1, 3), ('base', 'repeated_words', 2, 3),
  ('v1', 'few_words', 1, 15), ('v1', 'repeated_words', 2, 15), ('v1', 'symbols', 4, 15), ('v1', 'word_length', 8, 15),
  ('v2', 'few_words', 1, 63), ('v2', 'repeated_words', 2, 63), ('v2', 'symbols', 4, 63), ('v2', 'word_length', 8, 63),
  ('v2', 'repeated_lines', 16, 63), ('v2', 'capitals', 32, 63))
SELECT policy, rule, count(*) FILTER ((fail_bits & bit) != 0) AS failing, count(*) FILTER ((fail_bits & whole) = bit) AS only_this,
       count(*) FILTER ((fail_bits & (whole - bit)) = 0) AS kept_without
FROM f, p GROUP BY policy, rule
"""


def op5_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels not held out."""
    out = gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (~training_row("doc_id", 5, 0)).alias("held_out"), "score", "predicted")


def op6_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return templates.main_text(table(spark, sf_dir, "pages"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` and read them back as digests.

    A NULL or empty text has its end id alone; repeated rows follow each
    other; NULL ids come first; an empty table gives no rows.
    """
    import public_tokenizers

    path = shared_folder(docs.sparkSession, "tokens")
    token_planes.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_planes.read_tokens(docs.sparkSession, path, with_ids=False)


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back."""
    return token_digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels not held out."""
    out = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (~training_row("doc_id", 3, 1)).alias("held_out"), "score", "predicted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the source weights 5, 2, 1, at most 3 epochs."""
    return mixing.mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(concat_ws('|', '42', coalesce(doc_id::VARCHAR, '~'), coalesce(text, '~'))), 1, 15))::BIGINT AS h
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
             sum(cap) OVER () AS caps, sum(source_size) OVER () AS total
      FROM r WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN caps <= total THEN cap ELSE least(cap, max(level) OVER () * weight) END AS target FROM l),
p AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t),
q AS (SELECT *, target - whole * source_size AS part FROM p),
g AS (SELECT source, h, sum(size) AS sz FROM d GROUP BY source, h),
c AS (SELECT source, h, sz, sum(sz) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) AS run FROM g),
f AS (SELECT c.source, c.h, run - part AS over, part - (run - sz) AS under,
             row_number() OVER (PARTITION BY c.source ORDER BY c.h) AS k
      FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source WHERE part > 0 AND run >= part),
cuts AS (SELECT source, CASE WHEN over < under THEN h + 1 ELSE h END AS cut FROM f WHERE k = 1)
SELECT d.doc_id, d.size, q.source_size, q.target,
       d.size * least(q.whole + (d.h < coalesce(cuts.cut, 0))::BIGINT, 3) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN cuts ON d.source IS NOT DISTINCT FROM cuts.source
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-word windows of the benchmark in every document."""
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM bi),
lengths AS (SELECT DISTINCT k FROM bw),
di AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
dw AS (SELECT rid, i, k, array_to_string(ws[i:i + k - 1], ' ') AS win FROM di, lengths WHERE i + k - 1 <= len(ws)),
hit AS (SELECT rid, i, k, item_id FROM dw JOIN bw USING (k, win)),
n AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id::VARCHAR) AS n_items,
               string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN its USING (rid)
"""

def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels shifted."""
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP11_SQL = r"""
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY s.score DESC, s.vec_id NULLS LAST)::INT AS rank
      FROM p JOIN s ON s.arid = p.arid AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document; a fifth of them tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    m = merkle.manifest(table(spark, sf_dir, "documents"), changed=(tampered, "text", merkle.ascii_lower(F.col("text"))))
    out = merkle.proofs(m).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _field(col: str) -> str:
    return f"coalesce(strlen({col}::VARCHAR)::VARCHAR || ':' || {col}::VARCHAR, '-')"


OP12_SQL = rf"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT n, n::BIGINT, 0 FROM range(256) t(n) UNION ALL
  SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text FROM documents),
x AS (SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
                      lambda a, b: xor(t[(xor(a, b) % 256 + 1)::INT], a // 256)), 4294967295) % 5 = 0 AS tampered FROM d, crc),
l AS (SELECT rid, doc_id, source, sha256({" || ".join(map(_field, merkle.FIELDS))}) AS leaf,
             CASE WHEN tampered THEN sha256({" || ".join(map(_field, merkle.FIELDS[:-1]))} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other
      FROM x),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n, count(*) OVER () AS trees FROM l GROUP BY source),
p AS (SELECT l.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos
      FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
up(tree, lvl, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM p UNION ALL
  SELECT tree, lvl + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 16),
tops(lvl, pos, n, h) AS (
  SELECT 0, up.tree, trees, h FROM up JOIN s USING (tree) WHERE up.n = 1 UNION ALL
  SELECT lvl + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 16),
nodes AS (SELECT tree, lvl, pos, n, h FROM up UNION ALL SELECT -1, lvl, pos, n, h FROM tops),
e AS (SELECT tree, lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
             coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
      FROM nodes WHERE n > 1 WINDOW w AS (PARTITION BY tree, lvl, pos // 16 ORDER BY pos)),
walk(rid, tree, lvl, pos, sib, h) AS (
  SELECT rid, tree, 0, pos, '', coalesce(other, leaf) FROM p UNION ALL
  SELECT rid, tree, lvl + 1, pos // 16, sib || lft || rgt, sha256(lft || h || rgt) FROM walk JOIN e USING (tree, lvl, pos)),
ends AS (SELECT rid, arg_max(tree, lvl) AS tree, arg_max(sib, lvl) AS sib, arg_max(h, lvl) AS h FROM walk GROUP BY rid),
walk2(rid, tree, lvl, pos, sib, h) AS (
  SELECT rid, -1, 0, tree, sib, h FROM ends UNION ALL
  SELECT rid, -1, lvl + 1, pos // 16, sib || lft || rgt, sha256(lft || h || rgt) FROM walk2 JOIN e USING (tree, lvl, pos)),
done AS (SELECT rid, sha256(arg_max(sib, lvl)) AS proof_sha256, arg_max(h, lvl) AS folded_root FROM walk2 GROUP BY rid)
SELECT doc_id, leaf, up.h AS subroot, r.h AS root, proof_sha256, folded_root, folded_root = r.h AS verified
FROM p JOIN done USING (rid) JOIN up ON up.tree = p.tree AND up.n = 1, (SELECT h FROM tops WHERE n = 1) r
"""


def op13_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document by 4-word shingles."""
    return tensor_minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_ppm_language": op2_ppm_language,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_quality_rules": op4_quality_rules,
    "op5_gam_quality": op5_gam_quality,
    "op6_template_text": op6_template_text,
    "op7_token_planes": op7_token_planes,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_tensor_minhash": op13_tensor_minhash,
    "quality_ablations": quality_ablations,
}
ORACLE_SQL: dict[str, str] = {
    "op3_warc_revisits": OP3_SQL,
    "op4_quality_rules": OP4_SQL,
    "quality_ablations": ABLATIONS_SQL,
    "op9_mixing": OP9_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
