"""The queries of this package, by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (config_packing, gnat_codes, golay_simhash, hmm_lm, jaccard_join, line_dedup, line_quality, merkle_manifest, minimax_shards, pivot_topk, prefix_bpe,
               token_file, url_filter)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.digests(read(spark, sf_dir, "documents"),
                              "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN)


@register
def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.digests(read(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=2)


@register
def op10_config_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_packing.pack_documents(read(spark, sf_dir, "documents"), "word_bpe_49k.json",
                                         end_id=0, capacity=2048)


@register
def op7_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_simhash.digests(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@register
def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards.digests(read(spark, sf_dir, "documents"), shards=8)


@register
def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.digests(read(spark, sf_dir, "documents"))


@register
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read(spark, sf_dir, "documents"), line_dedup.SETS).select(
        "doc_id", "text", "n_removed_chunks", "n_removed_lines")


@register
def op5_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.search_table(read(spark, sf_dir, "embeddings"), k=20, factor=64, every=20)


ORACLE["op5_pivot_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


@register
def op9_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(read(spark, sf_dir, "documents"))


_SPACE = "[\\x20\\x09-\\x0D]+"

ORACLE["op6_line_quality"] = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS words
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1
), cover AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated CROSS JOIN range(8) x(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, t, line,
         trim(regexp_replace(translate(lower(line), '123456789', '000000000'), '{_SPACE}', ' ', 'g')) AS form
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d)
), spoken AS (SELECT * FROM lines WHERE form <> ''),
often AS (
  SELECT source, form FROM spoken GROUP BY source, form HAVING count(DISTINCT t) > {line_quality.LINE_DOCUMENTS}
), lost AS (
  SELECT s.doc_id, sum(len(string_split(s.form, ' '))) AS n
  FROM spoken s JOIN often o ON s.form = o.form AND s.source IS NOT DISTINCT FROM o.source
  GROUP BY s.doc_id
), dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM spoken GROUP BY doc_id),
base AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, lost.n AS lost
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN lost USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (lost IS NULL OR (n_words - lost >= 20
         AND n_words - lost >= {line_quality.LEFT_SHARE} * n_words)) AS kept
FROM judged
"""


@register
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.digests(read(spark, sf_dir, "documents"))


def _sql_leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# crc32 bit by bit; a tree level by level; the proofs by the nodes' places
ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce('=' || lang, '') AS grp,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])),
               lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, grp, pos, {_sql_leaf('text')} AS leaf,
         CASE WHEN crc % 3 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         END AS told
  FROM d
), up AS (
  SELECT 0 AS level, grp, pos, leaf AS node FROM leaves
  UNION ALL
  SELECT level + 1, grp, pos // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM up) WHERE n > 1 GROUP BY level, grp, pos // 8
), depth AS (SELECT grp, max(level) AS deep FROM up GROUP BY grp),
subroots AS (
  SELECT grp, node, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos
  FROM up JOIN depth USING (grp) WHERE level = deep
), top AS (
  SELECT 0 AS level, pos, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, pos // 8
), place AS (
  SELECT l.doc_id, l.grp, l.pos, coalesce(told, leaf) AS node, deep + s.pos * 0 AS deep, s.pos AS spot
  FROM leaves l JOIN depth USING (grp) JOIN subroots s USING (grp)
), own AS (
  SELECT p.grp, p.pos, u.level, CAST(floor(p.pos / power(8, u.level)) AS BIGINT) AS mine, u.pos AS other, u.node
  FROM place p JOIN up u ON u.grp = p.grp AND u.level < p.deep
   AND u.pos // 8 = CAST(floor(p.pos / power(8, u.level + 1)) AS BIGINT)
  UNION ALL
  SELECT p.grp, p.pos, p.deep + t.level, CAST(floor(p.spot / power(8, t.level)) AS BIGINT), t.pos, t.node
  FROM place p JOIN top t ON t.level < (SELECT max(level) FROM top)
   AND t.pos // 8 = CAST(floor(p.spot / power(8, t.level + 1)) AS BIGINT)
), flank AS (
  SELECT grp, pos, level, coalesce(string_agg(node, '' ORDER BY other) FILTER (WHERE other < mine), '') AS lft,
         coalesce(string_agg(node, '' ORDER BY other) FILTER (WHERE other > mine), '') AS rgt
  FROM own GROUP BY grp, pos, level
), proof AS (SELECT grp, pos, sha256(string_agg(lft || rgt, '' ORDER BY level)) AS proof FROM flank GROUP BY grp, pos),
folded AS (
  SELECT grp, pos, 0 AS level, node FROM place
  UNION ALL
  SELECT grp, pos, level + 1, sha256(lft || folded.node || rgt) FROM folded JOIN flank USING (grp, pos, level)
), ends AS (SELECT grp, pos, arg_max(node, level) AS folded_root FROM folded GROUP BY grp, pos),
root AS (SELECT arg_max(node, level) AS root FROM top)
SELECT l.doc_id, l.leaf, s.node AS subroot, root.root,
       coalesce(proof.proof, sha256('')) AS proof_sha256, folded_root, folded_root = root.root AS verified
FROM leaves l JOIN subroots s USING (grp) JOIN ends e ON e.grp = l.grp AND e.pos = l.pos CROSS JOIN root
LEFT JOIN proof ON proof.grp = l.grp AND proof.pos = l.pos
"""


@register
def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat_codes.digests(read(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, factor=256).drop(
        "n_distances")


def _sql_codes(rounds: int) -> str:
    """Rounds of nearest entries (distance and index in one number) and floors
    of means, component by component."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""
a{k} AS (SELECT rid, p, min(d * 64 + e) AS k FROM (
  SELECT rid, p, e, CAST(sum((x.val - b{k}.val) * (x.val - b{k}.val)) AS BIGINT) AS d
  FROM x JOIN b{k} USING (p, c) GROUP BY rid, p, e) GROUP BY rid, p)""")
        if k < rounds:
            out.append(f"""
s{k} AS (SELECT p, k % 64 AS e, c, CAST(sum(val) AS BIGINT) AS s, count(*) AS n
  FROM a{k} JOIN x USING (rid, p) GROUP BY ALL),
b{k + 1} AS (SELECT p, e, c, coalesce((s - ((s % n) + n) % n) // n, val) AS val FROM b{k} LEFT JOIN s{k} USING (p, e, c))""")
    return ",".join(out)


ORACLE["op13_gnat_codes"] = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS rid, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
  SELECT rid, CAST(floor(i * 16 / n) AS INTEGER) AS p, i % (n // 16) AS c,
         CAST(floor(256 * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS val
  FROM (SELECT rid, embedding, len(embedding) AS n, unnest(range(len(embedding))) AS i FROM v)
), b0 AS (SELECT p, rid AS e, c, val FROM x WHERE rid < 64),{_sql_codes(2)},
books AS (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY p, e, c)) AS codebooks_sha256 FROM b2),
coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', CAST(k % 64 AS BIGINT)), '' ORDER BY p) AS code,
         CAST(sum(k // 64) AS BIGINT) AS error
  FROM a2 JOIN v USING (rid) GROUP BY rid, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded CROSS JOIN books
"""


@register
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read(spark, sf_dir, "documents"), words=5, percent=80)


ORACLE["op12_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda w: w <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
           THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           ELSE [array_to_string(w, ' ')] END)) AS g
  FROM d WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
), linked AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN linked l ON l.x = r.y
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
