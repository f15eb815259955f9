"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vecferry.llm import clusters, exact, lines, lm, mixing, packing, pii, quality, simhash, substrings, suffixes, tokenfiles, trie


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir)
    return quality.quality_rules(documents, quality.fit(documents, _table(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.passage_dedup(_table(spark, sf_dir)))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_table(spark, sf_dir))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_files(_table(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.line_dedup(_table(spark, sf_dir)))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir)
    return pii.digest(pii.find_pii(documents, pii.fit(documents)))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.byte_dedup(_table(spark, sf_dir)))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(_table(spark, sf_dir))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.digest(clusters.cluster_vectors(_table(spark, sf_dir, "embeddings")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_exact_dedup, op3_best_fit_packing, op4_substring_dedup, op5_source_mixing,
    op6_simhash_near_dedup, op7_token_files, op8_line_dedup, op9_pii, op10_suffix_array_dedup,
    op11_lm_scoring, op12_centroid_clustering, op13_conversation_trie)}

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_PASSAGES = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k FROM starts),
first_docs AS (SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first_docs USING (k) WHERE first_doc < doc_id),
gone_lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS t, count(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_LINES = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM documents),
keyed AS (
  SELECT *, translate(trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split),
frequent AS (
  SELECT k, max(doc_id) AS stays FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, nr, body, coalesce(stays <> doc_id, false) AS gone FROM keyed LEFT JOIN frequent USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_CLUSTERS = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 40)),
""" + "".join(f"""
a{n} AS MATERIALIZED (
  SELECT vec_id, k.v, min(struct_pack(
    d := list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, o.v) + list_inner_product(o.v, o.v), c := o.c)) AS best
  FROM kept k, c{n} o GROUP BY vec_id, k.v),
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS v FROM (
      SELECT best.c AS c, i, floor(sum(v[i]) / count(*)) AS x FROM a{n}, range(1, 65) AS r(i) GROUP BY 1, 2) GROUP BY c) m USING (c)),
""" for n in range(5)) + """
a5 AS MATERIALIZED (
  SELECT vec_id, min(struct_pack(
    d := list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, o.v) + list_inner_product(o.v, o.v), c := o.c)) AS best
  FROM kept k, c5 o GROUP BY vec_id, k.v)
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(o.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a5 JOIN c5 o ON o.c = best.c
"""

_CRC32 = """xor(list_reduce(list_concat([4294967295], list_transform(string_split({}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, z: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

_TRIE = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, {_CRC32.format("conv_id")} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND i <= h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND i > h),
lists AS (
  SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY own, i) AS ks,
         list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY own, i) AS ws FROM rebuilt GROUP BY conv_id),
whole AS (SELECT conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM convs LEFT JOIN lists USING (conv_id)),
paths AS (
  SELECT conv_id, d, d = len(ks) AS ends, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, md5(array_to_string(ks[1:d], ',')) AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], ',')) END AS parent
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM whole)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM paths GROUP BY node, d),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
below AS (
  SELECT a.node, count(*) FILTER (x.node NOT IN (SELECT parent FROM children)) AS n_leaves, sum((x.n - 1) * x.w) AS saved
  FROM nodes x JOIN paths a ON a.conv_id = x.conv_id AND a.d <= x.d GROUP BY a.node)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(c.n, 0) AS n_children, n_leaves,
       saved::BIGINT AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM nodes x LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN children c ON c.parent = x.node JOIN below b ON b.node = x.node
"""

ORACLES = {"op2_exact_dedup": _EXACT, "op4_substring_dedup": _PASSAGES, "op8_line_dedup": _LINES,
    "op12_centroid_clustering": _CLUSTERS, "op13_conversation_trie": _TRIE}
