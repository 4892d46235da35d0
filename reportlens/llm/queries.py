"""The queries of the operators over the driver's tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from reportlens.llm.common import n_words, table
from reportlens.llm.exact_dedup import exact_decisions
from reportlens.llm.hard_negatives import hard_negatives, prepare, shifted_labels
from reportlens.llm.language_id import predict_languages
from reportlens.llm.mixing import mix_decisions
from reportlens.llm.near_dedup import near_decisions
from reportlens.llm.packing import pack_documents
from reportlens.llm.passage_dedup import repeated_passages
from reportlens.llm.prefix_trie import conversation_nodes
from reportlens.llm.quality_rules import quality_decisions
from reportlens.llm.sharding import assign_shards
from reportlens.llm.suffix_dedup import removal_decisions
from reportlens.llm.toxicity import toxicity_scores
from reportlens.llm.url_filter import judge_urls

QUERIES, ORACLE = {}, {}


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


@_query("op9_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""")
def op9_exact_dedup(spark, sf_dir):
    return exact_decisions(table(spark, sf_dir, "documents"))


@_query("op10_quality_rules", r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
l2 AS (SELECT doc_id, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
       lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l2 GROUP BY 1),
bearers AS (SELECT source, norm, count(DISTINCT text) AS n, max(n) AS words, min_by(text, doc_id) AS first FROM l2 GROUP BY 1, 2),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY 1),
common AS (SELECT b.source, norm, first FROM bearers b JOIN hosts h ON b.source IS NOT DISTINCT FROM h.source
           WHERE b.n >= 10 AND (b.n > 0.1 * h.n OR (b.n > 500 AND b.words >= 3))),
gone AS (SELECT doc_id, sum(n) AS n FROM l2 JOIN common c ON l2.norm = c.norm AND l2.text <> c.first
         AND l2.source IS NOT DISTINCT FROM c.source GROUP BY 1),
f AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND NOT (n_removed > 0 AND (n_words - n_removed < 20 OR n_words - n_removed < 0.3 * n_words)) AS kept
FROM b""")
def op10_quality_rules(spark, sf_dir):
    return quality_decisions(table(spark, sf_dir, "documents")).drop("host", "digest", "removed")


@_query("op2_minhash_forest")
def op2_minhash_forest(spark, sf_dir):
    return near_decisions(table(spark, sf_dir, "documents"))


@_query("op3_mix_sources", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM d GROUP BY 1),
w AS (SELECT *, [5, 2, 1][s % 3 + 1] AS w FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / w, s
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY source_size / w, s
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, s, source_size, least(2.0::DOUBLE * source_size, coalesce(w * max(CASE WHEN level * w < 2 * source_size
      THEN level END) OVER (), 2.0::DOUBLE * source_size)) AS target FROM l),
p AS (SELECT doc_id, size, source_size, target, coalesce(sum(size) OVER (PARTITION BY s ORDER BY md5('7:' || doc_id), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (greatest(0, least(size, floor(target) - before))
       + greatest(0, least(size, floor(target) - before - source_size)))::BIGINT AS taken FROM p""")
def op3_mix_sources(spark, sf_dir):
    return mix_decisions(table(spark, sf_dir, "documents"))


@_query("op7_minimum_slack_packing")
def op7_minimum_slack_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())


SHARDS = [f"shard-{k:03d}" for k in range(128)]


@_query("op1_shard_documents")
def op1_shard_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", n_words(F.col("text")).alias("n_words"))
    return assign_shards(docs, SHARDS)


@_query("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


@_query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op6_language_id")
def op6_language_id(spark, sf_dir):
    return predict_languages(table(spark, sf_dir, "documents"))


@_query("op5_compact_windows")
def op5_compact_windows(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


@_query("op12_suffix_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(b[i:i + 399]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d WHERE octet_length(b) >= 400)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
g AS (SELECT r, i, coalesce(i > max(i + 400) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS new FROM t),
s AS (SELECT r, min(i) AS a, max(i) + 400 AS z FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM g) GROUP BY r, k),
l AS (SELECT r, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM s GROUP BY 1),
j AS (SELECT doc_id, b, octet_length(b) AS n, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(a, []) AS a, coalesce(z, []) AS z FROM d LEFT JOIN l USING (r))
SELECT doc_id, n AS n_bytes, n_removed, n_spans,
       sha256(list_reduce(list_transform(list_zip(list_prepend(1, z), list_append(a, n + 1)), lambda x: b[x[1]:x[2] - 1]), lambda x, y: x || y)) AS kept_sha256 FROM j""")
def op12_suffix_dedup(spark, sf_dir):
    return removal_decisions(table(spark, sf_dir, "documents"))


@_query("op13_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
      FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
      row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op13_hard_negatives(spark, sf_dir):
    return hard_negatives(shifted_labels(prepare(table(spark, sf_dir, "embeddings"))))


@_query("op11_prefix_trie", """
WITH t AS (SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS b,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                  md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(conv_id::VARCHAR) + 1),
             lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
             lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: xor(u >> 1, 3988292384 * (u & 1))))) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
s AS (SELECT c.conv_id, 0 AS own, r, k, b FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND r <= h
      UNION ALL SELECT c.conv_id, 1, r, k, b FROM c JOIN t ON t.conv_id = c.conv_id AND r > h),
p AS (SELECT conv_id, row_number() OVER w AS d, md5(string_agg(k, '') OVER w) AS node, b FROM s
      WINDOW w AS (PARTITION BY conv_id ORDER BY own, r)
      UNION ALL SELECT conv_id, 0, '', 0 FROM c),
m AS (SELECT *, lag(node) OVER w AS up, lead(node) OVER w AS below FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
n AS (SELECT node, d AS depth, min(conv_id) AS conv_id, any_value(up) AS up, any_value(b) AS b, count(*) AS n_convs,
             count(DISTINCT below) AS n_children,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (below IS NULL), '')) AS ends_sha256
      FROM m GROUP BY 1, 2),
u AS (SELECT p.node, sum((n.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n.n_convs - 1) * n.b)::BIGINT AS saved_tokens
      FROM n JOIN p ON p.conv_id = n.conv_id AND p.d <= n.depth GROUP BY 1)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u ON u.node = n.node LEFT JOIN n o ON o.node = n.up""")
def op11_prefix_trie(spark, sf_dir):
    return conversation_nodes(table(spark, sf_dir, "conversations"))
