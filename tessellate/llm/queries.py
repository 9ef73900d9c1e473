"""The queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .common import table
from .hard_negatives import hard_negatives
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .language import identify_language
from .line_dedup import dedup_lines
from .mixing import mix
from .near_vectors import near_vectors
from .order_minhash import fingerprints
from .packing import pack_documents
from .piece_codec import digests, encode_pieces
from .secrets import scan_secrets
from .toxicity import toxicity


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_pieces(table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_html_text": op6_html_text,
    "op7_order_minhash": op7_order_minhash,
    "op8_language": op8_language,
    "op9_near_vectors": op9_near_vectors,
    "op10_secrets": op10_secrets,
    "op11_collocations": op11_collocations,
    "op12_piece_codec": op12_piece_codec,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), firsts AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE owner < doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE owner IS NULL OR owner >= doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (k)
GROUP BY doc_id
""",
    "op3_jaccard_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM worded WHERE len(w) > 0
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT x, y
  FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * o >= 80 * (p.n + q.n - o)
), reach AS (
  SELECT DISTINCT x AS a, x AS b FROM links
  UNION
  SELECT reach.a, links.y FROM reach JOIN links ON reach.b = links.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(r.c, d.doc_id), d.doc_id) AS component_id, coalesce(l.k, 0) AS n_links
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
LEFT JOIN (SELECT x, count(*) AS k FROM links GROUP BY x) l ON l.x = d.doc_id
""",
    "op9_near_vectors": """
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT DISTINCT x AS a, x AS b FROM links
  UNION
  SELECT reach.a, links.y FROM reach JOIN links ON reach.b = links.x
), ends AS (
  SELECT e.vec_id, coalesce(l.k, 0) AS n_links, least(e.vec_id, coalesce(r.c, e.vec_id)) AS component_id
  FROM embeddings e
  LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = e.vec_id
  LEFT JOIN (SELECT x, count(*) AS k FROM links GROUP BY x) l ON l.x = e.vec_id
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM ends
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), spread AS (
  SELECT lang, 1 AS size, unnest(list_transform(w, lambda x: [x])) AS g FROM worded
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM worded WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM worded WHERE len(w) > 2
  UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) FROM worded WHERE len(w) > 3
), grams AS MATERIALIZED (
  SELECT lang, size, array_to_string(g, ' ') AS p, any_value(g) AS g, count(*) AS f FROM spread
  GROUP BY lang, size, array_to_string(g, ' ') HAVING size = 1 OR count(*) >= 30
), candidates AS MATERIALIZED (
  SELECT lang, size, p, g, f AS a FROM grams WHERE size > 1
), cuts AS MATERIALIZED (
  SELECT lang, size, p, a, k, array_to_string(list_slice(g, 1, k), ' ') AS lp, array_to_string(list_slice(g, k + 1, size), ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r,
         (2000000 * CAST(c.a AS HUGEINT)) // (CAST(l.f AS HUGEINT) + r.f) AS score
  FROM cuts c JOIN grams l ON l.lang = c.lang AND l.size = k AND l.p = lp
  JOIN grams r ON r.lang = c.lang AND r.size = c.size - k AND r.p = rp
), cut AS (
  SELECT lang, p, a, arg_min(l, row(score, k)) AS l, arg_min(r, row(score, k)) AS r, min(score) AS score FROM scored GROUP BY lang, p, a
), longer AS (
  SELECT lang, p, max(a) AS most FROM (
    SELECT lang, a, array_to_string(unnest(list_transform(range(1, size), lambda i: g[i:i + 1])), ' ') AS p FROM candidates WHERE size > 2
    UNION ALL SELECT lang, a, array_to_string(unnest(list_transform(range(1, size - 1), lambda i: g[i:i + 2])), ' ') FROM candidates WHERE size > 3
  ) GROUP BY lang, p
), kept AS (
  SELECT cut.* FROM cut LEFT JOIN longer USING (lang, p) WHERE most IS NULL OR 100 * most < 80 * a
), sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE size = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN sizes USING (lang)
QUALIFY rank <= 2000
""",
    "op13_hard_negatives": """
WITH usable AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, other AS positive_id, s AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.s DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.positive_score <= 100 * n.s AND 100 * n.s <= 90 * p.positive_score
QUALIFY rank <= 10
""",
}
