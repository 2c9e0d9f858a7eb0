"""The registered queries: each operator over its whole table, with its SQL twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.llm import (
    graph_search, license_scan, line_dedup, lm_scoring, merkle, minhash, mixing, near_embeddings, packing, quality_rules, resampling, token_counts, warc,
)

QUERIES = {}
SQL = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


W = r"[^\x20\x09-\x0D]+"


@register(
    "op7_quality_rules",
    rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{W}') AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines, t, w FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
s AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS i FROM r CROSS JOIN (VALUES (0), (1), (2)) AS v(k)) GROUP BY doc_id),
o AS (
  SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(s.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM l LEFT JOIN s ON s.doc_id = l.doc_id),
b AS (SELECT o.*, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM o)
SELECT b.*, NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR n_symbols * 10 > n_words OR n_dup_lines * 10 > n_lines * 6) AS kept
FROM b""",
)
def quality(spark, sf_dir):
    return quality_rules.quality_counts(table(spark, sf_dir, "documents"))


@register("op8_minhash")
def near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


KEY = r"regexp_replace(translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^$', '')"


@register(
    "op10_line_dedup",
    rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM d),
k AS (SELECT doc_id, line, pos, {KEY} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
m AS (SELECT k.doc_id, line, pos, (first IS NOT NULL AND first < k.doc_id) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
)
def lines(spark, sf_dir):
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents"))


@register(
    "op1_near_embeddings",
    """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL),
n AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS s FROM v),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_inner_product(x.e, y.e) / x.s / y.s >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a),
m AS (SELECT a, min(c) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON m.a = vec_id LEFT JOIN k ON k.a = vec_id""",
)
def near_embeddings_query(spark, sf_dir):
    return near_embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op5_lm_scoring")
def lm(spark, sf_dir):
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


@register("op6_packing")
def packed(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op9_token_counts")
def tokens(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@register("op2_license_scan")
def licenses(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@register("op3_mixing")
def mixed(spark, sf_dir):
    # nearly equal weights, unless a source were repeated more than 1.25 times as often as another: both change the shares
    return mixing.mix(table(spark, sf_dir, "documents"), entropy=0.999, repeats=1.25).drop("row")


@register(
    "op4_warc",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT d.*, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f""",
)
def archives(spark, sf_dir):
    return warc.archive_report(table(spark, sf_dir, "pages"))


# the CRC-32 of a text's bytes: the table of the reflected polynomial, then byte by byte
_CRC = """bits(n, c, k) AS (
  SELECT CAST(x AS BIGINT), CAST(x AS BIGINT), 0 FROM range(256) AS v(x)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8)"""


def _crc(value: str) -> str:
    """CRC-32 of a text, in a query that has ``crc_table`` in scope."""
    byte = f"CAST('0x' || substr(hex(encode({value})), CAST(2 * i + 1 AS INT), 2) AS BIGINT)"
    byte_list = f"list_transform(range(0, octet_length(encode({value}))), lambda i: {byte})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {byte_list}), lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS INT)])), 4294967295)"


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register(
    "op11_resampling",
    rf"""
WITH RECURSIVE {_CRC},
d AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
b AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
n AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM d GROUP BY doc_id, w),
f AS MATERIALIZED (SELECT w, {_crc("w")} % 10000 AS k FROM (SELECT w FROM n UNION SELECT w FROM b), crc_table),
s AS (SELECT k, sum(n) AS s FROM n JOIN f USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN f USING (w) GROUP BY k),
g AS (
  SELECT k, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT sum(n) FROM n) + 10000)
                            / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM b) + 10000)))) AS gain
  FROM s FULL JOIN t USING (k)),
v AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM n JOIN f USING (w) JOIN g USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents),
x AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM h LEFT JOIN v USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS quota FROM x WHERE n_features >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN rank <= quota THEN rank END AS rank FROM x LEFT JOIN r ON r.doc_id = x.doc_id""",
)
def resampled(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_graph_search")
def nearest(spark, sf_dir):
    return graph_search.nearest_vectors(table(spark, sf_dir, "embeddings"))


def _leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


def _tree(name: str, leaves: str) -> str:
    """CTEs of a hash tree per ``grp``: every node of every level (``{name}``) from ``leaves`` (grp, i, h)."""
    return f"""{name}(grp, level, i, h, many) AS (
  SELECT grp, 0, i, h, count(*) OVER (PARTITION BY grp) FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(many) + 7) // 8 FROM {name} WHERE many > 1 GROUP BY grp, level, i // 8),
{name}_run AS MATERIALIZED (
  SELECT a.grp, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM {name} a JOIN {name} b ON b.grp = a.grp AND b.level = a.level AND b.i // 8 = a.i // 8 WHERE a.many > 1 GROUP BY a.grp, a.level, a.i)"""


@register(
    "op13_merkle",
    rf"""
WITH RECURSIVE {_CRC},
docs AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, {_leaf("text")} AS h,
         CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
  FROM documents, crc_table),
{_tree("low", "docs")},
langs AS MATERIALIZED (SELECT 'all' AS grp, grp AS lang, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, h FROM low WHERE many = 1),
{_tree("high", "langs")},
walk(doc_id, lang, high, level, i, folded, proof) AS (
  SELECT doc_id, grp, false, 0, i, coalesce(other, h), '' FROM docs
  UNION ALL
  SELECT w.doc_id, w.lang, w.high OR x.level IS NULL, CASE WHEN x.level IS NULL AND NOT w.high THEN 0 ELSE w.level + 1 END,
         CASE WHEN x.level IS NOT NULL THEN w.i // 8 ELSE g.i END,
         CASE WHEN x.level IS NOT NULL THEN sha256(x.l || w.folded || x.r) ELSE w.folded END, w.proof || coalesce(x.l || x.r, '')
  FROM walk w
  LEFT JOIN (SELECT grp, level, i, l, r, false AS high FROM low_run UNION ALL SELECT grp, level, i, l, r, true FROM high_run) x
    ON x.high = w.high AND x.grp = CASE WHEN w.high THEN 'all' ELSE w.lang END AND x.level = w.level AND x.i = w.i
  JOIN langs g ON g.lang = w.lang
  WHERE x.level IS NOT NULL OR NOT w.high),
ends AS (SELECT doc_id, max_by(folded, len(proof) * 1000 + level + CASE WHEN high THEN 500 ELSE 0 END) AS folded_root, max_by(proof, len(proof)) AS proof FROM walk GROUP BY doc_id)
SELECT d.doc_id, d.h AS leaf, g.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = t.h AS verified
FROM docs d JOIN ends ON ends.doc_id = d.doc_id JOIN langs g ON g.lang = d.grp JOIN (SELECT h FROM high WHERE many = 1) t ON true""",
)
def manifest(spark, sf_dir):
    return merkle.manifest_report(table(spark, sf_dir, "documents"))
