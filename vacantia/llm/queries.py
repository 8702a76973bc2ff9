"""One query for each operator, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.llm.byte_bpe import round_trip_digests
from vacantia.llm.decontaminate import contamination_report
from vacantia.llm.language_id import identify_pages
from vacantia.llm.licences import scan_licences
from vacantia.llm.merkle import manifest_report
from vacantia.llm.pivot_search import top_k_products
from vacantia.llm.quality_classifier import score_quality
from vacantia.llm.quality_rules import quality_verdicts
from vacantia.llm.ranked_search import rank_documents
from vacantia.llm.sharding import shard_manifest
from vacantia.llm.simhash import near_copies, print_hex
from vacantia.llm.token_counts import count_tokens
from vacantia.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(table(spark, sf_dir, "documents"), path)


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op3_decontaminate"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
i AS MATERIALIZED (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
iw AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 10) AS n, w[p:p + least(len(w), 10) - 1] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, w[p:p + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT dw.doc_id, dw.n, dw.p, iw.item FROM dw JOIN iw ON dw.win = iw.win),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


ORACLE["op9_quality_rules"] = r"""
WITH w AS MATERIALIZED (SELECT doc_id, lang, source, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, w[p:p + 2] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) > 2)),
r AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (
  SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, t) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
m AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  1000 * n_symbols // nullif(n_words, 0) AS symbols, 1000 * n_repeat_words // nullif(n_words, 0) AS repeats,
  1000 * n_dup_lines // nullif(n_lines, 0) AS dup_lines, 100 * word_chars // nullif(n_words, 0) AS word_length FROM c),
v AS (SELECT lang, source, unnest(['symbols', 'repeats', 'dup_lines', 'word_length']) AS measure,
  unnest([symbols, repeats, dup_lines, word_length]) AS x FROM m WHERE NOT base_failed),
b AS MATERIALIZED (SELECT lang, source, measure, (x >> greatest(length(bin(x)) - 6, 0)) << greatest(length(bin(x)) - 6, 0) AS x FROM v),
q AS MATERIALIZED (
  SELECT 1 AS level, lang, source, measure, count(*) AS n, quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.75) AS q3 FROM b GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, measure, count(*), quantile_disc(x, 0.25), quantile_disc(x, 0.75) FROM b GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, measure, count(*), quantile_disc(x, 0.25), quantile_disc(x, 0.75) FROM b GROUP BY ALL),
lim AS (SELECT p.lang, p.source, k.measure, coalesce(a.q1, s.q1, z.q1) AS q1, coalesce(a.q3, s.q3, z.q3) AS q3
  FROM (SELECT DISTINCT lang, source FROM m) p
  CROSS JOIN (SELECT unnest(['symbols', 'repeats', 'dup_lines', 'word_length']) AS measure) k
  LEFT JOIN q a ON a.level = 1 AND a.n >= 100 AND a.measure = k.measure AND a.lang IS NOT DISTINCT FROM p.lang AND a.source IS NOT DISTINCT FROM p.source
  LEFT JOIN q s ON s.level = 2 AND s.n >= 100 AND s.measure = k.measure AND s.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN q z ON z.level = 3 AND z.measure = k.measure),
h AS (SELECT lang, source, max(CASE measure WHEN 'symbols' THEN q3 + 3 * greatest(q3 - q1, 100) END) AS hs,
  max(CASE measure WHEN 'repeats' THEN q3 + 3 * greatest(q3 - q1, 160) END) AS hr,
  max(CASE measure WHEN 'dup_lines' THEN q3 + 3 * greatest(q3 - q1, 200) END) AS hd,
  max(CASE measure WHEN 'word_length' THEN q3 + 3 * greatest(q3 - q1, 100) END) AS hw,
  max(CASE measure WHEN 'word_length' THEN q1 - 3 * greatest(q3 - q1, 100) END) AS lw FROM lim GROUP BY ALL)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  NOT m.base_failed AND coalesce(symbols <= hs, true) AND coalesce(repeats <= hr, true) AND coalesce(dup_lines <= hd, true)
    AND coalesce(word_length <= hw, true) AND coalesce(word_length >= lw, true) AS kept
FROM m LEFT JOIN h ON m.lang IS NOT DISTINCT FROM h.lang AND m.source IS NOT DISTINCT FROM h.source
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", print_hex(F.col("print")).alias("fingerprint"), "component_id")


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
g AS (SELECT digest, max(page_id) AS response FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM d LEFT JOIN g ON d.digest = g.digest AND n >= 1000
"""


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_manifest(table(spark, sf_dir, "documents"), [1.0] * 40)


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"))
    spans = F.transform("notices", lambda n: F.concat_ws(":", n["licence"], n["at"], n["length"]))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), F.array_join(spans, ",").alias("spans"),
                        "n_notices", "n_unmatched")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


def _leaf(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(concat(" + ", ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + "))"


ORACLE["op11_merkle_manifest"] = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY k) AS t FROM (SELECT k, list_reduce(range(8),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, k) AS c FROM range(256) r(k))),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('n_chars')} AS leaf,
  CASE WHEN xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295), 4294967295) % 7 = 0 THEN {_leaf('n_chars + 1')} END AS forged
  FROM documents, crc),
i AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS j,
  count(*) OVER (PARTITION BY lang) AS n FROM d),
nodes AS (SELECT lang, 0 AS h, j, n, leaf AS d FROM i UNION ALL
  SELECT lang, h + 1, j // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY j)) FROM nodes WHERE n > 1 GROUP BY lang, h, j // 2, n),
tops AS (SELECT lang, 0 AS h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j, count(*) OVER () AS n, d FROM nodes WHERE n = 1),
outer_nodes AS (SELECT 0 AS h, j, n, d FROM tops UNION ALL
  SELECT h + 1, j // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY j)) FROM outer_nodes WHERE n > 1 GROUP BY h, j // 2, n),
steps AS MATERIALIZED (
  SELECT i.r, a.h AS k, (i.j >> a.h) % 2 = 1 AS l, b.d FROM i
    JOIN nodes a ON a.lang IS NOT DISTINCT FROM i.lang AND a.j = i.j >> a.h AND a.n > 1
    LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM i.lang AND b.h = a.h AND b.j = xor(i.j >> a.h, 1)
  UNION ALL SELECT i.r, 100 + a.h, (t.j >> a.h) % 2 = 1, b.d FROM i JOIN tops t ON t.lang IS NOT DISTINCT FROM i.lang
    JOIN outer_nodes a ON a.j = t.j >> a.h AND a.n > 1 LEFT JOIN outer_nodes b ON b.h = a.h AND b.j = xor(t.j >> a.h, 1)),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY r ORDER BY k) AS z FROM steps),
folded AS (SELECT r, 0 AS z, coalesce(forged, leaf) AS d FROM i UNION ALL
  SELECT f.r, p.z, sha256(CASE WHEN p.d IS NULL THEN f.d WHEN p.l THEN p.d || f.d ELSE f.d || p.d END)
  FROM folded f JOIN placed p ON p.r = f.r AND p.z = f.z + 1),
ends AS (SELECT r, arg_max(d, z) AS folded_root FROM folded GROUP BY r),
proofs AS (SELECT r, string_agg(d, '' ORDER BY z) AS p FROM placed GROUP BY r)
SELECT doc_id, leaf, t.d AS subroot, o.d AS root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = o.d AS verified
FROM i JOIN tops t ON t.lang IS NOT DISTINCT FROM i.lang JOIN ends USING (r) LEFT JOIN proofs USING (r)
  JOIN (SELECT d FROM outer_nodes WHERE n = 1) o ON true
"""


@query
def op12_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op12_pivot_search"] = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5
"""


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op13_ranked_search"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
i AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, {TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
whole AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
tf AS MATERIALIZED (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), whole),
m AS (SELECT r, 25 + (75 * CAST(len(w) AS BIGINT) * n_docs) // greatest(n_terms, 1) AS m FROM d, whole),
it AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM i) GROUP BY ALL),
s AS (SELECT q, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM it JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (r) GROUP BY q, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s JOIN d USING (r) JOIN i USING (q) WHERE score > 0 QUALIFY rank <= 10
"""
