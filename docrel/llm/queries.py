"""The queries of this subpackage, by name, and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fingerprints, langid, linededup, mixing, pii, secret_scan, simhash, suffixdedup, toxicity
from .common import crc_mod, read


def _sha(text) -> object:
    return F.sha2(text.cast("binary"), 256)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = secret_scan.scan(docs)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", _sha(text(base)).alias("base_sha256"), text(F.col("spans")).alias("spans"), "n_random")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.compare_with_next(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), scorer)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return out.select("doc_id", *counts, _sha(pii.joined(*pii.KINDS)).alias("base_sha256"), pii.joined(*pii.KINDS, "term").alias("spans"), F.size("term").cast("long").alias("n_term"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_components(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
keyed AS (SELECT *, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
bad AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE len(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
marked AS (SELECT keyed.*, bad.k IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM keyed LEFT JOIN bad ON keyed.k = bad.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixdedup.suffix_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    out = decontam.matches(docs.select("doc_id", "text"), benchmark)
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated", "longest", F.get("matches", F.lit(0))["at"].cast("long").alias("first_hit"))


OP9_SQL = r"""
WITH ab AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, ab),
b AS (SELECT row_number() OVER () AS o, CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, ab WHERE item_id IS NOT NULL),
bw AS (SELECT o, item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM b WHERE len(w) > 0),
win AS (SELECT o, item_id, m, j, array_to_string(w[j:j + m - 1], ' ') AS s FROM bw),
ms AS (SELECT DISTINCT m FROM win),
dw AS (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m),
spots AS (SELECT r, i, dw.m AS m, array_to_string(w[i:i + dw.m - 1], ' ') AS s FROM dw),
hits AS (SELECT r, i, j, o, win.m AS m, item_id FROM spots JOIN win ON spots.m = win.m AND spots.s = win.s),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
islands AS (SELECT r, o, m, i - j AS diagonal, i, i - row_number() OVER (PARTITION BY r, o, i - j ORDER BY i) AS island FROM hits),
runs AS (SELECT r, min(i) - 1 AS place, count(*) + any_value(m) - 1 AS n FROM islands GROUP BY r, o, diagonal, island),
most AS (SELECT r, max(n) AS longest, min(place) AS first_hit FROM runs GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest, CAST(first_hit AS BIGINT) AS first_hit
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r) LEFT JOIN most USING (r)
"""


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_language": op10_language,
}
ORACLE_SQL = {"op5_mixing": mixing.oracle(), "op7_line_dedup": OP7_SQL, "op9_decontamination": OP9_SQL}
