"""Registered queries of the corpus operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (factorisation, kmeans_tree, languages, licenses, main_text, mixing, secrets, simhash, spelling, tiling, tokens,
               toxicity, warc)
from .common import table


def op1_nearest_neighbours(spark, sf):
    """Ten nearest rows of ``embeddings`` for every row whose vec_id is divisible by 100."""
    return kmeans_tree.nearest_neighbours(table(spark, sf, "embeddings"), F.col("id") % 100 == 0)


def op2_secret_scan(spark, sf):
    """Every candidate secret of every document with its score."""
    return secrets.secrets_report(table(spark, sf, "documents"))


def op3_simhash(spark, sf):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_report(table(spark, sf, "documents"))


def op4_decontamination(spark, sf):
    """Every document and benchmark item that contaminates it."""
    return tiling.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])


def op5_html_extraction(spark, sf):
    """Main text of every page."""
    return main_text.extracted(table(spark, sf, "pages"))


def op6_mixing(spark, sf):
    """How often every document is taken into the mix."""
    return mixing.mixing_report(table(spark, sf, "documents"))


def op7_warc(spark, sf):
    """Every page's record, read back from the archives written for this query."""
    return warc.warc_report(table(spark, sf, "pages"))


def op8_license_scan(spark, sf):
    """Every license notice of every document."""
    return licenses.license_report(table(spark, sf, "documents"))


def op9_toxicity(spark, sf):
    """Toxicity score of every document."""
    return toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_quality(spark, sf):
    """Quality score of every document."""
    return factorisation.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_language_id(spark, sf):
    """Language of every document."""
    return languages.language_report(table(spark, sf, "documents"))


def op12_cross_tokenizer_alignment(spark, sf):
    """Token groups that two tokenizers share, for every document."""
    return tokens.aligned(table(spark, sf, "documents"), ["doc_id"]).withColumn("doc_id", F.col("doc_id").cast("long"))


def op13_spelling_variants(spark, sf):
    """Every frequent word of the documents, a 199th of whose runs lose a code point, with its form and root."""
    return spelling.document_variants(table(spark, sf, "documents"), 199)


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours, op2_secret_scan, op3_simhash, op4_decontamination, op5_html_extraction, op6_mixing, op7_warc,
    op8_license_scan, op9_toxicity, op10_quality, op11_language_id, op12_cross_tokenizer_alignment, op13_spelling_variants)}

ORACLE = {
    "op6_mixing": mixing.MIXING_SQL,
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
t AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, d.payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM d LEFT JOIN t USING (payload_digest)
""",
}
