"""The corpus queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from tramlake.llm import ctph, decontaminate, html_text, langid, licenses, mixing, quality, simhash, token_counts, warc
from tramlake.llm.common import table

QUERIES = {
    "op1_decontaminate": lambda spark, sf_dir: decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op2_quality": lambda spark, sf_dir: quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op3_warc": lambda spark, sf_dir: warc.query(table(spark, sf_dir, "pages")),
    "op4_fingerprints": lambda spark, sf_dir: ctph.query(table(spark, sf_dir, "documents")),
    "op5_language_id": lambda spark, sf_dir: langid.query(table(spark, sf_dir, "documents")),
    "op6_licenses": lambda spark, sf_dir: licenses.query(table(spark, sf_dir, "documents")),
    "op7_html_text": lambda spark, sf_dir: html_text.query(table(spark, sf_dir, "pages")),
    "op8_token_counts": lambda spark, sf_dir: token_counts.query(table(spark, sf_dir, "documents")),
    "op9_mix_sources": lambda spark, sf_dir: mixing.query(table(spark, sf_dir, "documents")),
    "op10_simhash_near_duplicates": lambda spark, sf_dir: simhash.query(table(spark, sf_dir, "documents")),
}
ORACLE_SQL = {
    "op1_decontaminate": decontaminate.SQL,
    "op3_warc": warc.SQL,
    "op6_licenses": licenses.sql(),
    "op9_mix_sources": mixing.SQL,
}
