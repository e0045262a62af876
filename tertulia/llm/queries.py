"""The operators over their whole tables, as registered queries beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tertulia.llm import chat, decontaminate, html_text, licenses, line_dedup, mixing, near_dup, quality, secrets, spelling, substring, toxicity, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over(op, *names: str):
    """The query that applies an operator to whole tables."""
    return lambda spark, sf_dir: op(*(table(spark, sf_dir, n) for n in names))


QUERIES = {
    "op1_substring_dedup": over(substring.op1, "documents"),
    "op2_chat_formatting": over(chat.op2, "conversations"),
    "op3_minhash_near_dedup": over(near_dup.op3, "documents"),
    "op4_line_dedup": over(line_dedup.op4, "documents"),
    "op5_toxicity": over(toxicity.op5, "documents", "labels"),
    "op6_quality_rules": over(quality.op6, "documents"),
    "op7_benchmark_decontamination": over(decontaminate.op7, "documents", "benchmark"),
    "op8_license_scans": over(licenses.op8, "documents"),
    "op9_mixing": over(mixing.op9, "documents"),
    "op10_html_extraction": over(html_text.op10, "pages"),
    "op11_secret_scans": over(secrets.op11, "documents"),
    "op12_embedding_whitening": over(whitening.op12, "embeddings"),
    "op13_spelling_variants": over(spelling.op13, "documents"),
}

ORACLES = {
    "op2_chat_formatting": chat.oracle(),
    "op4_line_dedup": line_dedup.oracle(),
    "op6_quality_rules": quality.oracle(),
    "op8_license_scans": licenses.oracle(),
    "op9_mixing": mixing.oracle(),
    "op11_secret_scans": secrets.oracle(),
    "op13_spelling_variants": spelling.oracle(),
}
