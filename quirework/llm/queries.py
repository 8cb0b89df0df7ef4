"""Queries of the operators of this subpackage; each takes (spark, folder) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm import language, leakage, markup, packing, repetition, scan_noise, subjects, truncation
from quirework.session import read_table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of which at least 30 % is repetition."""
    found = repetition.document_repetition(read_table(spark, sf_dir, "page_artifacts"), read_table(spark, sf_dir, "generation_results"))
    return found.where("repetitive").select("field", "record_key").distinct()


def p1_host_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of every rule at every host and their shrunk rates."""
    found = repetition.document_repetition(read_table(spark, sf_dir, "page_artifacts"), read_table(spark, sf_dir, "generation_results"))
    rates = repetition.host_rates(found)
    return rates.withColumns({c: F.round(c, 6) for c in rates.columns if c.startswith(("raw_", "rate_", "prior_"))})


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of repetition of every value by every rule, and whether its host changes the verdict."""
    found = repetition.document_repetition(read_table(spark, sf_dir, "page_artifacts"), read_table(spark, sf_dir, "generation_results"))
    shares = [F.round(c, 6).alias(c) for c in ("word_share", "char_share", "loop_share", "line_share", "block_share", "phrase_share", "probability")]
    return found.select("field", "record_key", *shares, "repetitive", (F.col("repetitive") != F.col("failed")).alias("by_host")).distinct()


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean text of every value of the three fields, by its hash, and the kinds of foreign markup in it."""
    pages = read_table(spark, sf_dir, "page_artifacts").select("doc_id", "page_num", "markdown", "html_filtered", "chunks")
    blocks = pages.select("doc_id", "page_num", F.posexplode("chunks").alias("position", "c")).select("doc_id", "page_num", F.concat(F.lit("content/"), F.col("position").cast("string")).alias("field"), F.col("c.content").alias("value"))
    html = pages.select("doc_id", "page_num", F.lit("html_filtered").alias("field"), F.col("html_filtered").alias("value")).unionByName(blocks)
    text = pages.select("doc_id", "page_num", F.lit("markdown").alias("field"), F.col("markdown").alias("value"))
    clean = markup.clean_text(html, "value", "html").unionByName(markup.clean_text(text, "value", "markdown"))
    return clean.select("doc_id", "page_num", "field", F.md5("clean_text").alias("clean_md5"), F.length("clean_text").alias("n_chars"), F.array_join("foreign_kinds", ",").alias("kinds")).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field values with foreign markup."""
    return markup.foreign_markup(read_table(spark, sf_dir, "page_artifacts")).select("doc_id", "page_num", "field").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose answer was cut off."""
    return truncation.truncation(read_table(spark, sf_dir, "generation_results")).where("truncated").select("request_id").distinct()


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation rate of every source."""
    return truncation.truncation_rates(read_table(spark, sf_dir, "generation_results")).withColumn("rate", F.round("rate", 6))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of scan noise on every page."""
    return scan_noise.page_noise(read_table(spark, sf_dir, "page_artifacts"))


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running text of every page in repaired paragraphs."""
    return scan_noise.repair(read_table(spark, sf_dir, "page_artifacts")).distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the pages whose label is missing, unusable or wrong, or that hold several languages."""
    return language.relabelled(read_table(spark, sf_dir, "page_artifacts"), read_table(spark, sf_dir, "page_langs"))


def p5_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch in one language of every page, with its confidence."""
    pages = read_table(spark, sf_dir, "page_artifacts")
    judged = language.judged_pages(pages, read_table(spark, sf_dir, "page_langs"))
    stretch = judged.select("doc_id", "page_num", F.posexplode("stretches").alias("stretch", "s"))
    return stretch.select("doc_id", "page_num", "stretch", F.col("s.lang").alias("lang"), F.col("s.n_sentences").alias("n_sentences"), F.round("s.confidence", 4).alias("confidence")).distinct()


def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of every container and the documents or pieces in them."""
    return packing.pack(packing.token_sizes(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "containers"))


def p6_fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unused space of every container."""
    return packing.fill_rates(p6_packed(spark, sf_dir)).withColumn("unused_share", F.round("unused_share", 6))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items of which they hold 15 words in a row, by the tiles that cover them."""
    found = leakage.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))
    return found.where(F.greatest("run_words", "stretch_words") >= leakage.RUN_WORDS).select("doc_id", "item_id")


def p7_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest run, longest covered stretch and coverage of every item that a document gives away, short items and pieces too."""
    return leakage.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items")).withColumn("coverage", F.round("coverage", 6))


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels, areas, items = (read_table(spark, sf_dir, t) for t in ("documents", "subject_labels", "subjects", "eval_items"))
    return subjects.document_subjects(documents, labels, areas, items)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that hold at least a fifth of a document, by the calibrated probability."""
    return subjects.decided(_shares(spark, sf_dir)).select("doc_id", "subject").distinct()


def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make-up of the corpus by subject."""
    return subjects.composition(_shares(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_host_rates, p1_shares, p2_found, p2_clean, p3_found, p3_rates, p4_found, p4_repaired, p5_found, p5_stretches, p6_packed, p6_fill_rates, p7_found, p7_coverage, p8_found, p8_composition)}


def oracle_sql() -> dict[str, str]:
    """None of these can be said in SQL over whole tables; tests/llm compares them with brute force."""
    return {}
