"""Registered queries of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflux.llm import boilerplate, language, mixing, pii, residue, spam, tokenize
from docflux.session import broadcast_if_small, materialize
from docflux.sources.tables import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of raw pages that aren't main content; spam pages are left out."""
    docs = table(spark, sf_dir, "documents")
    return boilerplate.find_boilerplate(docs, leave_out=materialize(spam.find_spam(docs), "spam"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main content of every raw page."""
    return boilerplate.main_content(table(spark, sf_dir, "documents"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are spam of keywords, links or product tags."""
    return spam.find_spam(table(spark, sf_dir, "documents"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose clean_text is template residue, filler or a message."""
    return residue.find_residue(table(spark, sf_dir, "documents"))


def _labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (without residue) and summaries with the languages of their texts and lines, beside their labels."""
    docs = table(spark, sf_dir, "documents").where("clean_text is not null and doc_id is not null")
    docs = docs.select("doc_id", "clean_text", language.label_code(F.col("lang")).alias("label"))
    residues = materialize(residue.find_residue(table(spark, sf_dir, "documents")), "residue")
    kept = docs.join(broadcast_if_small(residues), "doc_id", "left_anti")
    documents = kept.select(F.lit("document").alias("rec_type"), F.col("doc_id").cast("string").alias("rec_id"), "label", F.col("clean_text").alias("text"))
    events = table(spark, sf_dir, "policy_events").where("summary_en is not null and event_id is not null")
    summaries = events.select(F.lit("summary").alias("rec_type"), F.col("event_id").alias("rec_id"), F.lit("en").alias("label"), F.col("summary_en").alias("text")).distinct()
    tagger = language.trained(spark, language.training_sample(kept, "clean_text", F.col("label")))
    return language.label_languages(documents.unionByName(summaries), tagger, "text", ["rec_type", "rec_id", "label"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of missing or wrong language label, and every line of mixed texts."""
    return language.find_mislabelled(materialize(_labelled_texts(spark, sf_dir), "languages"))


def p5_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language and confidence of every text and of each of its lines."""
    return _labelled_texts(spark, sf_dir)


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    return tokenize.encode_corpus(table(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    sized = mixing.sized_documents(table(spark, sf_dir, "documents"), targets)
    plan = mixing.budgets(sized, targets)
    return mixing.draw(sized, plan), plan


def p7_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that a mixing plan uses, with its repeats."""
    return _mix(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of each plan."""
    drawn, plan = _mix(spark, sf_dir)
    return mixing.report(drawn, plan)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information in every text."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with placeholders for personal information."""
    return pii.redact(table(spark, sf_dir, "documents"))


QUERIES = {"p5_found": p5_found, "p5_labels": p5_labels, "p8_found": p8_found, "p8_redacted": p8_redacted, "p2_found": p2_found, "p2_clean": p2_clean, "p3_found": p3_found, "p4_found": p4_found, "p6_ids": p6_ids, "p7_draws": p7_draws, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
