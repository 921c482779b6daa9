"""Queries of the problems on texts; the entry module adds them only if this package is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm.canonical import canonical_text, lookalike_classes, lookalike_pairs
from hustings.llm.encode import encode, token_counts
from hustings.llm.packing import length_batches, pack
from hustings.llm.spam import spam_pages, spam_steps
from hustings.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of entries of one contest that look the same while their characters differ."""
    return lookalike_pairs(table(spark, sf_dir, "served_name"), "name_id", ["census_id", "name_field"], ["ward", "cand_name"])


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as classes: each entry of a class that is written in several ways, with its class and its writing."""
    return lookalike_classes(table(spark, sf_dir, "served_name"), "name_id", ["census_id", "name_field"], ["ward", "cand_name"])


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry's ward and name in their consistent form, as text and as key for comparison."""
    names = table(spark, sf_dir, "served_name")
    return names.select("name_id", *(canonical_text(F.col(c), single_line=True, key=key).alias(c + end) for key, end in ((False, ""), (True, "_key")) for c in ("ward", "cand_name")))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its container of 2,048 tokens, as few containers as can be."""
    return pack(token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p7_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a batch of its length bucket, the buckets being those with the least padding."""
    return length_batches(token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents most of whose characters are keywords, link lists or product tags."""
    return spam_pages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id")


def p8_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each step of the search for spam pages leaves."""
    return spam_steps(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes, "p1_canonical": p1_canonical, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_batches": p7_batches, "p8_found": p8_found, "p8_steps": p8_steps}

#: None of them can be said in SQL; tests hold them against brute force, exact round trips and labelled texts.
ORACLE: dict[str, str] = {}
