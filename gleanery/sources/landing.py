"""Readers for landed harvests: responses, documents, pages, logs, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses as JSON lines: request columns and the raw `body`."""
    return spark.read.schema(
        "term string, term_ord bigint, start_pos bigint, global_id string, body string").json(path)


def read_terms(spark: SparkSession, path: str, most: int = 1_000_000) -> list[str]:
    """Description terms from a dictionary file (CSV: list_name, lang, term, ord)."""
    return bounded_terms(spark.read.option("header", True).schema(
        "list_name string, lang string, term string, ord int").csv(path), "term", most)


def bounded_terms(terms: DataFrame, column: str, most: int = 1_000_000) -> list[str]:
    """The different terms of a table, as configuration that every task needs.

    One with more than `most` terms is refused rather than collected: it goes
    through `signals.dictionary_hits`, which keeps it a table.
    """
    rows = (
        terms.select(F.col(column).alias("term")).filter("term IS NOT NULL AND trim(term) <> ''")
        .distinct().limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"dictionary has more than {most} terms")
    return sorted(r.term for r in rows)
