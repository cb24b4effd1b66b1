"""Run summaries: counters, buckets, download outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.codes import bucket_name, lookup
from gleanery.functions.text import clean_text

_RANK = ["SUCCEEDED", "FAILED_LOGIN_REQUIRED", "FAILED_TOO_LARGE", vocab.UNRESPONSIVE]


def run_counts(projects: DataFrame, groups: list[str] = ()) -> DataFrame:
    """The nine counters of a run, over `qualitative` and `has_files`."""
    q, f = F.col("qualitative"), F.col("has_files")
    return projects.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total_projects"),
        F.count_if(f).alias("projects_with_files"),
        F.count_if(~f).alias("projects_with_no_files"),
        F.count_if(q).alias("identified_qualitative_projects"),
        F.count_if(q & f).alias("identified_qualitative_with_files"),
        F.count_if(q & ~f).alias("identified_qualitative_with_no_files"),
        F.count_if(~q).alias("identified_non_qualitative_projects"),
        F.count_if(~q & f).alias("identified_non_qualitative_with_files"),
        F.count_if(~q & ~f).alias("identified_non_qualitative_with_no_files"),
    )


def bucket_members(projects: DataFrame, key: str) -> DataFrame:
    """Which projects are in which bucket, one row each.

    The four lists of a run hold every project, so they stay a table (written
    partitioned by bucket) and are never gathered into one value.
    """
    return projects.select(bucket_name("qualitative", "has_files").alias("bucket"), key)


def download_counts(outcomes: DataFrame, groups: list[str] = (), status: str = "status"):
    """Attempts and one counter per known state; a blank state is no attempt."""
    state = clean_text(status)
    counters = [F.count_if(state == s).alias(name) for s, name in vocab.STATUS_BUCKETS.items()]
    return outcomes.filter(state != "").groupBy(*groups).agg(
        F.count(F.lit(1)).alias("download_attempted"), *counters)


def download_members(outcomes: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Project and the summary bucket of its download; unknown states have none."""
    bucket = lookup(vocab.STATUS_BUCKETS, clean_text(status))
    return outcomes.select(bucket.alias("bucket"), key).filter(F.col("bucket").isNotNull())


def final_status(rows: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """State of a study from its file rows: the best of a fixed ranking."""
    rank = F.lit(len(_RANK))
    for place, name in reversed(list(enumerate(_RANK, 1))):
        rank = F.when(F.col(status) == name, F.lit(place)).otherwise(rank)
    names = F.array(*map(F.lit, _RANK))
    return rows.groupBy(*keys).agg(
        F.get(names, F.min(rank) - 1).alias("final_status"), F.count(F.lit(1)).alias("file_rows"))
