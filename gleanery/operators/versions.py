"""Version operators: normalise, mark the current one, pick the latest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import codes
from gleanery.functions.text import first_non_blank, first_number


def latest_version_info(versions: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """Newest non-blank version and newest non-blank folder of each project.

    The two are chosen independently and may come from different rows.
    """
    place = F.struct(date, tie)

    def newest(column):
        filled = F.col(column) != ""
        return F.max_by(F.when(filled, F.col(column)), F.when(filled, place)).alias(column)

    return versions.groupBy(key).agg(newest("version"), newest("download_version_folder"))


def version_rows(versions: DataFrame, key: str, order: str) -> DataFrame:
    """Stored version rows: distinct by version and date, one marked current.

    Input columns: key, order, version, published_date, is_current and the
    project's own project_version and project_date. Without a flagged row the
    first with the project's version is current, else the very first.
    """
    label = codes.version_value(first_non_blank("version", "project_version"))
    published = F.coalesce(first_non_blank("published_date", "project_date"), F.lit(""))
    rows = versions.select(
        key, order, label.alias("version"), published.alias("publication_date"),
        first_number("version").alias("_number"),
        F.coalesce("is_current", F.lit(False)).alias("_flag"),
        codes.version_value("project_version").alias("_wanted"))
    # one row per stored version first: the project facts come from these few rows
    grouped = rows.groupBy(key, "version", "publication_date").agg(
        F.min(order).alias("_first"), F.bool_or("_flag").alias("_any"),
        F.min_by(F.struct("_flag", "_number", "_wanted"), order).alias("_r"))
    match = F.col("version") == F.col("_r._wanted")
    facts = grouped.groupBy(key).agg(
        F.bool_or("_any").alias("_flagged"),
        F.min_by("_first", F.struct(~match, F.col("_first"))).alias("_chosen"))
    current = F.when(F.col("_flagged"), F.col("_r._flag")).otherwise(
        F.col("_first") == F.col("_chosen"))
    return grouped.join(facts, key).select(
        key, F.col("_first").alias(order),
        F.coalesce("_r._number", first_number("version")).alias("version_id"), "version",
        codes.release_state("publication_date").alias("version_state"), "publication_date",
        codes.version_folder("version").alias("download_version_folder"),
        current.alias("is_current"))


def with_unlisted(versions: DataFrame, projects: DataFrame, key: str, order: str) -> DataFrame:
    """The input of `version_rows`, with one current row for each project that lists no version.

    `versions` has key, order, version, published_date, is_current; `projects`
    has key, project_version, project_date, which every row gets.
    """
    listed = versions.select(key, order, "version", "published_date", "is_current").join(
        projects, key)
    text = F.lit(None).cast("string")
    alone = projects.join(versions.select(key).distinct(), key, "left_anti").select(
        key, F.lit(0).cast("bigint").alias(order), text.alias("version"),
        text.alias("published_date"), F.lit(True).alias("is_current"), "project_version",
        "project_date")
    return listed.unionByName(alone)


def version_for_files(rows: DataFrame, wanted: DataFrame, key: str, order: str) -> DataFrame:
    """The version downloaded files belong to: current, else matching, else first."""
    joined = rows.join(wanted.select(key, codes.version_value("project_version").alias("_w")), key)
    place = F.struct(~F.col("is_current"), F.col("version") != F.col("_w"), F.col(order))
    return joined.groupBy(key).agg(F.min_by(order, place).alias(order),
                                   F.min_by("version", place).alias("version"))


def page_versions(
    versions: DataFrame, key: str, order: str, studies: DataFrame | None = None
) -> DataFrame:
    """Versions listed on pages: distinct by version, date and URL, current marked.

    Needs key, order, version, published_date, url, current_version. When none
    equals the current version the first one listed is current. `studies` (key,
    current_version, page_url) gives a blank URL its page's, and a study without
    a listed version one current row where it has a current version.
    """
    from gleanery.functions.text import clean_text
    from gleanery.functions.urls import url_identity

    if studies is not None:
        pages = studies.select(key, F.col("page_url").alias("_page"))
        versions = versions.join(pages, key, "left").withColumn(
            "url", first_non_blank("url", "_page")).drop("_page")
        alone = studies.filter(first_non_blank("current_version").isNotNull()).join(
            versions.select(key).distinct(), key, "left_anti")
        versions = versions.select(
            key, order, "version", "published_date", "url", "current_version").unionByName(
            alone.select(key, F.lit(0).cast("bigint").alias(order),
                         F.col("current_version").alias("version"),
                         F.lit("").alias("published_date"), F.col("page_url").alias("url"),
                         "current_version"))
    rows = versions.select(
        key, order, clean_text("version").alias("version"),
        F.coalesce(codes.iso_date("published_date"), F.lit("")).alias("published_date"),
        url_identity("url", "version").alias("url"),
        clean_text("current_version").alias("_wanted"))
    distinct = rows.groupBy(key, "version", "published_date", "url").agg(
        F.min(order).alias(order), F.min_by("_wanted", order).alias("_wanted"))
    match = F.coalesce(F.col("version") == F.col("_wanted"), F.lit(False))
    facts = distinct.groupBy(key).agg(F.bool_or(match).alias("_any"), F.min(order).alias("_first"))
    current = F.when(F.col("_any"), match).otherwise(F.col(order) == F.col("_first"))
    return distinct.join(facts, key).select(
        key, order, "version", "published_date", "url", current.alias("is_current"))
