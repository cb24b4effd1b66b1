"""People of a project: role buckets and stored role rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import clean_text, match_form


def role_bucket(role) -> Column:
    """Which of the four stored roles a free-text role belongs to."""
    form = F.coalesce(match_form(role), F.lit(""))
    return (
        F.when(form.contains("contact"), F.lit("CONTACT"))
        .when(form.contains("producer"), F.lit("PRODUCER"))
        .when(form.contains("author") | form.contains("creator"), F.lit("AUTHOR"))
        .otherwise(F.lit("CONTRIBUTOR"))
    )


def person_roles(people: DataFrame, key: str, name: str, role: str) -> DataFrame:
    """Stored role rows: each name once per project and role, blanks out."""
    return (
        people.select(key, role_bucket(role).alias("role"), clean_text(name).alias("name"))
        .filter(F.col("name") != "").distinct()
    )


def author_contributors(authors: DataFrame, key: str, place: str, name: str, affiliation: str):
    """Authors as contributor rows with the affiliation of the same place."""
    return authors.select(
        key, place, clean_text(name).alias("name"), F.lit("Creator").alias("role"),
        F.coalesce(clean_text(affiliation), F.lit("")).alias("affiliation"))
