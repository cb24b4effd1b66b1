"""Label operators over frames, in steps so that no step is evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.codes import lookup
from gleanery.functions.text import clean_markup_text, clean_text, safe_file


_BRACKET = r"^(.*?) ?\[([^\]]+)\] ?(.*)$"


def add_bracket_parts(df: DataFrame, column: str) -> DataFrame:
    """Split cleaned `prefix [bracket] suffix` text; without a bracket all is prefix.

    New columns: prefix, bracket, suffix. They are plain columns, not a struct:
    the optimiser inlines struct fields and would run the patterns once per use.
    """
    has = F.col(column).rlike(_BRACKET)
    part = lambda g: F.trim(F.regexp_extract(column, _BRACKET, g))
    return (
        df.withColumn("prefix", F.when(has, part(1)).otherwise(F.col(column)))
        .withColumn("bracket", F.when(has, part(2)).otherwise(F.lit("")))
        .withColumn("suffix", F.when(has, part(3)).otherwise(F.lit("")))
    )


def _announced_format() -> Column:
    """Format a label announces in its bracket, as a whole, or as a setup kind."""
    out = F.coalesce(lookup(vocab.BRACKET_EXTENSIONS, F.lower("bracket")),
                     lookup(vocab.LABEL_FORMATS, F.col("_low")))
    for phrase, ext in vocab.SETUP_FORMATS.items():
        out = F.coalesce(out, F.when(F.col("_low").contains(phrase), F.lit(ext)))
    return F.coalesce(out, F.lit(""))


def _with_suffix(base: str, suffix: str, profile: str) -> Column:
    """Base name that ends in the suffix, which it may already do."""
    return F.when(F.endswith(F.lower(base), F.col(suffix)), F.col(base)).otherwise(
        safe_file(F.concat(base, suffix), profile))


def add_download_name(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the download name of a label: suffix, else prefix, with the bracket's extension."""
    return (
        add_bracket_parts(df.withColumn("_label", clean_text(column)), "_label")
        .withColumn("_base", safe_file(
            F.when(F.col("suffix") != "", F.col("suffix")).otherwise(F.col("prefix")),
            "download"))
        .withColumn("_suffix", F.coalesce(
            F.concat(F.lit("."), lookup(vocab.BRACKET_EXTENSIONS, F.lower("bracket"))),
            F.lit("")))
        .withColumn(out, _with_suffix("_base", "_suffix", "download"))
        .drop("_label", "prefix", "bracket", "suffix", "_base", "_suffix")
    )


def add_resource_label(df: DataFrame, column: str) -> DataFrame:
    """Add what a menu label says about its file.

    New columns: raw_label, content_label, display_name, file_extension,
    file_category, file_name, identity_key.
    """
    prefixes = "^(?:" + "|".join(vocab.DOC_PREFIXES) + ")"
    return (
        add_bracket_parts(df.withColumn("raw_label", clean_markup_text(column)), "raw_label")
        .withColumn("_has", F.col("bracket") != "")
        .withColumn("content_label",
                    F.when(F.col("_has"), F.col("prefix")).otherwise(F.col("raw_label")))
        .withColumn("display_name",
                    F.when(F.col("_has"), F.col("suffix")).otherwise(F.col("raw_label")))
        .withColumn("_low", F.lower("raw_label"))
        .withColumn("file_extension", _announced_format())
        .withColumn("_content", F.lower("content_label"))
        .withColumn("_display", F.lower("display_name"))
        .withColumn(
            "file_category",
            F.when(F.col("_display").isin(vocab.METRICS_NAMES), F.lit("other"))
            .when(F.col("_display").contains("setup") | F.col("_content").contains("setup"),
                  F.lit("setup"))
            .when(F.col("_content").isin(list(vocab.LABEL_FORMATS)), F.lit("data"))
            .when(F.col("_content").rlike(prefixes) | (F.col("file_extension") == "pdf"),
                  F.lit("documentation"))
            .otherwise(F.lit("other")),
        )
        .withColumn("_base", safe_file(
            F.when(F.col("display_name") != "", F.col("display_name"))
            .otherwise(F.col("raw_label")), "record"))
        .withColumn("_suffix", F.when(F.col("file_extension") != "", F.concat(
            F.lit("."), F.col("file_extension"))).otherwise(F.lit("")))
        .withColumn("file_name", _with_suffix("_base", "_suffix", "record"))
        .withColumn("identity_key", F.concat_ws("|", "_display", "file_extension", "_content"))
        .drop("prefix", "bracket", "suffix", "_has", "_low", "_content", "_display", "_base", "_suffix")
    )
