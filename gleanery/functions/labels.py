"""Visible labels of menus, tables and links: what file do they stand for?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.codes import lookup
from gleanery.functions.text import as_col, clean_text

def dataset_row(name, css_class=None) -> Column:
    """Number, identifier and title of a dataset row.

    The number comes from a `dataset-N` class if the row has one, else from a
    leading `DS N` in the text; either way the prefix leaves the title.
    """
    text = clean_text(name)
    shape = r"(?i)^DS\s*(\d+)\s+(.*)$"
    by_text = F.nullif(F.regexp_extract(text, shape, 1), F.lit("")).try_cast("bigint")
    text_title = F.when(text.rlike(shape), clean_text(F.regexp_extract(text, shape, 2)))
    if css_class is None:
        by_class = F.lit(None).cast("bigint")
    else:
        by_class = F.nullif(
            F.regexp_extract(as_col(css_class), r"(?:^|\s)dataset-(\d+)(?:\s|$)", 1), F.lit("")
        ).try_cast("bigint")
    lead = F.regexp_extract(text, r"(?i)^DS\s*(\d+)", 1)
    # `DS1` must not be cut from `DS10`: compare as the text the class names
    starts = F.startswith(lead, by_class.cast("string"))
    cut = F.trim(F.concat(
        F.substr(lead, F.length(by_class.cast("string")) + 1),
        F.regexp_replace(text, r"(?i)^DS\s*\d+", ""),
    ))
    number = F.coalesce(by_class, by_text)
    title = F.when(by_class.isNull(), F.coalesce(text_title, text)).otherwise(
        F.when(starts, cut).otherwise(text)
    )
    return F.struct(
        number.alias("dataset_number"),
        F.coalesce(F.concat(F.lit("DS"), number.cast("string")), F.lit("")).alias(
            "dataset_identifier"),
        title.alias("dataset_title"),
    )


def _any(hay: Column, words: list[str]) -> Column:
    """Does the text hold one of the words? One pass with an alternation."""
    quoted = "|".join("\\Q" + w + "\\E" for w in words)
    return hay.rlike(quoted)


def open_file_content(title, href, context, extension) -> Column:
    """Content label of a listed project file, first rule wins."""
    hay = F.lower(clean_text(F.concat_ws(" ", as_col(title), as_col(href), as_col(context))))
    out = F.when(hay.contains("metrics") | hay.contains("usage/download"), F.lit(""))
    for label, words in vocab.OPEN_CONTENT_RULES:
        out = out.when(_any(hay, words), F.lit(label))
    for label, extensions in vocab.OPEN_CONTENT_EXTENSIONS:
        out = out.when(as_col(extension).isin(extensions), F.lit(label))
    return out.when(hay.contains("download") & hay.contains("data"), F.lit("Data")).otherwise(
        F.lit("")
    )


def folder_file_content(title, name, href, folder, extension) -> Column:
    """Content label of a file in a project folder table, first rule wins."""
    hay = F.lower(clean_text(
        F.concat_ws(" ", as_col(title), as_col(name), as_col(href), as_col(folder))))
    ext = as_col(extension)
    out = F.when(hay.contains("metrics") | hay.contains("usage/download"), F.lit(""))
    for label, words in vocab.FOLDER_CONTENT_RULES:
        out = out.when(_any(hay, words), F.lit(label))
    sheet = ext.isin("xlsx", "xls")
    return (
        out.when(ext.isin(vocab.FOLDER_DATA_EXTENSIONS), F.lit("Data"))
        .when(sheet & hay.contains("chart"), F.lit("Other"))
        .when(sheet & hay.contains("variable"), F.lit("Documentation"))
        .when(sheet, F.lit("Data"))
        .when(ext == "pdf", F.lit("Documentation"))
        .otherwise(F.lit("Other"))
    )


def file_category(content, extension, profile: str) -> Column:
    """Category from the content label, else from the extension, else `other`."""
    label = F.lower(clean_text(content))
    return (
        F.when(label.isin("codebook", "questionnaire", "documentation"), F.lit("documentation"))
        .when(label.isin("data", "setup"), label)
        .otherwise(F.coalesce(
            lookup(vocab.CATEGORY_BY_EXTENSION[profile], F.lower(clean_text(extension))),
            F.lit("other")))
    )


def export_formats(c) -> Column:
    """Export formats a text mentions, in canonical order."""
    low = F.lower(clean_text(c))
    return F.array_compact(F.array(*[
        F.when(low.rlike(pattern), F.lit(label)) for label, pattern in vocab.EXPORT_FORMATS.items()
    ]))


