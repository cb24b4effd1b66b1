"""Array functions: cleaning, ordered union, splitting, joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import workers
from gleanery.functions.codes import organisation
from gleanery.functions.text import as_col, clean_text, collapse_wide



def _empty() -> Column:
    return F.array().cast("array<string>")


def as_list(c) -> Column:
    """One value as a list; NULL as the empty list."""
    c = as_col(c)
    return F.when(c.isNull(), _empty()).otherwise(F.array(c))


def clean_list(c, drop: bool = False) -> Column:
    """Cleaned entries, blanks out, first occurrence of each kept in order.

    With `drop`, entries that are only page furniture go as well.
    """
    items = F.transform(F.coalesce(as_col(c), _empty()), clean_text)
    if drop:
        keep = lambda x: x.isNotNull() & ~F.lower(x).isin(vocab.DROPPED_VALUES)
    else:
        keep = lambda x: x.isNotNull() & (x != "")
    return F.array_distinct(F.filter(items, keep))


def clean_markup_list(c) -> Column:
    """`clean_list` for entries that may hold tags and character references."""
    bare = F.transform(
        F.coalesce(as_col(c), _empty()),
        lambda x: F.regexp_replace(x, r"(?s)<!--.*?-->|<[/!?a-zA-Z][^>]*>", " "),
    )
    items = F.transform(workers.unescape_each(F.filter(bare, lambda x: x.isNotNull())), collapse_wide)
    return F.array_distinct(
        F.filter(items, lambda x: ~F.lower(x).isin(vocab.DROPPED_VALUES))
    )


def union_lists(*cols) -> Column:
    """Ordered union: entries of earlier lists first, each once."""
    return F.array_distinct(F.concat(*[F.coalesce(as_col(c), _empty()) for c in cols]))


def split_semicolons(c) -> Column:
    """Entries split on `;`, cleaned, blanks out, distinct in order."""
    parts = F.flatten(F.transform(F.coalesce(as_col(c), _empty()), lambda x: F.split(x, ";")))
    return clean_list(parts)


def join_text(*cols) -> Column:
    """Non-blank cleaned parts joined by one space."""
    parts = [F.nullif(clean_text(c), F.lit("")) for c in cols]
    return F.concat_ws(" ", *parts)


def organisations(c) -> Column:
    return F.array_distinct(F.filter(
        F.transform(F.coalesce(as_col(c), _empty()), organisation), lambda x: x != ""))


def join_list(c, separator: str = "; ") -> Column:
    return F.array_join(clean_list(c), separator)


def sorted_distinct(c) -> Column:
    return F.sort_array(F.array_distinct(as_col(c)))


def first_of(c) -> Column:
    return F.get(as_col(c), F.lit(0))


