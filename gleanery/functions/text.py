"""Text scalars. All are built-in expressions except entity decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions import workers

# Every character that counts as white space in the source rules: the Unicode
# White_Space property plus the four ASCII separators it leaves out.
SPACE = r"[\s\x1c-\x1f]"
WIDE_SPACE = r"[\s\x1c-\x1f\u200b\ufeff]"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Runs of white space become one space, ends are trimmed. NULL stays NULL."""
    return F.trim(F.regexp_replace(as_col(c), rf"(?U){SPACE}+", " "))


def text_or_null(c) -> Column:
    """Cleaned text, with blank as NULL."""
    return F.nullif(clean_text(c), F.lit(""))


def first_non_blank(*cols) -> Column:
    return F.coalesce(*[text_or_null(c) for c in cols])


def unescape_entities(c) -> Column:
    """Decode character references; only values with an ampersand reach Python."""
    c = as_col(c)
    return F.coalesce(workers.unescape(F.when(c.contains("&"), c)), c)


def collapse_wide(c) -> Column:
    return F.trim(F.regexp_replace(as_col(c), rf"(?U){WIDE_SPACE}+", " "))


def clean_markup_text(c) -> Column:
    """Decode references, then collapse white space including zero-width marks."""
    return collapse_wide(unescape_entities(c))


def strip_tags(c) -> Column:
    """Markup fragment to text: comments, tags and script bodies out, text nodes kept."""
    c = F.regexp_replace(as_col(c), r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return clean_markup_text(F.regexp_replace(c, r"(?s)<[/!?a-zA-Z][^>]*>", " "))


def visible_text(c) -> Column:
    """Page text without scripts, styles, fallbacks, comments and tags."""
    c = F.regexp_replace(as_col(c), r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    return clean_markup_text(F.regexp_replace(c, r"(?s)<[/!?a-zA-Z][^>]*>", " "))


def fold(c) -> Column:
    """Lower-cased and stripped at both ends, inner spacing untouched."""
    return F.lower(F.regexp_replace(as_col(c), rf"(?U)^{SPACE}+|{SPACE}+$", ""))


def match_form(c) -> Column:
    """Lower-case ASCII words with plural endings removed, joined by one space.

    Two passes over the whole string do what a token loop would: `-ies` to
    `-y` first, then `-ses` to `-s` or a single final `s` off, in one
    alternation so that a word is shortened once only. Words of up to three
    letters and words in `-ss` stay. Only the ending is matched and the word
    before it is looked back at, so each letter is visited once.
    """
    words = F.trim(F.regexp_replace(F.lower(as_col(c)), r"[^a-z0-9]+", " "))
    words = F.regexp_replace(words, r"(?<=[a-z0-9]{2})ies(?= |$)", "y")
    return F.regexp_replace(
        words, r"(?<=[a-z0-9]{2}s)es(?= |$)|(?<=[a-z0-9]{2}[a-rt-z0-9])s(?= |$)", ""
    )


def safe_folder(c) -> Column:
    """Folder-safe name: lower case, separators and odd characters to `-`."""
    name = F.regexp_replace(F.lower(clean_text(c)), r"[\\/]+", "-")
    return F.btrim(F.regexp_replace(name, r"[^a-z0-9._-]+", "-"), F.lit("-_"))


def safe_file(c, profile: str = "plain") -> Column:
    """File-safe name. The four profiles differ in what they replace and default to.

    Character references have to be decoded before (`clean_markup_text`).
    """
    name = clean_text(c)
    if profile == "plain":
        return F.regexp_replace(name, r"[\\/]+", "_")
    if profile == "record":
        name = F.regexp_replace(name, r"^https?://", "")
        name, default = F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), "metadata"
        ends = "._"
    elif profile == "search":
        name, default = F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), "search_results"
        ends = "._"
    elif profile == "download":
        name = F.regexp_replace(name, r"(?U)[^\w.\- ]+", "_")
        name, default, ends = F.regexp_replace(name, r" +", "_"), "download.bin", "._ "
    else:
        raise ValueError(f"unknown profile: {profile}")
    return F.coalesce(F.nullif(F.btrim(name, F.lit(ends)), F.lit("")), F.lit(default))


def file_extension(c) -> Column:
    """Text after the last dot, lower case; `unknown` when there is no dot."""
    name = clean_text(c)
    return F.when(
        F.instr(name, ".") > 0, F.lower(F.trim(F.substring_index(name, ".", -1)))
    ).otherwise(F.lit("unknown"))


def file_stem(c) -> Column:
    """Name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(as_col(c), r"(?s)(?<=.)\.[^.]+$", "")


def first_number(c) -> Column:
    """First run of digits as a 64-bit integer, else NULL."""
    return F.nullif(
        F.regexp_extract(as_col(c), r"\d+", 0), F.lit("")
    ).try_cast("bigint")


def flag(c) -> Column:
    """Tri-state flag: listed spellings only, everything else is NULL."""
    c = as_col(c).cast("string")
    return (
        F.when(c.isin("1", "true", "TRUE", "yes", "YES"), F.lit(True))
        .when(c.isin("0", "false", "FALSE", "no", "NO"), F.lit(False))
    )


def label_text(c) -> Column:
    """Visible label without its trailing help link."""
    return F.trim(F.regexp_replace(clean_text(c), r"View help for.*$", ""))


def is_noise(c) -> Column:
    """Values that are page furniture rather than metadata."""
    low = F.lower(F.coalesce(clean_text(c), F.lit("")))
    return low.isin("", "hide", "beta") | low.startswith("view help for")


def search_keyword(c) -> Column:
    """Search term, with nothing or blank meaning everything (`*`)."""
    return F.coalesce(text_or_null(c), F.lit("*"))
