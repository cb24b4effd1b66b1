"""Code maps: versions, dates, statuses, licences, roles, keys, MIME types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import (
    as_col, clean_text, file_extension, safe_file, text_or_null,
)


def literal_map(entries: dict) -> Column:
    """A constant map as an expression, part of the plan; join a table that is no constant."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def lookup(entries: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(entries), key)


def version_value(c) -> Column:
    """Version as major.minor: `V2`, `2`, `release 2` give 2.0, blank gives 1.0.

    Only the first two runs of digits matter, whatever stands around them.
    """
    c = as_col(c)
    run = lambda pattern, default: F.coalesce(
        F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.lit(default))
    return F.concat(run(r"(\d+)", "1"), F.lit("."), run(r"\d+\D+(\d+)", "0"))


def version_folder(c) -> Column:
    return F.concat(F.lit("V"), version_value(c))


def version_label(major, minor) -> Column:
    """Label of a numbered version; without a major number it is empty."""
    major, minor = as_col(major).cast("string"), as_col(minor).cast("string")
    return F.coalesce(
        F.when(minor.isNull(), major).otherwise(F.concat(major, F.lit("."), minor)), F.lit("")
    )


def iso_date(c) -> Column:
    """ISO date where the text is one of four known shapes, else the cleaned text."""
    text = clean_text(c)
    clock = r"(?: (?:0?[1-9]|1[0-2]):[0-5]?[0-9](?::(?:[0-5]?[0-9]|6[01]))?:(?i:am|pm))?"
    ymd = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
    mdy = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){clock}$"

    def build(pattern, y, m, d):
        part = lambda g: F.regexp_extract(text, pattern, g)
        day = F.concat_ws("-", part(y), F.lpad(part(m), 2, "0"), F.lpad(part(d), 2, "0"))
        return F.when(text.rlike(pattern), day.try_cast("date").cast("string"))

    return F.coalesce(build(ymd, 1, 2, 3), build(mdy, 3, 1, 2), text)


def period(c) -> Column:
    """`m/yyyy - m/yyyy` as `yyyy-mm -- yyyy-mm`; other text only loses long dashes."""
    text = F.regexp_replace(clean_text(c), "[–—]", "-")
    shape = r"^(\d{1,2})/(\d{4})\s*-\s*(\d{1,2})/(\d{4})$"
    part = lambda g: F.regexp_extract(text, shape, g)
    return F.when(
        text.rlike(shape),
        F.concat(part(2), F.lit("-"), F.lpad(part(1), 2, "0"), F.lit(" -- "),
                 part(4), F.lit("-"), F.lpad(part(3), 2, "0")),
    ).otherwise(text)


def organisation(c) -> Column:
    text = clean_text(c)
    return F.coalesce(lookup(vocab.ORGANISATIONS, F.lower(text)), text)


def license_name(c) -> Column:
    """Short licence name; spellings outside the list stay as they are."""
    text = F.trim(as_col(c))
    low = F.lower(text)
    key = F.regexp_replace(low, r"https?://", "")
    return F.coalesce(lookup(vocab.LICENSES, key), lookup(vocab.LICENSES, low), text)


def role_code(c) -> Column:
    role = F.upper(F.trim(as_col(c)))
    return (
        F.when(role == "AUTHOR", role)
        .when(role.isin("CONTACT", "CONTRIBUTOR", "PRODUCER"), F.lit("OTHER"))
        .when(role.isin("OWNER", "UPLOADER", "OTHER", "UNKNOWN"), role)
        .otherwise(F.lit("UNKNOWN"))
    )


def release_state(published) -> Column:
    return F.when(text_or_null(published).isNotNull(), F.lit("RELEASED"))


def project_key(repository, project, kind=None) -> Column:
    """Numeric key: the decimal digits of repository, page type and project in a row.

    An id that is no number gets a stable hash in its place; no id, no key.
    """
    ident = text_or_null(as_col(project).cast("string"))
    digits = F.when(ident.rlike(r"^\d+$"), ident).when(
        ident.isNotNull(), F.pmod(F.xxhash64(ident), F.lit(10**12)).cast("string"))
    parts = [as_col(repository).cast("string")]
    if kind is not None:
        digit = F.coalesce(lookup(vocab.PAGE_TYPES, F.lower(clean_text(kind))), F.lit(9))
        parts.append(digit.cast("string"))
    return F.concat(*parts, digits).try_cast("bigint")


def http_status_code(http_status, size_bytes=None, limit: int = vocab.MAX_DOWNLOAD_BYTES) -> Column:
    """File state of a fetch outcome; a missing response is unresponsive."""
    code = as_col(http_status)
    ok = code == 200
    state = F.lit("SUCCEEDED")
    if size_bytes is not None:
        state = F.when(as_col(size_bytes) > limit, F.lit("FAILED_TOO_LARGE")).otherwise(state)
    return (
        F.when(ok, state)
        .when(code.isin(401, 403), F.lit("FAILED_LOGIN_REQUIRED"))
        .when(code == 413, F.lit("FAILED_TOO_LARGE"))
        .otherwise(F.lit(vocab.UNRESPONSIVE))
    )


def file_status(c) -> Column:
    """Known state or, for anything else, unresponsive."""
    status = clean_text(c)
    return F.when(status.isin(vocab.STATUSES), status).otherwise(F.lit(vocab.UNRESPONSIVE))


def mime_type(extension, profile: str, declared=None) -> Column:
    """MIME type from the declared format if that is known, else from the extension."""
    table = vocab.MIME_TYPES[profile]
    found = [lookup(table, F.lower(clean_text(extension)))]
    if declared is not None:
        found.insert(0, lookup(table, F.lower(clean_text(declared))))
    return F.coalesce(*found, F.lit(""))


def format_of(extension, mime, profile: str) -> Column:
    """Extension, else the first extension that has the MIME type."""
    first: dict[str, str] = {}
    for ext, kind in vocab.MIME_TYPES[profile].items():
        first.setdefault(kind, ext)
    return F.coalesce(
        F.nullif(F.lower(clean_text(extension)), F.lit("")), lookup(first, as_col(mime)), F.lit("")
    )


def bucket_name(qualitative, has_files) -> Column:
    q, f = as_col(qualitative), as_col(has_files)
    return (
        F.when(q & f, F.lit(vocab.BUCKETS[0])).when(q & ~f, F.lit(vocab.BUCKETS[1]))
        .when(f, F.lit(vocab.BUCKETS[2])).otherwise(F.lit(vocab.BUCKETS[3]))
    )


def package_name(kind, ident, version) -> Column:
    """Placeholder file name of a package that could not be fetched."""
    prefix = F.coalesce(lookup(vocab.PACKAGE_PREFIX, F.lower(clean_text(kind))), F.lit("Study"))
    study = F.coalesce(text_or_null(as_col(ident).cast("string")), F.lit("unknown"))
    return safe_file(
        F.concat(prefix, F.lit("_"), study, F.lit("-V"), version_value(version), F.lit(".zip")),
        "download",
    )


def output_path(root: str, kind, ident, version) -> Column:
    """Folder a study's files belong in, as text."""
    study = F.coalesce(text_or_null(as_col(ident).cast("string")), F.lit("unknown_study"))
    page = F.coalesce(F.nullif(F.lower(clean_text(kind)), F.lit("")), F.lit("study"))
    folder = safe_file(F.concat(study, F.lit("_"), page), "download")
    return F.concat_ws("/", F.lit(root), folder, version_folder(version))


def row_type(name, declared) -> Column:
    """File type of a stored row: the declared one, else the name's extension."""
    return F.coalesce(
        text_or_null(declared), F.nullif(file_extension(name), F.lit("")), F.lit("unknown")
    )


def citation_parts(c) -> Column:
    """DOI, date and distributor read from a citation line."""
    text = clean_text(c)
    from gleanery.functions.urls import canonical_doi

    doi = F.regexp_extract(text, r"(?i)https?://doi\.org/\S+", 0)
    distributor = F.regexp_extract(text, r"(?i):\s*([^.;]+?)\s*\[distributor\]", 1)
    return F.struct(
        canonical_doi(F.rtrim(doi, F.lit(".,)"))).alias("doi"),
        F.regexp_extract(text, r"\b\d{4}-\d{2}-\d{2}\b", 0).alias("published_date"),
        organisation(distributor).alias("distributor"),
    )


def publication_parts(c) -> Column:
    """Title, year and DOI of one publication line; absent parts are NULL."""
    from gleanery.functions.urls import canonical_doi

    c = as_col(c)
    doi = F.rtrim(F.regexp_extract(c, r"(10\.\d{4,9}/[^\s;]+)", 1), F.lit(".,)"))
    return F.struct(
        clean_text(c).alias("title"),
        F.nullif(F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1), F.lit("")).alias("year"),
        F.nullif(canonical_doi(doi), F.lit("")).alias("doi"),
    )


