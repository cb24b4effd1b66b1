"""URL and DOI scalars, as regular expressions over cleaned text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import as_col, clean_text, collapse_wide

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_HIERARCHY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"


def dedupe_url(c) -> Column:
    """URL without trailing slashes."""
    return F.regexp_replace(clean_text(c), r"/+$", "")


def canonical_url(c) -> Column:
    """Scheme in lower case, fragment and empty query off; non-URLs unchanged."""
    text = collapse_wide(c)
    body = F.regexp_replace(text, r"^[^:]*", "")
    body = F.regexp_replace(body, r"#.*$", "")
    body = F.regexp_replace(body, r"^([^?]*)\?$", "$1")
    rebuilt = F.concat(F.lower(F.regexp_extract(text, r"^([^:]*)", 1)), body)
    return F.when(text.rlike(_SCHEME + r"//[^/?#]+"), rebuilt).otherwise(text)


def canonical_doi(c) -> Column:
    """Resolver prefix in one spelling; bare DOIs get it; other text unchanged."""
    text = collapse_wide(c)
    prefix = r"(?i)^https?://(?:dx\.)?doi\.org/"
    return (
        F.when(text.rlike(prefix),
               F.concat(F.lit("https://doi.org/"), F.regexp_replace(text, prefix, "")))
        .when(text.rlike(r"^10\.\d{4,9}/\S+$"), F.concat(F.lit("https://doi.org/"), text))
        .otherwise(text)
    )


def percent_decode(c) -> Column:
    """Decode %XX, leaving `+` and malformed escapes as they are."""
    safe = F.regexp_replace(as_col(c), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def form_decode(c) -> Column:
    """Decode a query value: `+` is a space. Plain values skip the decoder."""
    c = as_col(c)
    decoded = F.try_url_decode(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(c.contains("%") | c.contains("+"), decoded).otherwise(c)


def form_encode(c) -> Column:
    """Encode a query value; `~` stays and `*` does not."""
    return F.replace(
        F.replace(F.url_encode(as_col(c)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def url_path(c) -> Column:
    return F.regexp_replace(
        F.regexp_extract(as_col(c), _HIERARCHY + r"([^?#]*)", 1), r";[^/]*$", ""
    )


def url_query(c) -> Column:
    return F.regexp_extract(as_col(c), r"^[^?#]*\?([^#]*)", 1)


def query_value(c, key: str) -> Column:
    """First non-blank value of a query parameter, decoded, else empty."""
    return F.coalesce(
        form_decode(F.regexp_extract(url_query(c), rf"(?:^|&){key}=([^&]+)", 1)), F.lit("")
    )


def url_file_name(c) -> Column:
    """Last segment of the decoded path."""
    return collapse_wide(F.substring_index(percent_decode(url_path(c)), "/", -1))


def resource_file_name(c) -> Column:
    """File name where a `path` query parameter, if any, wins over the URL path."""
    inner = percent_decode(query_value(c, "path"))
    path = F.when(inner != "", inner).otherwise(percent_decode(url_path(c)))
    return collapse_wide(F.substring_index(F.regexp_replace(path, r"/+$", ""), "/", -1))


def name_extension(name: Column) -> Column:
    """Extension of a file name, empty when it has none."""
    return F.when(
        F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1))
    ).otherwise(F.lit(""))


# Which query parameters identify what; None keeps all but the session id.
IDENTITY_PARAMETERS = {
    "page": None,
    "crawl": ["pageSelected", "pageSize", "path", "type"],
    "file": ["path", "type"],
    "version": [],
}


def url_identity(c, kind: str) -> Column:
    """URL reduced to what identifies it, query parameters sorted by name and value."""
    url = as_col(c)
    keep = IDENTITY_PARAMETERS[kind]
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1))
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)", 1)
    base = F.concat(scheme, host, url_path(url))
    if keep == []:
        return base
    def name(pair):
        return form_decode(F.substring_index(pair, "=", 1))

    def content(pair):
        at = F.instr(pair, "=")
        return F.when(at > 0, form_decode(F.substr(pair, at + 1))).otherwise(F.lit(""))

    if keep is None:
        wanted = lambda p: (p != "") & (F.lower(name(p)) != "jsessionid")
    else:
        wanted = lambda p: name(p).isin(keep)
    pairs = F.transform(F.filter(F.split(url_query(url), "&"), wanted), lambda p: F.struct(
        name(p).alias("k"), content(p).alias("v")))
    query = F.array_join(
        F.transform(F.sort_array(pairs),
                    lambda p: F.concat(form_encode(p["k"]), F.lit("="), form_encode(p["v"]))),
        "&",
    )
    # base and encoded query hold no question mark, so only an empty query leaves one at the end
    return F.rtrim(F.concat(base, F.lit("?"), query), F.lit("?"))


def remove_dots(segments: Column) -> Column:
    """Path segments with `.` and `..` steps carried out; climbing stops at the root."""
    none = F.array().cast("array<string>")
    last = F.element_at(segments, -1)
    steps = F.when(last.isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    return F.aggregate(steps, none, lambda done, s: F.when(
        s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s))))


def resolve(base, href) -> Column:
    """Absolute form of a link found on a page.

    A path goes through one fold over its segments, however deep it climbs; query
    and fragment are no part of it. Links with a scheme or host stay as they are.
    """
    base, href = as_col(base), F.trim(as_col(href))
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    path = url_path(base)
    folder = F.regexp_replace(path, r"^/+|[^/]*$", "")
    tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    way = F.substr(href, F.lit(1), F.length(href) - F.length(tail))
    parts = F.split(F.concat(folder, way), "/")
    # empty steps inside a relative path fall away, one at its end stays
    inner = F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda s: s != "")
    below = F.concat(inner, F.slice(parts, F.lit(-1), F.lit(1)))
    rooted = F.split(F.substr(way, F.lit(2)), "/")
    full = lambda segments: F.concat(
        origin, F.lit("/"), F.array_join(remove_dots(segments), "/"), tail)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), full(rooted))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(origin, path, href))
        .otherwise(full(below))
    )


def study_id(c) -> Column:
    return F.regexp_extract(as_col(c), r"/studies/(\d+)", 1)


def project_id(c) -> Column:
    return F.regexp_extract(as_col(c), r"/project/(\d+)", 1)


def url_version(c) -> Column:
    return F.regexp_extract(as_col(c), r"/version/([^/]+)/", 1)


def page_type(c) -> Column:
    """Which extraction profile a URL belongs to."""
    low = F.lower(F.trim(as_col(c)))
    kind = F.lit("unknown")
    for name, marker in reversed(list(vocab.PAGE_TYPE_MARKERS.items())):
        kind = F.when(low.contains(marker), F.lit(name)).otherwise(kind)
    return kind


def study_pages(c) -> Column:
    """Map of page name to URL for one study: the pages still to be fetched."""
    base = F.concat(F.lit(vocab.STUDY_URL), as_col(c).cast("string"))
    entries = [F.lit("main"), base]
    for name in vocab.STUDY_SUBPAGES:
        entries += [F.lit(name), F.concat(base, F.lit(f"/{name}"))]
    return F.create_map(*entries)


def search_url(base: str, keyword, start, rows: int) -> Column:
    return F.concat(
        F.lit(f"{base}?q="), form_encode(keyword), F.lit("&start="),
        as_col(start).cast("string"), F.lit(f"&rows={rows}"),
    )


def result_url(url, ident) -> Column:
    """Explicit URL of a search hit, else the study page of its id."""
    return F.coalesce(
        F.nullif(clean_text(url), F.lit("")),
        F.concat(F.lit(vocab.STUDY_URL), as_col(ident).cast("string")),
        F.lit(""),
    )
