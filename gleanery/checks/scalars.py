"""Scalar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.checks import query
from gleanery.fixtures import spread, table, view, with_views
from gleanery.functions import codes, labels, lists, text, urls
from gleanery.operators.labels import add_download_name, add_resource_label

SPACES = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
          r"\x{202F}\x{205F}\x{3000}]+")


FILE_KEY = ("project_id", "dataset_number", "part_no", "uri_no")


def cleaned(column: str) -> str:
    return f"trim(regexp_replace({column}, '{SPACES}', ' ', 'g'))"


def case(column: str, entries: dict, default: str) -> str:
    arms = " ".join("WHEN '%s' THEN '%s'" % (k.replace("'", "''"), v.replace("'", "''"))
                    for k, v in entries.items())
    return f"CASE {column} {arms} ELSE {default} END"


def singular(column: str) -> str:
    return (f"list_transform(string_split({column}, ' '), lambda t: CASE "
            "WHEN length(t) <= 3 THEN t "
            "WHEN suffix(t, 'ies') AND length(t) > 4 THEN left(t, -3) || 'y' "
            "WHEN suffix(t, 'ses') AND length(t) > 4 THEN left(t, -2) "
            "WHEN suffix(t, 's') AND NOT suffix(t, 'ss') THEN left(t, -1) ELSE t END)")


def match_form_sql(column: str) -> str:
    words = f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', ' ', 'g'))"
    return f"array_to_string({singular(words)}, ' ')"


@query("clean_text", f"""
    SELECT doc_id, length(t) AS n, md5(t) AS digest, md5(lower(trim(text))) AS folded
    FROM (SELECT doc_id, text, {cleaned('text')} AS t FROM documents)""")
def _(spark, d):
    return (spread(table(spark, d, "documents"), "doc_id").select("doc_id", "text", text.clean_text("text").alias("t"))
            .select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5("t").alias("digest"),
                    F.md5(text.fold("text")).alias("folded")))


@query("normalize_for_match", f"""
    SELECT doc_id, md5(m) AS digest, length(m) AS n
    FROM (SELECT doc_id, {match_form_sql('text')} AS m FROM documents)""")
def _(spark, d):
    return (spread(table(spark, d, "documents"), "doc_id").select("doc_id", text.match_form("text").alias("m"))
            .select("doc_id", F.md5("m").alias("digest"), F.length("m").cast("bigint").alias("n")))


@query("first_non_blank", with_views("fx_licenses fx_dois", """
    SELECT doc_id, coalesce(nullif(trim(license), ''), nullif(trim(raw_doi), ''), 'none') AS value
    FROM fx_licenses JOIN fx_dois ON doc_id = project_key"""))
def _(spark, d):
    return (view(spark, d, "fx_licenses").join(view(spark, d, "fx_dois"),
                                              F.col("project_key") == F.col("doc_id"))
            .select("doc_id", text.first_non_blank("license", "raw_doi", F.lit("none"))
                    .alias("value")))


@query("url_canonical", with_views("fx_links", r"""
    SELECT DISTINCT url,
           regexp_replace(url, '/+$', '') AS dedupe_url,
           lower(regexp_extract(url, '^[^:]*')) ||
             regexp_replace(regexp_replace(regexp_extract(url, ':.*$'), '#.*$', ''),
                            '^([^?]*)\?$', '\1') AS canonical,
           regexp_extract(url, '/project/(\d+)', 1) AS project_id,
           regexp_extract(url, '/version/([^/]+)/', 1) AS url_version
    FROM fx_links"""))
def _(spark, d):
    u = "url"
    return view(spark, d, "fx_links").select("url").distinct().select(
        u, urls.dedupe_url(u).alias("dedupe_url"), urls.canonical_url(u).alias("canonical"),
        urls.project_id(u).alias("project_id"), urls.url_version(u).alias("url_version"))


_PATH = r"regexp_extract(url, '://[^/?#]*([^?#]*)', 1)"
_QPATH = r"regexp_extract(url, '[?&]path=([^&#]+)', 1)"


@query("url_file_name", with_views("fx_links", f"""
    SELECT link_id, part_no, uri_no, pos, path_name,
           CASE WHEN contains(path_name, '.') THEN lower(regexp_extract(path_name, '[^.]*$'))
                ELSE '' END AS path_ext,
           resource_name,
           CASE WHEN contains(resource_name, '.') THEN lower(regexp_extract(resource_name, '[^.]*$'))
                ELSE '' END AS resource_ext
    FROM (SELECT *, regexp_extract(url_decode({_PATH}), '[^/]*$') AS path_name,
                 regexp_extract(regexp_replace(url_decode(CASE WHEN {_QPATH} <> '' THEN {_QPATH}
                     ELSE {_PATH} END), '/+$', ''), '[^/]*$') AS resource_name
          FROM fx_links)"""))
def _(spark, d):
    return (spread(view(spark, d, "fx_links"), "link_id", "part_no", "uri_no")
            .withColumn("path_name", urls.url_file_name("url"))
            .withColumn("resource_name", urls.resource_file_name("url"))
            .select("link_id", "part_no", "uri_no", "pos", "path_name",
                    urls.name_extension(F.col("path_name")).alias("path_ext"), "resource_name",
                    urls.name_extension(F.col("resource_name")).alias("resource_ext")))


@query("url_identity", with_views("fx_links", r"""
    SELECT DISTINCT url,
           base || CASE part WHEN 0 THEN '?path=%2Fa+b%2Ff' || nr || '.PDF&type=file'
                             WHEN 2 THEN '?flag=&pageSelected=2&pageSize=10' ELSE '' END AS page_id,
           base || CASE part WHEN 0 THEN '?path=%2Fa+b%2Ff' || nr || '.PDF&type=file'
                             WHEN 2 THEN '?pageSelected=2&pageSize=10' ELSE '' END AS crawl_id,
           base || CASE part WHEN 0 THEN '?path=%2Fa+b%2Ff' || nr || '.PDF&type=file'
                             ELSE '' END AS file_id,
           base AS version_id
    FROM (SELECT url, part_no % 5 AS part, CAST(part_no AS VARCHAR) AS nr,
                 lower(regexp_extract(url, '^[^:]*')) || regexp_extract(url, ':([^?#]*)') AS base
          FROM fx_links)"""))
def _(spark, d):
    return view(spark, d, "fx_links").select("url").distinct().select(
        "url", *[urls.url_identity("url", k).alias(f"{k}_id")
                 for k in ("page", "crawl", "file", "version")])


@query("page_urls", r"""
    SELECT page_id, regexp_replace(trim(url), '/+$', '') AS dedupe_url,
           CASE WHEN lower(url) LIKE '%datalumos.org/datalumos/project/%' THEN 'datalumos'
                WHEN lower(url) LIKE '%openicpsr.org/openicpsr/project/%' THEN 'openicpsr'
                WHEN lower(url) LIKE '%icpsr.umich.edu/web/icpsr/studies/%' THEN 'icpsr'
                ELSE 'unknown' END AS page_type,
           trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '[\\/]+', '-', 'g'),
                '[^a-z0-9._-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g')) AS folder_name,
           regexp_replace(trim(url), '[\\/]+', '_', 'g') AS plain_name,
           coalesce(nullif(trim(regexp_replace(regexp_replace(trim(url), '^https?://', ''),
                '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'metadata') AS record_name,
           coalesce(nullif(trim(regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''),
                'search_results') AS search_name,
           coalesce(nullif(trim(regexp_replace(regexp_replace(trim(url), '[^\w.\- ]+', '_', 'g'),
                ' +', '_', 'g'), '._ '), ''), 'download.bin') AS download_name
    FROM pages""")
def _(spark, d):
    u = "url"
    return table(spark, d, "pages").select(
        "page_id", urls.dedupe_url(u).alias("dedupe_url"), urls.page_type(u).alias("page_type"),
        text.safe_folder(u).alias("folder_name"), text.safe_file(u).alias("plain_name"),
        text.safe_file(u, "record").alias("record_name"),
        text.safe_file(u, "search").alias("search_name"),
        text.safe_file(u, "download").alias("download_name"))


@query("study_frontier", with_views("fx_projects", """
    SELECT project_id, page_name,
           'https://www.icpsr.umich.edu/web/ICPSR/studies/' || CAST(project_id AS VARCHAR)
             || CASE page_name WHEN 'main' THEN '' ELSE '/' || page_name END AS page_url
    FROM fx_projects, (SELECT unnest(['main', 'summary', 'datadocumentation', 'variables',
         'publications', 'export', 'terms']) AS page_name)
    WHERE page_type = 'icpsr'"""))
def _(spark, d):
    return (view(spark, d, "fx_projects").filter("page_type = 'icpsr'")
            .select("project_id", F.explode(urls.study_pages("project_id"))
                    .alias("page_name", "page_url")))


@query("search_requests", with_views("fx_hits", r"""
    SELECT DISTINCT term, start_pos,
           'https://search.example.org/find?q=' || replace(replace(term, ' ', '+'), '*', '%2A')
             || '&start=' || CAST(start_pos AS VARCHAR) || '&rows=20' AS url
    FROM fx_hits"""))
def _(spark, d):
    return (view(spark, d, "fx_hits").select("term", "start_pos").distinct()
            .select("term", "start_pos",
                    urls.search_url("https://search.example.org/find", text.search_keyword("term"),
                                    F.col("start_pos"), 20).alias("url")))


@query("doi_canonical", with_views("fx_dois", r"""
    SELECT doc_id, CASE
        WHEN regexp_matches(lower(t), '^https?://(dx\.)?doi\.org/')
             THEN 'https://doi.org/' || regexp_replace(t, '^https?://(dx\.)?doi\.org/', '', 'i')
        WHEN regexp_matches(t, '^10\.\d{4,9}/\S+$') THEN 'https://doi.org/' || t ELSE t END AS doi,
        t <> '' AND NOT starts_with(t, 'https://doi.org/') AS not_canonical
    FROM (SELECT doc_id, trim(raw_doi) AS t FROM fx_dois)"""))
def _(spark, d):
    return view(spark, d, "fx_dois").select(
        "doc_id", urls.canonical_doi("raw_doi").alias("doi"),
        (text.text_or_null("raw_doi").isNotNull()
         & ~text.clean_text("raw_doi").startswith("https://doi.org/")).alias("not_canonical"))


_VERSION = r"""CASE WHEN coalesce(trim({c}), '') = '' THEN '1.0'
    WHEN regexp_matches(ltrim(upper(trim({c})), 'V'), '^\d+\.\d+$') THEN ltrim(upper(trim({c})), 'V')
    WHEN len(regexp_extract_all({c}, '\d+')) = 0 THEN '1.0'
    WHEN len(regexp_extract_all({c}, '\d+')) = 1 THEN regexp_extract({c}, '\d+') || '.0'
    ELSE regexp_extract_all({c}, '\d+')[1] || '.' || regexp_extract_all({c}, '\d+')[2] END"""


def version_sql(column: str) -> str:
    return _VERSION.format(c=column)


@query("version_normalize", with_views("fx_versions", rf"""
    SELECT version_key, {version_sql('raw_version')} AS from_text,
           {version_sql('version')} AS from_label,
           'V' || {version_sql('download_version_folder')} AS folder,
           TRY_CAST(nullif(regexp_extract(raw_version, '\d+'), '') AS BIGINT) AS first_number,
           CAST(version_key % 4 AS VARCHAR) || CASE WHEN version_key % 3 = 0 THEN ''
               ELSE '.' || CAST(version_key % 3 AS VARCHAR) END AS numbered,
           CASE WHEN version_key % 5 = 4 THEN NULL ELSE 'RELEASED' END AS state
    FROM fx_versions"""))
def _(spark, d):
    minor = F.when(F.col("version_key") % 3 != 0, F.col("version_key") % 3)
    return spread(view(spark, d, "fx_versions"), "version_key").select(
        "version_key", codes.version_value("raw_version").alias("from_text"),
        codes.version_value("version").alias("from_label"),
        codes.version_folder("download_version_folder").alias("folder"),
        text.first_number("raw_version").alias("first_number"),
        codes.version_label(F.col("version_key") % 4, minor).alias("numbered"),
        codes.release_state("raw_date").alias("state"))


@query("dates_periods", with_views("fx_versions", """
    SELECT version_key,
           CASE version_key % 5 WHEN 3 THEN 'Spring 2024' WHEN 4 THEN '' ELSE '2024-03-09' END
               AS iso_date,
           CASE version_key % 3 WHEN 0 THEN '2001-03 -- 2005-12' WHEN 1 THEN '2001-03 -- 2005-01'
                ELSE '2001--2005' END AS period
    FROM fx_versions"""))
def _(spark, d):
    return spread(view(spark, d, "fx_versions"), "version_key").select(
        "version_key", codes.iso_date("raw_date").alias("iso_date"),
        codes.period("raw_period").alias("period"))


_EXT = ("CASE part_no % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'csv' WHEN 2 THEN 'docx' "
        "WHEN 3 THEN 'png' WHEN 4 THEN 'unknown' ELSE 'qdpx' END")


@query("file_codes", with_views("fx_files", f"""
    SELECT project_id, dataset_number, part_no, uri_no, extension,
           {case('extension', vocab.MIME_TYPES['icpsr'], "''")} AS mime_study,
           {case('extension', vocab.MIME_TYPES['openicpsr'], "''")} AS mime_open,
           {case('extension', vocab.MIME_TYPES['datalumos'], "''")} AS mime_folder,
           {case('extension', vocab.CATEGORY_BY_EXTENSION['openicpsr'], "'other'")} AS category_open,
           {case('extension', vocab.CATEGORY_BY_EXTENSION['datalumos'], "'other'")} AS category_folder,
           CASE public_flag WHEN 'yes' THEN true WHEN '0' THEN false END AS public,
           CASE WHEN raw_status IN ('SUCCEEDED', 'FAILED_LOGIN_REQUIRED') THEN raw_status
                ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS status,
           regexp_replace(file_name, '[.][^.]+$', '') AS stem
    FROM (SELECT *, {_EXT} AS extension FROM fx_files)"""))
def _(spark, d):
    e = F.col("extension")
    return (spread(view(spark, d, "fx_files"), *FILE_KEY).withColumn("extension", text.file_extension("file_name"))
            .select("project_id", "dataset_number", "part_no", "uri_no", "extension",
                    codes.mime_type(e, "icpsr").alias("mime_study"),
                    codes.mime_type(e, "openicpsr").alias("mime_open"),
                    codes.mime_type(e, "datalumos").alias("mime_folder"),
                    labels.file_category(F.lit(""), e, "openicpsr").alias("category_open"),
                    labels.file_category(F.lit(""), e, "datalumos").alias("category_folder"),
                    text.flag("public_flag").alias("public"),
                    codes.file_status("raw_status").alias("status"),
                    text.file_stem("file_name").alias("stem")))


@query("file_content_guess", with_views("fx_files", f"""
    SELECT project_id, dataset_number, part_no, uri_no,
           CASE WHEN uri_no % 9 = 1 THEN 'Codebook' WHEN uri_no % 9 = 2 THEN 'Setup'
                WHEN uri_no % 9 = 0 THEN 'Data' WHEN part_no % 6 = 1 THEN 'Data'
                WHEN part_no % 6 IN (0, 2) THEN 'Documentation' ELSE '' END AS open_content,
           CASE WHEN uri_no % 9 = 1 THEN 'Codebook' WHEN uri_no % 9 = 0 THEN 'Questionnaire'
                WHEN uri_no % 9 = 2 THEN 'Setup' WHEN part_no % 6 = 1 THEN 'Data'
                WHEN part_no % 6 = 0 THEN 'Documentation' ELSE 'Other' END AS folder_content
    FROM fx_files"""))
def _(spark, d):
    e = F.col("extension")
    return (spread(view(spark, d, "fx_files"), *FILE_KEY).withColumn("extension", text.file_extension("file_name"))
            .select("project_id", "dataset_number", "part_no", "uri_no",
                    labels.open_file_content("file_name", F.lit(""), F.lit(""), e)
                    .alias("open_content"),
                    labels.folder_file_content("file_name", "file_name", F.lit(""), F.lit(""), e)
                    .alias("folder_content")))


@query("menu_labels", with_views("fx_labels", r"""
    SELECT project_id, dataset_number, part_no, uri_no,
           CASE k WHEN 0 THEN 'Documentation' WHEN 3 THEN 'Readme' WHEN 5 THEN 'Table' ELSE raw END
               AS content_label,
           CASE k WHEN 0 THEN 'pdf' WHEN 1 THEN 'stata' WHEN 2 THEN 'sps' WHEN 3 THEN 'txt'
                  WHEN 4 THEN 'qda' WHEN 5 THEN 'xlsx' ELSE '' END AS file_extension,
           CASE k WHEN 0 THEN 'documentation' WHEN 1 THEN 'data' WHEN 2 THEN 'setup'
                  WHEN 3 THEN 'documentation' WHEN 4 THEN 'data' ELSE 'other' END AS file_category,
           CASE k WHEN 0 THEN 'Report_' || s || '.pdf' WHEN 1 THEN 'Stata.stata'
                  WHEN 2 THEN 'SPSS_Setup_' || CAST(uri_no % 3 AS VARCHAR) || '.sps'
                  WHEN 3 THEN 'notes_' || s || '.txt' WHEN 4 THEN 'Qualitative_Data.qda'
                  WHEN 5 THEN s || '.xlsx' WHEN 6 THEN 'usage_report' ELSE 'metadata' END AS file_name,
           CASE k WHEN 0 THEN 'Report_' || s || '.pdf' WHEN 1 THEN 'Stata'
                  WHEN 2 THEN 'SPSS_Setup_' || CAST(uri_no % 3 AS VARCHAR)
                  WHEN 3 THEN 'notes_' || s || '.txt' WHEN 4 THEN 'Qualitative_Data'
                  WHEN 5 THEN s || '.xlsx' WHEN 6 THEN 'usage_report' ELSE 'download.bin' END
               AS download_name
    FROM (SELECT *, part_no % 8 AS k, CAST(uri_no AS VARCHAR) AS s,
                 trim(regexp_replace(label, ' +', ' ', 'g')) AS raw FROM fx_labels)"""))
def _(spark, d):
    named = add_download_name(spread(view(spark, d, "fx_labels"), *FILE_KEY), "label", "download_name")
    return (add_resource_label(named, "label")
            .select("project_id", "dataset_number", "part_no", "uri_no", "content_label",
                    "file_extension", "file_category", "file_name", "download_name"))


@query("license_map", with_views("fx_licenses", """
    SELECT project_key, CASE project_key % 6 WHEN 0 THEN 'CC BY 4.0'
        WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/' WHEN 2 THEN 'CC BY-NC-ND 4.0'
        WHEN 3 THEN 'CC0 1.0' WHEN 4 THEN '' ELSE 'MIT License' END AS license
    FROM fx_licenses"""))
def _(spark, d):
    return view(spark, d, "fx_licenses").select(
        "project_key", codes.license_name("license").alias("license"))


@query("role_map", with_views("fx_people", """
    SELECT person_id,
           CASE WHEN upper(raw_role) = 'AUTHOR' THEN 'AUTHOR' ELSE 'UNKNOWN' END AS role,
           CASE person_id % 5 WHEN 0 THEN 'OTHER' WHEN 1 THEN 'OWNER' WHEN 2 THEN 'OTHER'
                WHEN 3 THEN 'UPLOADER' ELSE 'OTHER' END AS mapped,
           CASE person_id % 3
                WHEN 0 THEN 'Inter-university Consortium for Political and Social Research (ICPSR)'
                WHEN 1 THEN 'DataLumos' ELSE 'Some University' END AS organisation
    FROM fx_people"""))
def _(spark, d):
    raw = F.get(F.array(*map(F.lit, [" contact", "Owner", "PRODUCER", "uploader ", "contributor"])),
                (F.col("person_id") % 5).cast("int"))
    return view(spark, d, "fx_people").select(
        "person_id", codes.role_code("raw_role").alias("role"), codes.role_code(raw).alias("mapped"),
        codes.organisation("affiliation").alias("organisation"))


@query("http_status_map", with_views("fx_fetch_log", """
    SELECT fetch_id, CASE WHEN http_status = 200 AND size_bytes > 5368709120 THEN 'FAILED_TOO_LARGE'
        WHEN http_status = 200 THEN 'SUCCEEDED'
        WHEN http_status IN (401, 403) THEN 'FAILED_LOGIN_REQUIRED'
        WHEN http_status = 413 THEN 'FAILED_TOO_LARGE' ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS status,
        'ICPSR_' || CAST(project_id AS VARCHAR) || '-V2.0.zip' AS package_name,
        'downloads/icpsr/' || CAST(project_id AS VARCHAR) || '_icpsr/V2.0' AS output_path
    FROM fx_fetch_log"""))
def _(spark, d):
    kind, version = F.lit("icpsr"), F.lit("v2")
    return view(spark, d, "fx_fetch_log").select(
        "fetch_id", codes.http_status_code("http_status", "size_bytes").alias("status"),
        codes.package_name(kind, "project_id", version).alias("package_name"),
        codes.output_path("downloads/icpsr", kind, "project_id", version).alias("output_path"))


@query("project_keys", with_views("fx_projects", """
    SELECT project_id, CAST(CAST(repository_id AS VARCHAR) || CAST(project_id AS VARCHAR) AS BIGINT)
               AS api_key,
           CAST('15' || CASE page_type WHEN 'icpsr' THEN '1' WHEN 'openicpsr' THEN '2'
                WHEN 'datalumos' THEN '3' ELSE '9' END || CAST(project_id AS VARCHAR) AS BIGINT)
               AS page_key,
           CAST(project_id AS VARCHAR) || '_' || page_type AS folder
    FROM fx_projects"""))
def _(spark, d):
    return view(spark, d, "fx_projects").select(
        "project_id", codes.project_key("repository_id", "project_id").alias("api_key"),
        codes.project_key(F.lit(15), "project_id", "page_type").alias("page_key"),
        text.safe_folder(F.concat_ws("_", "project_id", "page_type")).alias("folder"))


@query("text_lists", f"""
    SELECT doc_id, array_to_string(parts, '|') AS parts, CAST(len(parts) AS BIGINT) AS n,
           joined
    FROM (SELECT doc_id, list_filter(p, lambda x, i: x <> '' AND list_position(p, x) = i) AS parts,
                 concat_ws(' ', nullif({cleaned('lang')}, ''), nullif({cleaned('source')}, ''))
                     AS joined
          FROM (SELECT doc_id, lang, source,
                       list_transform(string_split(text, '.'), lambda x: {cleaned('x')}) AS p
                FROM documents))""")
def _(spark, d):
    docs = spread(table(spark, d, "documents"), "doc_id")
    return (docs.withColumn("p", lists.clean_list(F.split("text", r"\.")))
            .select("doc_id", F.array_join("p", "|").alias("parts"),
                    F.size("p").cast("bigint").alias("n"),
                    lists.join_text("lang", "source").alias("joined")))


@query("semicolon_lists", with_views("fx_people", """
    SELECT person_id, trim(name) || '|ICPSR|Other' AS parts,
           CASE person_id % 3 WHEN 1 THEN
                'Inter-university Consortium for Political and Social Research (ICPSR)|DataLumos'
              WHEN 0 THEN 'Inter-university Consortium for Political and Social Research (ICPSR)'
              ELSE 'Inter-university Consortium for Political and Social Research (ICPSR)'
                   || '|Some University' END AS organisations,
           trim(name) || '; ' || affiliation AS joined
    FROM fx_people"""))
def _(spark, d):
    return view(spark, d, "fx_people").select(
        "person_id",
        F.array_join(lists.split_semicolons(F.array(
            F.concat("name", F.lit(" ;ICPSR; ;")), F.lit("Other ; ICPSR"))), "|").alias("parts"),
        F.array_join(lists.organisations(F.array(F.lit("icpsr"), F.col("affiliation"),
                                                 F.lit(" ICPSR "))), "|").alias("organisations"),
        lists.join_list(F.array("name", "affiliation", "name")).alias("joined"))


@query("citation_parts", with_views("fx_dois", """
    SELECT doc_id, 'https://doi.org/10.1/' || CAST(doc_id AS VARCHAR) AS doi,
           '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS published_date,
           CASE doc_id % 2 WHEN 0 THEN
               'Inter-university Consortium for Political and Social Research (ICPSR)'
             ELSE 'House ' || CAST(doc_id AS VARCHAR) END AS distributor,
           CAST(1900 + doc_id % 200 AS VARCHAR) AS year,
           'https://doi.org/10.1234/p' || CAST(doc_id AS VARCHAR) AS publication_doi
    FROM fx_dois"""))
def _(spark, d):
    n = F.col("doc_id").cast("string")
    house = F.when(F.col("doc_id") % 2 == 0, F.lit("ICPSR")).otherwise(F.concat(F.lit("House "), n))
    line = F.concat(F.lit("A, B. Study. Town, MI: "), house, F.lit(" [distributor], 2024-01-"),
                    F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"),
                    F.lit(". HTTPS://doi.org/10.1/"), n, F.lit(")."))
    paper = F.concat(F.lit("Paper ("), (F.lit(1900) + F.col("doc_id") % 200).cast("string"),
                     F.lit(") doi 10.1234/p"), n, F.lit("., next"))
    return (view(spark, d, "fx_dois")
            .withColumn("c", codes.citation_parts(line))
            .withColumn("p", codes.publication_parts(paper))
            .select("doc_id", "c.doi", "c.published_date", "c.distributor", "p.year",
                    F.col("p.doi").alias("publication_doi")))


# (link, what it resolves to on https://h.org/a/b/c/d/e/f?q=1#t), known by construction
LINKS = [
    ("x{k}", "/a/b/c/d/e/x{k}"), ("./x{k}", "/a/b/c/d/e/x{k}"), ("../x{k}", "/a/b/c/d/x{k}"),
    ("../../x{k}", "/a/b/c/x{k}"), ("../../../x{k}", "/a/b/x{k}"), ("../../../../x{k}", "/a/x{k}"),
    ("../../../../../x{k}", "/x{k}"), ("../../../../../../../../x{k}", "/x{k}"),
    ("..", "/a/b/c/d/"), (".", "/a/b/c/d/e/"), ("x{k}/../y/./z/..", "/a/b/c/d/e/y/"),
    ("/r{k}/../s/./t", "/s/t"), ("/../u{k}", "/u{k}"), ("x{k}?u=/p/../q", "/a/b/c/d/e/x{k}?u=/p/../q"),
    ("../x{k}#a/../b", "/a/b/c/d/x{k}#a/../b"), ("?n={k}/../m", "/a/b/c/d/e/f?n={k}/../m"),
    ("x{k}//y", "/a/b/c/d/e/x{k}/y"), ("p/q/r/s/t/u/v/w/../../../../../../../../x{k}", "/a/b/c/d/e/x{k}"),
]


def _link_sql(which: int) -> str:
    parts = [pair[which].replace("{k}", "' || CAST(c_custkey AS VARCHAR) || '") for pair in LINKS]
    return "[" + ", ".join(f"'{p}'" for p in parts) + "]"


@query("url_resolve", f"""
    SELECT c_custkey, link, 'https://h.org' || path AS resolved
    FROM (SELECT c_custkey, unnest({_link_sql(0)}) AS link,
                 unnest({_link_sql(1)}) AS path FROM customer)""")
def _(spark, d):
    key = F.col("c_custkey").cast("string")
    links = F.array(*[F.concat(*[x for i, part in enumerate(link.split("{k}"))
                                 for x in ([key] if i else []) + [F.lit(part)]])
                      for link, _ in LINKS])
    rows = table(spark, d, "customer").select("c_custkey", F.explode(links).alias("link"))
    return rows.withColumn("resolved", urls.resolve(
        F.lit("https://h.org/a/b/c/d/e/f?q=1#t"), "link"))


@query("markup_lists", r"""
    SELECT doc_id, len(list_distinct(items)) AS entries, array_to_string(items, '|') AS joined
    FROM (SELECT doc_id, list_filter([source || chr(57344) || ' & ' || lang, 'x ' || source, '<' || lang],
                                     lambda x: x <> '') AS items FROM documents)""")
def _(spark, d):
    entries = F.array(
        F.concat(F.lit("<b>"), F.col("source"), F.lit("\ue000 &amp; "), F.col("lang"), F.lit("</b>")),
        F.concat(F.lit("x<!-- y --> "), F.col("source")), F.lit(None).cast("string"),
        F.concat(F.lit("&lt;"), F.col("lang")), F.concat(F.lit("x "), F.col("source"), F.lit("<br/>")))
    made = table(spark, d, "documents").select("doc_id", lists.clean_markup_list(entries).alias("l"))
    return made.select("doc_id", F.size("l").cast("bigint").alias("entries"),
                       F.array_join("l", "|").alias("joined"))
