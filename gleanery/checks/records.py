"""Queries over unified records: resolution, normalising, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.checks import query
from gleanery.checks.documents import RUN
from gleanery.checks.pages import study_page
from gleanery.fixtures import table, view, with_views
from gleanery.operators import quality, record
from gleanery.plans import page_run
from gleanery.schemas import RECORD


def normalised(spark, d):
    return record.normalise_record(view(spark, d, "fx_records"))


_DOI = """CASE {c} % 5 WHEN 0 THEN 'https://doi.org/10.17026/x-' || CAST({c} AS VARCHAR)
    WHEN 1 THEN 'https://doi.org/10.3886/S' || CAST({c} AS VARCHAR)
    WHEN 2 THEN 'https://doi.org/10.1/' || CAST({c} AS VARCHAR)
    WHEN 3 THEN 'hdl:1/' || CAST({c} AS VARCHAR) ELSE '' END""".format(c="record_id")


NORMAL_SQL = f"""normal AS (
    SELECT record_id, trim(title) AS title, coalesce(study_id, '') AS study_id,
           nested_study_id, {_DOI} AS doi, CASE WHEN record_id % 10 = 1
               THEN 'https://doi.org/10.1/other' ELSE {_DOI} END AS nested_doi,
           published_date, nested_published_date, open_access, has_restricted_files,
           access_restricted_data_button, any_restricted_type, publications_count, publications_items
    FROM fx_records)"""


@query("normalize_records", with_views("fx_records", "").rstrip() + ",\n" + NORMAL_SQL + """
    SELECT record_id, title, study_id, nested_study_id, doi, nested_doi, published_date,
           nested_published_date FROM normal""")
def _(spark, d):
    return normalised(spark, d).select(
        "record_id", "title", "study_id", "nested_study_id", "doi", "nested_doi",
        "published_date", "nested_published_date")


def checked(spark, d):
    rules = (
        quality.identifier_rules("doi", "nested_doi", "nested_doi", "study_id", "nested_study_id")
        + quality.doi_rules("doi")
        + quality.access_rules("has_restricted_files", "any_restricted_type",
                               "access_restricted_data_button", "open_access")
        + quality.publication_rules("publications_count", "publications_items")
        + quality.date_rules("published_date", "nested_published_date"))
    return quality.validate(normalised(spark, d), {"study_id": "study_id", "title": "title"}, rules)


VIOLATION_SQL = NORMAL_SQL + """,
violations AS (
    SELECT record_id, 'error' AS level, 'Missing required field: study_id' AS message FROM normal WHERE study_id = ''
    UNION ALL SELECT record_id, 'error', 'Missing required field: title' FROM normal WHERE title = ''
    UNION ALL SELECT record_id, 'warning', 'Top-level doi and identifiers.doi differ after normalization.'
        FROM normal WHERE doi <> '' AND nested_doi <> '' AND doi <> nested_doi
    UNION ALL SELECT record_id, 'warning', 'Top-level doi and identifiers.doi_canonical differ after normalization.'
        FROM normal WHERE doi <> '' AND nested_doi <> '' AND doi <> nested_doi
    UNION ALL SELECT record_id, 'warning', 'Top-level study_id and identifiers.study_id differ.'
        FROM normal WHERE study_id <> '' AND nested_study_id <> study_id
    UNION ALL SELECT record_id, 'warning', 'DOI is present but is not in canonical https://doi.org/... form.'
        FROM normal WHERE doi <> '' AND NOT starts_with(doi, 'https://doi.org/')
    UNION ALL SELECT record_id, 'warning',
        'access.has_restricted_files is True but no restricted_data_types flag is True.'
        FROM normal WHERE has_restricted_files AND NOT any_restricted_type
    UNION ALL SELECT record_id, 'warning',
        'Restricted-data action button was detected while access.has_restricted_files is False.'
        FROM normal WHERE access_restricted_data_button AND NOT has_restricted_files
    UNION ALL SELECT record_id, 'warning', 'Record indicates both open access and restricted files.'
        FROM normal WHERE open_access AND has_restricted_files
    UNION ALL SELECT record_id, 'warning',
        'publications.count is smaller than the number of parsed publications.items.'
        FROM normal WHERE publications_count < publications_items
    UNION ALL SELECT record_id, 'warning', 'Top-level published_date and dates.published_date differ.'
        FROM normal WHERE published_date <> nested_published_date)"""


@query("record_violations", with_views("fx_records", "").rstrip() + ",\n" + VIOLATION_SQL + """
    SELECT * FROM violations""")
def _(spark, d):
    return quality.violations(checked(spark, d), "record_id")


@query("invalid_records", with_views("fx_records", "").rstrip() + ",\n" + NORMAL_SQL + f"""
    SELECT record_id AS project_key, 'Metadata record validation failed: ' || concat_ws('; ',
               CASE WHEN study_id = '' THEN 'Missing required field: study_id' END,
               CASE WHEN title = '' THEN 'Missing required field: title' END) AS reason,
           '{RUN}' AS timestamp
    FROM normal WHERE study_id = '' OR title = ''""")
def _(spark, d):
    return quality.split_valid(checked(spark, d), "record_id", RUN)[1]


def raw_records(spark, d):
    """Raw record documents with a wrong kind here and a missing key there."""
    n = F.col("doc_id")
    body = F.concat(
        F.lit('{"schema_version":"1.0.0","title":'),
        F.when(n % 2 == 0, F.lit('"T"')).otherwise(F.lit("7")),
        F.lit(',"authors":'), F.when(n % 3 == 0, F.lit('"one"')).otherwise(F.lit("[]")),
        F.lit(',"access":'), F.when(n % 5 == 0, F.lit("null")).otherwise(
            F.lit('{"license":null,"analyze_online":1,"open_access":"x"}')),
        F.lit(',"contributors":[{"name":"a"},"b"],"funding":'),
        F.when(n % 7 == 0, F.lit('"f"')).otherwise(F.lit("[3]")), F.lit("}"))
    return table(spark, d, "documents").select("doc_id", F.try_parse_json(body).alias("record"))


@query("shape_errors", """
    SELECT doc_id, 'title' AS path, 'expected str, got int' AS problem FROM documents WHERE doc_id % 2 = 1
    UNION ALL SELECT doc_id, 'authors', 'expected list, got str' FROM documents WHERE doc_id % 3 = 0
    UNION ALL SELECT doc_id, 'access', 'expected dict, got NoneType' FROM documents WHERE doc_id % 5 = 0
    UNION ALL SELECT doc_id, 'access.analyze_online', 'expected bool, got int' FROM documents
        WHERE doc_id % 5 <> 0
    UNION ALL SELECT doc_id, 'funding', 'expected list, got str' FROM documents WHERE doc_id % 7 = 0""")
def _(spark, d):
    found = quality.shape_mismatches(raw_records(spark, d), "doc_id", "record")
    return found.filter("level = 'error'").select("doc_id", "path", "problem")


def _missing_sql() -> str:
    """Paths a raw record lacks: all declared ones of its objects but those it has."""
    top = {"schema_version", "title", "authors", "access", "contributors", "funding"}
    paths = [n for names in RECORD[""].values() for n in names if n not in top]
    inner = [f"access.{n}" for names in RECORD["access"].values() for n in names
             if n not in ("license", "analyze_online", "open_access")]
    quoted = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return (f"SELECT doc_id, unnest({quoted(paths)}) AS path, 'missing key' AS problem FROM documents "
            f"UNION ALL SELECT doc_id, unnest({quoted(inner)}), 'missing key' FROM documents "
            "WHERE doc_id % 5 <> 0")


@query("shape_missing", _missing_sql())
def _(spark, d):
    found = quality.shape_mismatches(raw_records(spark, d), "doc_id", "record")
    return found.filter("level = 'warning'").select("doc_id", "path", "problem")


@query("entry_shapes", """
    SELECT doc_id, unnest(['Field ''contributors[1]'' must be a dict.', CASE WHEN doc_id % 7 = 0
        THEN 'Field ''funding'' must be a list.' ELSE 'Field ''funding[0]'' must be a dict.' END]) AS message
    FROM documents""")
def _(spark, d):
    return quality.entry_shapes(raw_records(spark, d), "doc_id", "record")


def study_facts(spark, d):
    """Facts of the study pages written from the customer table."""
    routed = study_page(spark, d).select(
        F.concat(F.lit(vocab.STUDY_URL), F.col("page_id").cast("string")).alias("url"),
        F.lit(0).alias("page_ord"), "html")
    routed = page_run.route(routed)
    return routed, page_run.page_facts(routed, "icpsr")


@query("study_records", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS study_id, c_name AS title, 'V' || CAST(c_custkey % 4 AS VARCHAR)
               AS version, 'https://doi.org/10.3886/S' || CAST(c_custkey AS VARCHAR) AS doi,
           'bare ' || CAST(c_custkey AS VARCHAR) AS abstract, '2024-01-01' AS published_date,
           'ICPSR' AS publisher, 'All' AS universe,
           '{vocab.STUDY_URL}' || CAST(c_custkey AS VARCHAR) || '/terms' AS license,
           'Study ' || CAST(c_custkey AS VARCHAR) AS page_title FROM customer""")
def _(spark, d):
    _, facts = study_facts(spark, d)
    return record.resolve_scalars(facts, "icpsr").select(
        "study_id", "title", "version", "doi", "abstract", "published_date", "publisher",
        "universe", "license", "page_title")


@query("study_lists", """
    SELECT CAST(c_custkey AS VARCHAR) AS study_id, field, value FROM customer, LATERAL (
        SELECT unnest(['authors', 'authors', 'author_affiliations', 'author_affiliations', 'keywords',
                       'keywords']) AS field,
               unnest([c_name, 'Second', 'U1', 'U2', 'a', 'b']) AS value)""")
def _(spark, d):
    _, facts = study_facts(spark, d)
    return record.resolve_lists(facts, "icpsr").select("study_id", "field", "value")


@query("study_projects", f"""
    SELECT CAST('151' || CAST(c_custkey AS VARCHAR) AS BIGINT) AS project_key, c_custkey AS project_id,
           c_name AS title, 'bare ' || CAST(c_custkey AS VARCHAR) AS description, '' AS language,
           'https://doi.org/10.3886/S' || CAST(c_custkey AS VARCHAR) AS doi, '2024-01-01' AS upload_date,
           CAST(c_custkey AS VARCHAR) || '_icpsr' AS download_project_folder,
           '{vocab.STUDY_URL}' || CAST(c_custkey AS VARCHAR) AS project_url FROM customer""")
def _(spark, d):
    routed, facts = study_facts(spark, d)
    records, _ = page_run.study_records(routed, facts, "icpsr", RUN)
    rows = page_run.project_rows(page_run.checked_records(records), 15, "https://r", "studies", RUN, "*")
    return rows.select("project_key", "project_id", "title", "description", "language", "doi",
                       "upload_date", "download_project_folder", "project_url")


@query("unsupported_pages", f"""
    SELECT CAST(NULL AS BIGINT) AS project_key,
           'Unsupported study URL for metadata extraction: ' || url AS reason, '{RUN}' AS timestamp
    FROM pages""")
def _(spark, d):
    return page_run.unsupported(page_run.route(table(spark, d, "pages")), RUN)


@query("funding_merge", """
    SELECT CAST(c_custkey AS VARCHAR) AS study_id, funder_name, identifier, display, url FROM customer,
        LATERAL (SELECT unnest(['F1', 'F2']) AS funder_name,
                        unnest([CAST(c_custkey AS VARCHAR), '']) AS identifier,
                        unnest(['Inline', '']) AS display, unnest(['u', '']) AS url)""")
def _(spark, d):
    k = F.col("c_custkey").cast("string").alias("study_id")
    who = table(spark, d, "customer")
    listed = who.select(k, F.lit(0).alias("place"), F.lit(" F1 ").alias("funder_name"),
                        F.col("c_custkey").cast("string").alias("identifier"),
                        F.lit("D").alias("display"), F.lit("u").alias("url"))
    rows = F.explode(F.array(
        F.struct(F.lit("F1").alias("f"), F.col("c_custkey").cast("string").alias("i"),
                 F.lit("Inline").alias("t")),
        F.struct(F.lit("F2").alias("f"), F.lit("").alias("i"), F.lit("").alias("t"))))
    inline = who.select(k, rows.alias("r")).select(
        "study_id", F.lit(0).alias("place"), F.col("r.f").alias("funder_name"),
        F.col("r.i").alias("identifier"), F.col("r.t").alias("display"))
    return record.merge_funding(listed, inline).drop("grant_number")


@query("record_documents", with_views("fx_records", "").rstrip() + ",\n" + NORMAL_SQL + """
    SELECT record_id, coalesce(nullif(trim(regexp_replace(regexp_replace(
               coalesce(nullif(doi, ''), nullif(study_id, ''), nullif(title, ''), 'metadata'),
               '^https?://', ''), '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'metadata') AS file_stem
    FROM normal""")
def _(spark, d):
    from gleanery.sources.sinks import record_documents

    rows = normalised(spark, d).withColumn("page_type", F.lit("icpsr"))
    return record_documents(rows).select(
        F.get_json_object("document", "$.record_id").cast("bigint").alias("record_id"), "file_stem")


@query("completeness", with_views("fx_records", """
    SELECT record_id, concat_ws('|', CASE WHEN record_id % 3 = 0 THEN 'No authors were extracted.' END,
        CASE WHEN record_id % 2 = 0 THEN
        'No page-visible file rows were extracted from the Data & Documentation page.' END) AS warnings
    FROM fx_records"""))
def _(spark, d):
    rows = view(spark, d, "fx_records").select(
        "record_id", (F.col("record_id") % 3).alias("author_count"), F.lit("P").alias("publisher"),
        (F.col("record_id") % 2).alias("file_count"))
    return rows.select("record_id", F.array_join(
        record.completeness_warnings("icpsr"), "|").alias("warnings"))


@query("access_texts", with_views("fx_licenses", """
    SELECT project_key, coalesce(nullif(trim(license), ''), 'https://t') AS license,
           'https://t' AS license_url, 'https://t' AS terms_url FROM fx_licenses"""))
def _(spark, d):
    rows = view(spark, d, "fx_licenses").withColumn("license_url", F.lit(" ")).withColumn(
        "terms_url", F.lit("https://t"))
    return record.access_texts(rows)
