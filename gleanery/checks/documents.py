"""Queries over landed JSON; the JSON is written from the tables by Spark itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.checks import query
from gleanery.fixtures import spread, table, view, with_views
from gleanery.operators import documents

RUN = "2026-01-01T00:00:00+00:00"


def search_responses(spark, d):
    """One landed response per term and page."""
    hits = view(spark, d, "fx_hits")
    item = F.when(F.col("pos") % 17 == 3, F.lit(None).cast("string")).otherwise(F.col("global_id"))
    return hits.select(
        "event_id", "term", "term_ord", "start_pos",
        F.to_json(F.struct(F.struct(
            F.array(F.struct(item.alias("global_id")), F.struct(F.lit("").alias("global_id")))
            .alias("items"), F.col("term_ord").alias("total_count")).alias("data"))).alias("body"))


@query("landed_hits", with_views("fx_hits", """
    SELECT event_id, term, term_ord, start_pos, term_ord AS total_count, CAST(0 AS BIGINT) AS pos,
           global_id FROM fx_hits WHERE pos % 17 <> 3"""))
def _(spark, d):
    return documents.search_hits(search_responses(spark, d), "body")


def _compound(type_name, key, *values):
    items = F.array(*[F.struct(F.struct(F.lit(key).alias("typeName"), v.alias("value")).alias(key))
                      for v in values])
    return F.concat(F.lit(f'{{"typeName":"{type_name}","value":'), F.to_json(items), F.lit("}"))


def dataset_documents(spark, d):
    """One dataset document per table document, with every shape a value can have."""
    docs = spread(table(spark, d, "documents"), "doc_id")
    n = F.col("doc_id").cast("string")
    fields = [
        F.concat(F.lit('{"typeName":"title","value":"Title '), n, F.lit(' "}')),
        F.lit('{"typeName":"title","value":"second"}'),
        _compound("dsDescription", "dsDescriptionValue", F.col("text"), F.lit("tail")),
        _compound("author", "authorName", F.concat(F.lit(" B "), n), F.lit("A"), F.lit("A")),
        _compound("datasetContact", "datasetContactName", F.lit("Contact")),
        _compound("producer", "producerName", F.lit("")),
        _compound("keyword", "keywordValue", F.lit("zeta"), F.col("lang"), F.col("lang")),
        F.concat(F.lit('{"typeName":"language","value":["'), "lang", F.lit('"," en "]}')),
    ]
    blank = F.lit('{"typeName":"contributor","value":"not a list"}')
    body = F.concat(
        F.lit('{"status":"OK","data":{"id":'), n, F.lit(',"identifier":"FK2/A '), n,
        F.lit('","persistentUrl":"https://doi.org/10.1/'), n,
        F.lit('","publicationDate":"2020-01-01","latestVersion":{"publicationDate":"'),
        F.when(F.col("doc_id") % 2 == 0, F.lit("2021-02-03")).otherwise(F.lit("")),
        F.lit('","license":{"name":" CC0 1.0 "},"metadataBlocks":{"citation":{"fields":['),
        F.concat_ws(",", *fields, blank), F.lit("]}}}}}"))
    whole = F.when(F.col("doc_id") % 50 == 49, F.lit("<html>busy</html>")).otherwise(body)
    return docs.select(F.concat(F.lit("doi:10.1/"), n).alias("global_id"),
                       F.lit("interview").alias("term"), whole.alias("body"))


def parsed_projects(spark, d):
    return documents.project_rows(
        dataset_documents(spark, d), "body", "term", 5, "https://repository.example.org",
        "repository", "API-CALL", RUN)


@query("dataset_projects", f"""
    SELECT CAST('5' || CAST(doc_id AS VARCHAR) AS BIGINT) AS project_key, doc_id AS project_id,
           'interview' AS query_string, 'https://doi.org/10.1/' || CAST(doc_id AS VARCHAR) AS project_url,
           'Title ' || CAST(doc_id AS VARCHAR) AS title,
           md5(trim(text, ' ') || ' tail') AS description_digest, lang || ' en' AS language,
           CASE WHEN doc_id % 2 = 0 THEN '2021-02-03' ELSE '2020-01-01' END AS upload_date,
           'fk2-a-' || CAST(doc_id AS VARCHAR) AS download_project_folder,
           CASE WHEN lang < 'zeta' THEN lang || '|zeta' ELSE 'zeta|' || lang END AS keywords,
           'B ' || CAST(doc_id AS VARCHAR) || '|A|A' AS authors, 'Contact' AS contacts,
           '' AS producers, '' AS contributors, 'CC0 1.0' AS license, '{RUN}' AS download_date
    FROM documents WHERE doc_id % 50 <> 49""")
def _(spark, d):
    rows = parsed_projects(spark, d).filter("project_key IS NOT NULL")
    lists = ["keywords", "authors", "contacts", "producers", "contributors"]
    return rows.select(
        "project_key", "project_id", "query_string", "project_url", "title",
        F.md5("description").alias("description_digest"), "language", "upload_date",
        "download_project_folder", *[F.array_join(c, "|").alias(c) for c in lists], "license",
        "download_date")


@query("failed_documents", f"""
    SELECT CAST(NULL AS BIGINT) AS project_key,
           'No dataset document for doi:10.1/' || CAST(doc_id AS VARCHAR) AS reason,
           '{RUN}' AS timestamp
    FROM documents WHERE doc_id % 50 = 49""")
def _(spark, d):
    return documents.failed_documents(parsed_projects(spark, d), RUN)


def version_lists(spark, d):
    """One version list per order: up to three versions, the last one without a number."""
    orders = spread(table(spark, d, "orders"), "o_orderkey")
    k = F.col("o_orderkey")

    def version(major, minor, files):
        return F.struct(
            (k * 10 + (major if major is not None else 9)).alias("id"),
            (F.lit(major) if major is not None else F.lit(None)).cast("bigint")
            .alias("versionNumber"),
            F.when(k % 3 != 0, F.lit(minor)).cast("bigint").alias("versionMinorNumber"),
            F.col("o_orderpriority").alias("versionState"),
            F.lit("2024-05-06").alias("publicationDate"), files.alias("files"))

    def file(i, name, label):
        return F.struct(F.lit(label).alias("label"), (k % 2 == 0).alias("restricted"), F.struct(
            (k * 100 + i).alias("id"), name.alias("filename"),
            F.lit("text/plain").alias("contentType")).alias("dataFile"))

    files = F.array(file(1, F.concat(F.lit("Interview "), k.cast("string"), F.lit(".TXT")), "x"),
                    file(2, F.lit(""), "notes.md"))
    body = F.to_json(F.struct(F.array(
        version(1, 0, files), version(2, 5, F.slice(files, 1, 0)), version(None, 1, files))
        .alias("data")))
    return orders.select(k.alias("project_key"), body.alias("body"))


@query("dataset_versions", f"""
    SELECT o_orderkey AS project_key, version_no, o_orderkey * 10 + version_no + 1 AS version_id,
           CASE version_no WHEN 0 THEN '1' ELSE '2' END || CASE WHEN o_orderkey % 3 = 0 THEN ''
               WHEN version_no = 0 THEN '.0' ELSE '.5' END AS version,
           o_orderpriority AS version_state, '2024-05-06' AS publication_date, '' AS release_time,
           '{RUN}' AS download_date,
           'v' || CASE version_no WHEN 0 THEN '1' ELSE '2' END || CASE WHEN o_orderkey % 3 = 0 THEN ''
               WHEN version_no = 0 THEN '.0' ELSE '.5' END AS download_version_folder
    FROM orders, (SELECT CAST(unnest([0, 1]) AS BIGINT) AS version_no)""")
def _(spark, d):
    return documents.version_rows(version_lists(spark, d), "body", "project_key", RUN).drop("files")


@query("dataset_files", """
    SELECT o_orderkey AS project_key, CAST(0 AS BIGINT) AS version_no, idx,
           o_orderkey * 100 + idx AS file_id,
           CASE idx WHEN 1 THEN 'Interview ' || CAST(o_orderkey AS VARCHAR) || '.TXT' ELSE 'notes.md' END
               AS file_name,
           CASE idx WHEN 1 THEN 'txt' ELSE 'md' END AS file_type, o_orderkey % 2 = 0 AS restricted,
           'text/plain' AS content_type, false AS file_access_request
    FROM orders, (SELECT CAST(unnest([1, 2]) AS BIGINT) AS idx)""")
def _(spark, d):
    rows = documents.version_rows(version_lists(spark, d), "body", "project_key", RUN)
    return documents.file_rows(rows, "project_key")
