"""Queries over the stored tables: migration, refresh, incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.checks import query
from gleanery.checks.documents import (
    RUN, dataset_documents, search_responses, version_lists,
)
from gleanery.checks.relational import _HITS, dictionary
from gleanery.fixtures import view, with_views
from gleanery.functions import codes
from gleanery.operators import refresh
from gleanery.plans import api_run, migrate
from gleanery.schemas import TABLES, empty_tables
from gleanery.session import cut_lineage, work_folder
from gleanery.streaming import ingest


def catalogue(spark, d):
    """A stored catalogue over the fixture views, typed as the stored tables."""
    projects = view(spark, d, "fx_projects").select(
        F.col("project_id").alias("project_key"), "project_id",
        F.lit("interview").alias("query_string"), F.col("repository_id").cast("bigint"),
        F.col("repository").alias("repository_url"), F.col("page_type").alias("project_url"),
        F.concat(F.lit("T"), F.col("project_id").cast("string")).alias("title"),
        F.md5("description").alias("description"), "language", F.lit("").alias("doi"),
        F.lit("2024-01-01").alias("upload_date"), F.lit(RUN).alias("download_date"),
        F.lit("repository").alias("download_repository_folder"),
        F.concat(F.lit("p-"), (F.col("project_id") % 50).cast("string"))
        .alias("download_project_folder"), F.lit("API-CALL").alias("download_method"))
    versions = view(spark, d, "fx_versions").select(
        "version_key", "project_key", F.lit(1).cast("bigint").alias("version_id"), "version",
        F.lit("RELEASED").alias("version_state"), F.col("raw_date").alias("publication_date"),
        F.lit("").alias("release_time"), "download_date", "download_version_folder")
    files = view(spark, d, "fx_files").select(
        F.col("uri_no").alias("id"), F.col("project_id").alias("project_key"),
        F.col("dataset_number").alias("version_key"), "file_name",
        F.col("file_category").alias("file_type"), codes.file_status("raw_status").alias("status"))
    people = view(spark, d, "fx_people").select(
        F.col("person_id").alias("id"), "project_key", F.trim("name").alias("name"),
        F.upper(F.col("raw_role")).alias("role"))
    licenses = view(spark, d, "fx_licenses").select(
        F.col("project_key").alias("id"), "project_key", "license")
    keywords = view(spark, d, "fx_projects").select(
        F.col("project_id").alias("id"), F.col("project_id").alias("project_key"),
        F.col("language").alias("keyword"))
    return {"projects": projects, "project_versions": versions, "files": files,
            "keywords": keywords, "person_role": people, "licenses": licenses}


@query("repair_projects", with_views("fx_projects fx_versions", f"""
    SELECT project_id AS id, 'interview' AS query_string, CAST(repository_id AS BIGINT) AS repository_id,
           repository AS repository_url, page_type AS project_url, v.version,
           'T' || CAST(project_id AS VARCHAR) AS title, md5(description) AS description, language,
           '' AS doi, '2024-01-01' AS upload_date, '{RUN}' AS download_date,
           'repository' AS download_repository_folder,
           'p-' || CAST(project_id % 50 AS VARCHAR) AS download_project_folder,
           v.download_version_folder, 'API-CALL' AS download_method
    FROM fx_projects LEFT JOIN (
        SELECT project_key, first(version ORDER BY download_date DESC, version_key DESC)
                   FILTER (version <> '') AS version,
               first(download_version_folder ORDER BY download_date DESC, version_key DESC)
                   FILTER (download_version_folder <> '') AS download_version_folder
        FROM fx_versions GROUP BY project_key) v ON v.project_key = project_id"""))
def _(spark, d):
    return migrate.migrate(catalogue(spark, d))["projects"]


@query("repair_files", with_views("fx_files", """
    SELECT uri_no AS id, project_id, file_name, file_category AS file_type,
           CASE WHEN raw_status = 'TIMEOUT' THEN 'FAILED_SERVER_UNRESPONSIVE' ELSE raw_status END AS status
    FROM fx_files"""))
def _(spark, d):
    return migrate.migrate(catalogue(spark, d))["files"]


@query("repair_keywords", with_views("fx_projects", """
    SELECT project_id AS id, project_id, language AS keyword FROM fx_projects"""))
def _(spark, d):
    return migrate.migrate(catalogue(spark, d))["keywords"]


@query("repair_person_role", with_views("fx_people", """
    SELECT person_id AS id, project_key AS project_id, trim(name) AS name,
           CASE WHEN raw_role = 'author' THEN 'AUTHOR' ELSE 'UNKNOWN' END AS role FROM fx_people"""))
def _(spark, d):
    return migrate.migrate(catalogue(spark, d))["person_role"]


@query("repair_licenses", with_views("fx_licenses", """
    SELECT project_key AS id, project_key AS project_id, CASE project_key % 6 WHEN 0 THEN 'CC BY 4.0'
        WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/' WHEN 2 THEN 'CC BY-NC-ND 4.0'
        WHEN 3 THEN 'CC0 1.0' WHEN 4 THEN '' ELSE 'MIT License' END AS license FROM fx_licenses"""))
def _(spark, d):
    return migrate.migrate(catalogue(spark, d))["licenses"]


def batch(spark, d):
    """A run that has seen the even projects and keeps those divisible by four."""
    stored = catalogue(spark, d)["projects"].filter("project_key % 3 <> 0")
    seen = catalogue(spark, d)["projects"].filter("project_key % 2 = 0").select("project_key")
    new = (catalogue(spark, d)["projects"].filter("project_key % 4 = 0")
           .withColumn("title", F.lit("new")).withColumn("download_project_folder", F.lit("p-0")))
    return stored, seen, new


_REFRESHED = """
    SELECT project_id AS project_key, CASE WHEN project_id % 4 = 0 THEN 'new'
               ELSE 'T' || CAST(project_id AS VARCHAR) END AS title, language
    FROM fx_projects
    WHERE project_id % 4 = 0 OR (project_id % 2 = 1 AND project_id % 3 <> 0)"""


@query("refresh_upsert", with_views("fx_projects", _REFRESHED))
def _(spark, d):
    stored, seen, new = batch(spark, d)
    return refresh.refresh(stored, seen, new).select("project_key", "title", "language")


@query("refresh_stored", with_views("fx_projects", _REFRESHED))
def _(spark, d):
    """The same refresh on a stored table, applied twice."""
    stored, seen, new = batch(spark, d)
    path, schema = work_folder(spark, "table"), TABLES["projects"]
    refresh.create_table(stored.select(*schema.names), path, 8)
    for _ in range(2):
        refresh.refresh_path(spark, path, schema, seen, new, 8)
    return refresh.read_table(spark, path, schema).select("project_key", "title", "language")


@query("refresh_children", with_views("fx_people", """
    SELECT project_key, name FROM (SELECT project_key, trim(name) AS name FROM fx_people)
    WHERE project_key % 2 = 1"""))
def _(spark, d):
    stored = catalogue(spark, d)
    seen = stored["projects"].filter("project_key % 2 = 0").select("project_key")
    return refresh.refresh_tables({"person_role": stored["person_role"]}, seen, {})[
        "person_role"].select("project_key", "name")


@query("stale_paths", with_views("fx_projects", """
    SELECT DISTINCT project_key, path FROM (
        SELECT project_id AS project_key, 'downloads/p-0' AS path FROM fx_projects WHERE project_id % 4 = 0
        UNION ALL
        SELECT project_id, 'downloads/p-' || CAST(project_id % 50 AS VARCHAR) FROM fx_projects
        WHERE project_id % 4 = 0 AND project_id % 3 <> 0)"""))
def _(spark, d):
    stored, _, new = batch(spark, d)
    return refresh.stale_paths(new, stored, "downloads")


@query("existing_folder", with_views("fx_projects", """
    SELECT project_id AS project_key, CASE WHEN project_id % 3 <> 0
               THEN 'p-' || CAST(project_id % 50 AS VARCHAR) END AS existing_folder
    FROM fx_projects WHERE project_id % 4 = 0"""))
def _(spark, d):
    stored, _, new = batch(spark, d)
    return refresh.with_existing_folder(new, stored).select("project_key", "existing_folder")


HIT = T.StructType([T.StructField(n, T.LongType()) for n in (
    "project_key", "term_ord", "start_pos", "pos", "event_id")])


@query("stream_ingest", with_views("fx_hits", """
    SELECT CAST(regexp_extract(global_id, '(\\d+)$', 1) AS BIGINT) AS project_key, term_ord, start_pos,
           pos, event_id
    FROM fx_hits
    QUALIFY row_number() OVER (PARTITION BY global_id ORDER BY term_ord, start_pos, pos) = 1"""
                                      .replace("\\\\", "\\")))
def _(spark, d):
    """Hits land as several files; the stream ends with the same first hits as the batch."""
    hits = view(spark, d, "fx_hits").select(
        F.regexp_extract("global_id", r"(\d+)$", 1).cast("bigint").alias("project_key"),
        "term_ord", "start_pos", "pos", "event_id")
    landing, path, compacted = (work_folder(spark, x) for x in ("landing", "hits", "compacted"))
    # later terms land first, so a stored first hit has to give way to an earlier term
    hits.repartitionByRange(3, F.desc("term_ord")).write.parquet(landing)
    source = ingest.landed(spark, landing, HIT, "*.parquet", files=1)
    ingest.run_available(
        spark, source, lambda df, number: ingest.append_first_hits(path, HIT, df, number),
        work_folder(spark, "progress"))
    ingest.compact(spark, path, compacted, HIT)
    return ingest.read_first_hits(spark, compacted, HIT)


@query("merged_ingest", with_views("fx_hits", """
    SELECT CAST(regexp_extract(global_id, '(\\d+)$', 1) AS BIGINT) AS project_key, term_ord, start_pos,
           pos, event_id
    FROM fx_hits
    QUALIFY row_number() OVER (PARTITION BY global_id ORDER BY term_ord, start_pos, pos) = 1"""
                                      .replace("\\\\", "\\")))
def _(spark, d):
    """The same hits in two batches, each merged into the stored table."""
    hits = view(spark, d, "fx_hits").select(
        F.regexp_extract("global_id", r"(\d+)$", 1).cast("bigint").alias("project_key"),
        "term_ord", "start_pos", "pos", "event_id")
    path = work_folder(spark, "hits")
    refresh.create_table(spark.createDataFrame([], HIT), path, 8)
    for part in ("term_ord > 2", "term_ord <= 2"):
        ingest.merge_first_hits(spark, path, HIT, hits.filter(part), 8)
    return refresh.read_table(spark, path, HIT)


def evaluated(spark, d, part: str = "true", missing: str = "false"):
    """The whole JSON run up to the decision, on documents written from the tables.

    `part` picks the hits of the run, `missing` those whose document never landed.
    """
    config = api_run.ApiConfig(dictionary(spark, d), repository_url="https://repository.example.org",
                               run_time=RUN)
    datasets = cut_lineage(dataset_documents(spark, d).select("global_id", "body"), "datasets")
    number = F.substring_index("global_id", "/", -1).cast("bigint")
    datasets = datasets.withColumn("number", number).filter(part)
    hits = datasets.select("global_id", F.lit("interview").alias("term"))
    lists = version_lists(spark, d).withColumn(
        "project_key", F.concat(F.lit("5"), F.col("project_key").cast("string")).cast("bigint"))
    landed = datasets.filter(f"NOT ({missing})").select("global_id", "body")
    return api_run.evaluate(hits, landed, lists, config)


_API = """
    SELECT doc_id, CAST('5' || CAST(doc_id AS VARCHAR) AS BIGINT) AS project_key,
           doc_id IN (SELECT o_orderkey FROM orders) AS has_files, lower(text) AS low
    FROM documents WHERE doc_id % 50 <> 49"""


@query("api_first_hits", with_views("fx_hits", """
    SELECT global_id, term, start_pos, event_id FROM fx_hits WHERE pos % 17 <> 3
    QUALIFY row_number() OVER (PARTITION BY global_id ORDER BY term_ord, start_pos, event_id) = 1"""))
def _(spark, d):
    responses = search_responses(spark, d)
    hits = api_run.documents.search_hits(responses, "body")
    # each page of the fixture holds many responses; the event tells them apart
    return api_run.dedupe.first_wins(hits, ["global_id"], ["term_ord", "start_pos", "event_id"]).select(
        "global_id", "term", "start_pos", "event_id")


def _terms_sql():
    return f"len({_HITS}) > 0"


@query("api_projects", f"""
    SELECT project_key, {_terms_sql()} AS description_signal, has_files,
           {_terms_sql()} AND has_files AS qualitative FROM ({_API})""")
def _(spark, d):
    return evaluated(spark, d)["projects"].select(
        "project_key", "description_signal", "has_files", "qualitative")


@query("api_saved_files", f"""
    SELECT project_key, file_name, file_type,
           CASE WHEN idx = 1 THEN 'SUCCEEDED' ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS status
    FROM (SELECT project_key, idx, CASE idx WHEN 1 THEN 'Interview ' || CAST(doc_id AS VARCHAR) || '.TXT'
                 ELSE 'notes.md' END AS file_name, CASE idx WHEN 1 THEN 'txt' ELSE 'md' END AS file_type
          FROM ({_API}), (SELECT unnest([1, 2]) AS idx) WHERE has_files AND {_terms_sql()})""")
def _(spark, d):
    run = evaluated(spark, d)
    tried = F.explode(F.array(*[F.struct(F.lit(i).alias("attempt"), F.lit(s).alias("http_status"))
                                for i, s in enumerate((503, 401, 200))])).alias("t")
    log = run["files"].filter("idx = 1").select("file_id", tried).select("file_id", "t.*")
    _, new = api_run.catalogue(run, log)
    return new["files"].select("project_key", "file_name", "file_type", "status")


@query("api_saved_people", f"""
    SELECT project_key, name, role FROM (SELECT * FROM ({_API}) WHERE has_files AND {_terms_sql()}),
        LATERAL (SELECT unnest(['B ' || CAST(doc_id AS VARCHAR), 'A', 'Contact']) AS name,
                        unnest(['AUTHOR', 'AUTHOR', 'CONTACT']) AS role)""")
def _(spark, d):
    run = evaluated(spark, d)
    log = run["files"].select("file_id", F.lit(200).alias("http_status"))
    return api_run.catalogue(run, log)[1]["person_role"].select("project_key", "name", "role")


@query("api_summary", f"""
    SELECT count(*) AS total_projects, count(*) FILTER (has_files) AS projects_with_files,
           count(*) FILTER (NOT has_files) AS projects_with_no_files,
           count(*) FILTER (q AND has_files) AS identified_qualitative_projects,
           count(*) FILTER (q AND has_files) AS identified_qualitative_with_files,
           CAST(0 AS BIGINT) AS identified_qualitative_with_no_files,
           count(*) FILTER (NOT (q AND has_files)) AS identified_non_qualitative_projects,
           count(*) FILTER (NOT q AND has_files) AS identified_non_qualitative_with_files,
           count(*) FILTER (NOT has_files) AS identified_non_qualitative_with_no_files
    FROM (SELECT has_files, {_terms_sql()} AS q FROM ({_API}))""")
def _(spark, d):
    return api_run.run_summary(evaluated(spark, d))[0]


@query("landed_failures", f"""
    SELECT 'No dataset document for doi:10.1/' || CAST(doc_id AS VARCHAR) AS reason,
           '{RUN}' AS timestamp
    FROM documents WHERE doc_id % 50 IN (48, 49)""")
def _(spark, d):
    """Hits whose document never landed (48) and documents that are no dataset (49)."""
    failures = evaluated(spark, d, missing="number % 50 = 48")["failures"]
    return failures.select("reason", "timestamp")


def two_runs(spark, d):
    """The stored tables after two runs over different projects, the second a refresh."""
    stored = empty_tables(spark)
    for part in ("number % 2 = 0", "number % 2 = 1"):
        run = evaluated(spark, d, part)
        log = run["files"].select("file_id", F.lit(200).alias("http_status"))
        seen, new = api_run.catalogue(run, log, api_run.last_ids(stored))
        new = {name: cut_lineage(df, name) for name, df in new.items()}
        stored = refresh.refresh_tables(stored, seen, new)
    return stored


@query("two_run_ids", f"""
    WITH kept AS (SELECT project_key FROM ({_API}) WHERE has_files AND {_terms_sql()}),
    people AS (SELECT project_key, unnest(['AUTHOR', 'AUTHOR', 'CONTACT']) AS role FROM kept)
    SELECT 'files' AS stored, count(*) * 2 AS n, count(*) * 2 AS ids FROM kept
    UNION ALL SELECT 'person_role', count(*), count(*) FROM people
    UNION ALL SELECT 'licenses', count(*), count(*) FROM kept""")
def _(spark, d):
    """Ids are unique over both runs."""
    stored = two_runs(spark, d)
    counts = [stored[n].agg(F.lit(n).alias("stored"), F.count("id").alias("n"),
                            F.count_distinct("id").alias("ids"))
              for n in ("files", "person_role", "licenses")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("two_run_files", f"""
    SELECT project_key, file_name, project_key AS version_project
    FROM (SELECT project_key, CASE idx WHEN 1 THEN 'Interview ' || CAST(doc_id AS VARCHAR) || '.TXT'
                 ELSE 'notes.md' END AS file_name
          FROM ({_API}), (SELECT unnest([1, 2]) AS idx) WHERE has_files AND {_terms_sql()})""")
def _(spark, d):
    """Each file joins a version of its own project, whichever run stored it."""
    stored = two_runs(spark, d)
    owners = stored["project_versions"].select(
        "version_key", F.col("project_key").alias("version_project"))
    return stored["files"].join(owners, "version_key").select(
        "project_key", "file_name", "version_project")
