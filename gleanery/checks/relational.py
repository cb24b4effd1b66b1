"""Queries over hits, files, versions, people and projects."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.checks import query
from gleanery.checks.scalars import cleaned, match_form_sql, version_sql
from gleanery.fixtures import spread, table, view, with_views
from gleanery.functions import codes, lists, text
from gleanery.operators import dedupe, files, people, signals, summary, versions
from gleanery.operators.labels import add_resource_label
from gleanery.sources import landing

HIT_ORDER = ["term_ord", "start_pos", "pos"]
FILE_ORDER = ["dataset_number", "part_no", "uri_no"]
IDENTITY = ["study_id", "url", "title"]


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# ---------------------------------------------------------------- search hits

@query("first_hit_wins", with_views("fx_hits", """
    SELECT global_id, term, start_pos, pos, event_id FROM fx_hits
    QUALIFY row_number() OVER (PARTITION BY global_id ORDER BY term_ord, start_pos, pos) = 1"""))
def _(spark, d):
    hits = view(spark, d, "fx_hits").filter(F.col("global_id") != "")
    return dedupe.first_wins(hits, ["global_id"], HIT_ORDER).select(
        "global_id", "term", "start_pos", "pos", "event_id")


@query("url_first_wins", r"""
    SELECT url_key, min(page_id) AS page_id
    FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS url_key
          FROM pages) GROUP BY url_key""")
def _(spark, d):
    from gleanery.functions import urls

    pages = table(spark, d, "pages").select(
        "page_id", urls.dedupe_url(F.regexp_replace("url", r"[?#].*$", "")).alias("url_key"))
    return dedupe.first_wins(pages, ["url_key"], ["page_id"])


def study_hits(spark, d):
    """Search hits as normalised study rows (the projection of a search document)."""
    from gleanery.functions import urls

    hits = view(spark, d, "fx_hits")
    ident = F.regexp_extract("global_id", r"(\d+)$", 1)
    return hits.select(
        "term", "term_ord", "start_pos", "pos", ident.alias("study_id"),
        urls.result_url(F.when(F.col("pos") % 2 == 0, F.lit(" ")), ident).alias("url"),
        text.clean_text(F.concat(F.lit(" Study  "), ident)).alias("title"),
        lists.clean_list(F.array(F.col("term"), F.lit(" "), F.col("term"))).alias("author"),
        (F.col("term_ord") * F.lit(25)).alias("reported_total"))


STUDY_SQL = """studies AS (
    SELECT term, term_ord, start_pos, pos, ident AS study_id,
           'https://www.icpsr.umich.edu/web/ICPSR/studies/' || ident AS url,
           'Study ' || ident AS title, term_ord * 25 AS reported_total
    FROM (SELECT *, regexp_extract(global_id, '(\\d+)$', 1) AS ident FROM fx_hits))"""


@query("search_studies", with_views("fx_hits", """
    SELECT term, 'https://www.icpsr.umich.edu/web/ICPSR/studies/' || ident AS url, ident AS study_id,
           'Study ' || ident AS title, term AS author, start_pos, pos
    FROM (SELECT *, regexp_extract(global_id, '(\\d+)$', 1) AS ident FROM fx_hits)
    QUALIFY row_number() OVER (PARTITION BY term, ident ORDER BY start_pos, pos) = 1"""
                                       .replace("\\\\", "\\")))
def _(spark, d):
    return (dedupe.distinct_studies(study_hits(spark, d), ["start_pos", "pos"], ["term"])
            .select("term", "url", "study_id", "title", F.array_join("author", "|").alias("author"),
                    "start_pos", "pos"))


def _guard_ctes() -> str:
    tail = """
pages AS (
    SELECT term, start_pos, count(*) AS entries, min(reported_total) AS reported_total,
           string_agg(study_id || ':' || CAST(pos AS VARCHAR), ',' ORDER BY pos) AS signature
    FROM studies GROUP BY term, start_pos),
news AS (
    SELECT term, first_start AS start_pos, count(*) AS new_entries
    FROM (SELECT term, start_pos, min(start_pos) OVER (PARTITION BY term, study_id) AS first_start
          FROM studies) WHERE start_pos = first_start GROUP BY 1, 2),
marked AS (
    SELECT p.*, coalesce(n.new_entries, 0) AS new_entries,
           min(p.start_pos) OVER (PARTITION BY p.term, p.signature) AS first_same,
           coalesce(sum(coalesce(n.new_entries, 0)) OVER (PARTITION BY p.term ORDER BY p.start_pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM pages p LEFT JOIN news n ON n.term = p.term AND n.start_pos = p.start_pos),
stops AS (
    SELECT term, min(reported_total) AS reported_total,
           min(start_pos) FILTER (start_pos > first_same) AS rep,
           min(start_pos) FILTER (start_pos > 0 AND new_entries = 0) AS stale,
           min(start_pos) FILTER (reported_total > 0 AND before >= reported_total) AS done
    FROM marked GROUP BY term),
guards AS (
    SELECT term, reported_total, least(rep, stale, done) AS stop_start,
           coalesce(least(rep, stale) < coalesce(done, 9000000000000), false) AS guard_triggered,
           CASE WHEN least(rep, stale) < coalesce(done, 9000000000000) THEN least(rep, stale) END
               AS guard_start,
           CASE WHEN least(rep, stale) < coalesce(done, 9000000000000) THEN
                CASE WHEN rep = least(rep, stale) THEN 'repeated_page_signature'
                     ELSE 'page_contains_zero_new_studies' END ELSE '' END AS guard_reason
    FROM stops),
kept AS (
    SELECT s.* FROM studies s JOIN guards g ON g.term = s.term
    WHERE g.stop_start IS NULL OR s.start_pos < g.stop_start)
"""
    return STUDY_SQL.replace("\\\\", "\\") + "," + tail


def _guarded(body: str) -> str:
    head = with_views("fx_hits", "")
    return head.rstrip() + ",\n" + _guard_ctes() + body


@query("pagination_guard", _guarded("SELECT * FROM guards"))
def _(spark, d):
    return dedupe.page_guards(study_hits(spark, d), ["term"], "start_pos", "pos", IDENTITY,
                              "reported_total", 20)


@query("search_summary", _guarded("""
    SELECT term, CASE WHEN g.reported_total > 0 THEN g.reported_total
                      ELSE count(DISTINCT study_id) END AS total_studies,
           count(DISTINCT study_id) AS studies_extracted,
           count(DISTINCT start_pos) AS pages_fetched, g.guard_triggered, g.guard_reason,
           g.guard_start
    FROM kept JOIN guards g USING (term)
    GROUP BY term, g.reported_total, g.guard_triggered, g.guard_reason, g.guard_start"""))
def _(spark, d):
    return dedupe.search_summary(study_hits(spark, d), ["term"], "start_pos", "pos", IDENTITY,
                                 "reported_total", 20)


@query("page_new_counts", _guarded(
    "SELECT term, start_pos, entries, new_entries FROM marked"))
def _(spark, d):
    return dedupe.new_and_duplicate_counts(study_hits(spark, d), ["term"], "start_pos", IDENTITY)


@query("first_page_titles", _guarded("""
    SELECT term, start_pos, title, place FROM (
        SELECT term, start_pos, title,
               row_number() OVER (PARTITION BY term, start_pos ORDER BY pos) AS place FROM studies)
    WHERE place <= 3"""))
def _(spark, d):
    return dedupe.first_titles(study_hits(spark, d), ["term", "start_pos"], "pos", "title")


@query("frontier_remaining", with_views("fx_hits fx_fetch_log", """
    SELECT DISTINCT global_id FROM fx_hits
    WHERE global_id NOT IN (SELECT 'doi:10.17026/' || CAST(project_id AS VARCHAR)
                            FROM fx_fetch_log WHERE http_status = 413 AND project_id % 3 = 0)"""))
def _(spark, d):
    done = view(spark, d, "fx_fetch_log").filter("http_status = 413 AND project_id % 3 = 0").select(
        F.concat(F.lit("doi:10.17026/"), F.col("project_id").cast("string")).alias("global_id"))
    return dedupe.remaining(view(spark, d, "fx_hits").select("global_id").distinct(), done,
                            ["global_id"])


# ---------------------------------------------------------------- signals

TERM = "[a-z]{9,14}"


def dictionary(spark, d) -> list[str]:
    """The longer words of the passage table, a small one: hundreds of terms that texts hit."""
    words = table(spark, d, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0)).alias("t"))
    return landing.bounded_terms(words, "t", most=100_000)


_TERMS = (f"(SELECT list(t ORDER BY t) FROM (SELECT DISTINCT unnest("
          f"regexp_extract_all(lower(text), '{TERM}')) AS t FROM benchmark))")
_HITS = f"list_filter({_TERMS}, lambda t: contains(low, t))"
_DESC = f"SELECT doc_id, low, {_HITS} AS hits FROM (SELECT doc_id, lower(trim(text)) AS low FROM documents)"


@query("desc_signal", f"""
    SELECT doc_id, len(hits) > 0 AS signal, array_to_string(hits, '|') AS terms,
           CASE WHEN low = '' THEN 'Description missing'
                WHEN len(hits) > 0 THEN 'Description matched: ' || array_to_string(hits[1:10], ', ')
                ELSE 'No qualitative keywords found in description' END AS reason
    FROM ({_DESC})""")
def _(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return signals.description_signal(docs, "text", dictionary(spark, d)).select(
        "doc_id", F.col("description_signal").alias("signal"),
        F.array_join("description_terms", "|").alias("terms"),
        F.col("description_reason").alias("reason"))


@query("keyword_frequency", f"""
    SELECT term, count(*) AS n FROM (SELECT unnest(hits) AS term FROM ({_DESC})) GROUP BY term""")
def _(spark, d):
    return signals.term_frequency(spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id"),
                                  "text", dictionary(spark, d))


@query("dictionary_hits", f"""
    SELECT doc_id, unnest(hits) AS term FROM ({_DESC})""")
def _(spark, d):
    """The dictionary stays a table: texts and terms meet by the rarest piece of each term."""
    words = table(spark, d, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0)).alias("t"))
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return signals.dictionary_hits(docs, ["doc_id"], "text", words, "t")


@query("word_signal", r"""
    SELECT doc_id, contains(' ' || w || ' ', ' par ') AS par, contains(' ' || w || ' ', ' the ') AS the_
    FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}\p{Pc}]+', ' ', 'g')) AS w
          FROM documents)""")
def _(spark, d):
    found = signals.word_signal(spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id"), "text",
                                ["PAR", "the"])
    return found.select(
        "doc_id", F.array_contains("description_terms", "PAR").alias("par"),
        F.array_contains("description_terms", "the").alias("the_"))


def _phrases(column, words):
    forms = ", ".join(f"{{'p': '{w}', 'm': {match_form_sql(repr(w))}}}" for w in words)
    return (f"array_to_string(list_transform(list_filter([{forms}], "
            f"lambda e: contains({column}, e.m)), lambda e: e.p), '|')")


@query("phrase_signals", f"""
    SELECT doc_id, {_phrases('s', vocab.SUMMARY_PHRASES)} AS summary_matches,
           {_phrases('k', vocab.KIND_PHRASES)} AS kind_matches,
           {_phrases('m', vocab.COLLECTION_PHRASES)} AS mode_matches,
           CASE WHEN {_phrases('s', vocab.SUMMARY_PHRASES)} <> '' THEN 'summary_signal_pass'
                WHEN {_phrases('k', vocab.KIND_PHRASES)} <> '' THEN 'kind_signal_pass'
                WHEN {_phrases('m', vocab.COLLECTION_PHRASES)} <> '' THEN 'collection_signal_pass'
                ELSE 'no_enabled_signal_matched:summary+kind+collection' END AS reason,
           md5(summary_text) AS summary_digest
    FROM (SELECT doc_id, summary_text, {match_form_sql('summary_text')} AS s,
                 {match_form_sql("trim(lang || ' ' || src)")} AS k, {match_form_sql('src')} AS m
          FROM (SELECT doc_id, lang, src, CASE WHEN {match_form_sql('summary')} =
                       {match_form_sql('text')} AND trim(summary) <> '' AND trim(text) <> ''
                       THEN {cleaned('summary')}
                       ELSE concat_ws(' ', nullif({cleaned('summary')}, ''), nullif({cleaned('text')}, ''))
                       END AS summary_text
                FROM (SELECT doc_id, text, lang,
                             CASE doc_id % 7 WHEN 0 THEN 'Transcripts' WHEN 1 THEN 'Focus_groups'
                                  ELSE source END AS src,
                             CASE doc_id % 5 WHEN 0 THEN '  ' || text WHEN 1 THEN 'Oral-Histories'
                                  ELSE '' END AS summary
                      FROM documents)))""")
def _(spark, d):
    docs = spread(table(spark, d, "documents"), "doc_id").select(
        "doc_id", "text", "lang",
        F.when(F.col("doc_id") % 7 == 0, F.lit("Transcripts"))
        .when(F.col("doc_id") % 7 == 1, F.lit("Focus_groups")).otherwise(F.col("source"))
        .alias("src"),
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("  "), F.col("text")))
        .when(F.col("doc_id") % 5 == 1, F.lit("Oral-Histories")).otherwise(F.lit(""))
        .alias("summary"))
    out = signals.phrase_signals(
        docs.withColumn("kinds", F.array("lang", "src")).withColumn("modes", F.array("src")),
        "summary", "text", "kinds", "modes")
    return out.select(
        "doc_id", *[F.array_join(c, "|").alias(c)
                    for c in ("summary_matches", "kind_matches", "mode_matches")],
        F.col("decision_reason").alias("reason"), F.md5("summary_text").alias("summary_digest"))


_FILE_HITS = f"list_filter({sql_list(vocab.FILENAME_TERMS)}, lambda t: contains(lower(file_name), lower(t)))"
_FILE_EXT = (f"CASE WHEN contains(file_name, '.') AND lower(regexp_extract(file_name, '[^.]*$')) IN "
             f"({', '.join(repr(e) for e in vocab.QUALITATIVE_EXTENSIONS)}) "
             "THEN lower(regexp_extract(file_name, '[^.]*$')) END")
SIGNAL_SQL = f"""marks AS (
    SELECT project_id, {_FILE_EXT} AS ext, {_FILE_HITS} AS terms FROM fx_files),
signals AS (
    SELECT project_id, count(*) AS file_count,
           array_to_string(list_sort(list_distinct(list(ext) FILTER (ext IS NOT NULL))), ', ') AS extensions,
           array_to_string(list_sort(list_distinct(flatten(list(terms)))), ', ') AS filename_terms
    FROM marks GROUP BY project_id)"""


@query("file_signal", with_views("fx_files", "").rstrip() + ",\n" + SIGNAL_SQL + """
    SELECT project_id, file_count, coalesce(extensions, '') AS extensions, filename_terms,
           CASE WHEN coalesce(extensions, '') <> '' AND filename_terms <> '' THEN
                'Matched extension(s): ' || extensions || '; matched filename keyword(s): ' || filename_terms
                WHEN coalesce(extensions, '') <> '' THEN 'Matched extension(s): ' || extensions
                WHEN filename_terms <> '' THEN 'Matched filename keyword(s): ' || filename_terms
                ELSE 'No qualitative file signal found' END AS file_reason
    FROM signals""")
def _(spark, d):
    return signals.file_signals(spread(view(spark, d, "fx_files"), "project_id"), ["project_id"]).select(
        "project_id", "file_count", F.array_join("extensions", ", ").alias("extensions"),
        F.array_join("filename_terms", ", ").alias("filename_terms"), "file_reason")


def classified(spark, d, name="fx_projects"):
    projects = signals.description_signal(
        spread(view(spark, d, name), "project_id"), "description", dictionary(spark, d)
    ).drop("description")
    return signals.classify_projects(
        projects, spread(view(spark, d, "fx_files"), "project_id"), "project_id")


CLASSIFIED_SQL = with_views("fx_projects fx_files", "").rstrip() + ",\n" + SIGNAL_SQL + f""",
described AS (
    SELECT project_id, repository_id, repository, page_type, len({_HITS}) > 0 AS description_signal
    FROM (SELECT *, lower(trim(description)) AS low FROM fx_projects)),
classified AS (
    SELECT d.*, coalesce(extensions, '') <> '' AS extension_found,
           coalesce(filename_terms, '') <> '' AS filename_found, file_count IS NOT NULL AS has_files,
           description_signal AND (coalesce(extensions, '') <> '' OR coalesce(filename_terms, '') <> '')
               AS qualitative
    FROM described d LEFT JOIN signals s ON s.project_id = d.project_id)
"""


@query("classify_projects", CLASSIFIED_SQL + """
    SELECT project_id, description_signal, extension_found, filename_found, has_files, qualitative
    FROM classified""")
def _(spark, d):
    return classified(spark, d).select("project_id", "description_signal", "extension_found",
                                       "filename_found", "has_files", "qualitative")


_COUNTS = """count(*) AS total_projects, count(*) FILTER (f) AS projects_with_files,
    count(*) FILTER (NOT f) AS projects_with_no_files,
    count(*) FILTER (q) AS identified_qualitative_projects,
    count(*) FILTER (q AND f) AS identified_qualitative_with_files,
    count(*) FILTER (q AND NOT f) AS identified_qualitative_with_no_files,
    count(*) FILTER (NOT q) AS identified_non_qualitative_projects,
    count(*) FILTER (NOT q AND f) AS identified_non_qualitative_with_files,
    count(*) FILTER (NOT q AND NOT f) AS identified_non_qualitative_with_no_files"""


@query("bucket_summary", CLASSIFIED_SQL + f"""
    SELECT repository, {_COUNTS}
    FROM (SELECT *, qualitative AS q, has_files AS f FROM classified) GROUP BY repository""")
def bucket_summary(spark, d):
    return summary.run_counts(classified(spark, d), ["repository"])


@query("bucket_members", CLASSIFIED_SQL + """
    SELECT 'identified_' || CASE WHEN qualitative THEN '' ELSE 'non_' END || 'qualitative_with_'
           || CASE WHEN has_files THEN '' ELSE 'no_' END || 'files' AS bucket, project_id
    FROM classified""")
def _(spark, d):
    return summary.bucket_members(classified(spark, d), "project_id")


@query("download_frontier", with_views("fx_projects", f"""
    SELECT project_id, page_type, CAST(project_id + 30000 AS VARCHAR) AS study_id,
           CASE WHEN n_chars % 3 = 0 THEN '1.0' ELSE 'V' || CAST(n_chars % 3 AS VARCHAR) END AS version
    FROM (SELECT *, lower(trim(description)) AS low FROM fx_projects)
    WHERE page_type IN ('icpsr', 'openicpsr', 'datalumos') AND len({_HITS}) > 0"""))
def _(spark, d):
    projects = signals.description_signal(
        spread(view(spark, d, "fx_projects"), "project_id"), "description", dictionary(spark, d))
    part = F.col("n_chars") % 3
    return files.download_frontier(
        projects.withColumn("study", F.col("project_id") + 30000)
        .withColumn("version", F.when(part > 0, F.concat(F.lit("V"), part.cast("string"))).otherwise(" ")),
        "project_id", "study", "version")


# ---------------------------------------------------------------- downloads

_STATUS = """CASE WHEN http_status = 200 AND size_bytes > 5368709120 THEN 'FAILED_TOO_LARGE'
    WHEN http_status = 200 THEN 'SUCCEEDED' WHEN http_status IN (401, 403) THEN 'FAILED_LOGIN_REQUIRED'
    WHEN http_status = 413 THEN 'FAILED_TOO_LARGE' ELSE 'FAILED_SERVER_UNRESPONSIVE' END"""


def fetches(spark, d):
    return view(spark, d, "fx_fetch_log").withColumn(
        "status", codes.http_status_code("http_status", "size_bytes"))


@query("download_summary", with_views("fx_fetch_log", f"""
    SELECT count(*) AS download_attempted, count(*) FILTER (s = 'SUCCEEDED') AS download_succeeded,
           count(*) FILTER (s = 'FAILED_LOGIN_REQUIRED') AS download_failed_login_required,
           count(*) FILTER (s = 'FAILED_SERVER_UNRESPONSIVE') AS download_failed_server_unresponsive,
           count(*) FILTER (s = 'FAILED_TOO_LARGE') AS download_failed_too_large
    FROM (SELECT {_STATUS} AS s FROM fx_fetch_log)"""))
def _(spark, d):
    return summary.download_counts(fetches(spark, d))


@query("download_members", with_views("fx_fetch_log", f"""
    SELECT CASE s WHEN 'SUCCEEDED' THEN 'download_succeeded'
        WHEN 'FAILED_LOGIN_REQUIRED' THEN 'download_failed_login_required'
        WHEN 'FAILED_TOO_LARGE' THEN 'download_failed_too_large'
        ELSE 'download_failed_server_unresponsive' END AS bucket, fetch_id
    FROM (SELECT fetch_id, {_STATUS} AS s FROM fx_fetch_log)"""))
def _(spark, d):
    return summary.download_members(fetches(spark, d), "fetch_id")


@query("final_status", with_views("fx_fetch_log", f"""
    SELECT project_id, CASE min(CASE s WHEN 'SUCCEEDED' THEN 1 WHEN 'FAILED_LOGIN_REQUIRED' THEN 2
               WHEN 'FAILED_TOO_LARGE' THEN 3 ELSE 4 END) WHEN 1 THEN 'SUCCEEDED'
               WHEN 2 THEN 'FAILED_LOGIN_REQUIRED' WHEN 3 THEN 'FAILED_TOO_LARGE'
               ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS final_status, count(*) AS file_rows
    FROM (SELECT project_id, CASE WHEN fetch_id % 7 <> 0 AND http_status = 200 THEN
                     'FAILED_SERVER_UNRESPONSIVE' ELSE {_STATUS} END AS s FROM fx_fetch_log)
    GROUP BY project_id"""))
def _(spark, d):
    # most fetches answer 200: six of seven of those count as lost on the way
    lost = (F.col("fetch_id") % 7 != 0) & (F.col("http_status") == 200)
    log = fetches(spark, d).withColumn("status", F.when(lost, F.lit(
        "FAILED_SERVER_UNRESPONSIVE")).otherwise(F.col("status")))
    return summary.final_status(log, ["project_id"])


@query("download_results", with_views("fx_fetch_log", f"""
    SELECT project_id, page_type, study_id, version, final_status, file_rows,
           CASE WHEN final_status <> 'SUCCEEDED' THEN CASE page_type WHEN 'icpsr' THEN 'ICPSR_'
                WHEN 'openicpsr' THEN 'OpenICPSR_' WHEN 'datalumos' THEN 'DataLumos_' ELSE 'Study_' END
                || study_id || '-V' || substr(version, 2) || '.0.zip' END AS placeholder
    FROM (SELECT project_id, page_type, CAST(project_id + 36000 AS VARCHAR) AS study_id,
                 'V' || CAST(project_id % 3 + 1 AS VARCHAR) AS version,
                 CASE min(CASE s WHEN 'SUCCEEDED' THEN 1 WHEN 'FAILED_LOGIN_REQUIRED' THEN 2
                     WHEN 'FAILED_TOO_LARGE' THEN 3 ELSE 4 END) WHEN 1 THEN 'SUCCEEDED'
                     WHEN 2 THEN 'FAILED_LOGIN_REQUIRED' WHEN 3 THEN 'FAILED_TOO_LARGE'
                     ELSE 'FAILED_SERVER_UNRESPONSIVE' END AS final_status, count(*) AS file_rows
          FROM (SELECT project_id, page_type, CASE page_type WHEN 'icpsr' THEN {_STATUS}
                       WHEN 'web' THEN 'FAILED_SERVER_UNRESPONSIVE' ELSE 'FAILED_LOGIN_REQUIRED' END AS s
                FROM (SELECT *, CASE project_id % 4 WHEN 0 THEN 'icpsr' WHEN 1 THEN 'openicpsr'
                             WHEN 2 THEN 'datalumos' ELSE 'web' END AS page_type FROM fx_fetch_log))
          GROUP BY project_id, page_type)"""))
def _(spark, d):
    kinds = F.array(*map(F.lit, ["icpsr", "openicpsr", "datalumos", "web"]))
    log = view(spark, d, "fx_fetch_log").withColumn(
        "page_type", F.get(kinds, (F.col("project_id") % 4).cast("int"))).withColumn(
        "study_id", (F.col("project_id") + 36000).cast("string")).withColumn(
        "version", F.concat(F.lit("V"), (F.col("project_id") % 3 + 1).cast("string")))
    return files.download_results(log, ["project_id"])


@query("file_states", with_views("fx_files", r"""
    SELECT project_id, dataset_number, part_no, uri_no,
           regexp_replace(file_name, '[\\/]+', '_', 'g') AS safe_name,
           CASE WHEN part_no % 3 = 0 OR raw_status = 'TIMEOUT' THEN 'FAILED_SERVER_UNRESPONSIVE'
                ELSE raw_status END AS status
    FROM fx_files"""))
def _(spark, d):
    keys = ["project_id", "dataset_number", "part_no", "uri_no"]
    found = spread(view(spark, d, "fx_files"), *keys)
    log = found.filter("part_no % 3 <> 0").select(
        *keys, text.safe_file("file_name").alias("safe_name"), F.col("raw_status").alias("status"))
    # every file was tried before, and every second one twice with another outcome
    tries = log.withColumn("attempt", F.lit(9)).unionByName(log.select(
        *keys, "safe_name", F.lit("FAILED_TOO_LARGE").alias("status"), F.explode(F.when(
            F.col("uri_no") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("attempt")))
    return files.file_states(found.select(*keys, "file_name"), tries, keys).drop("file_name")


@query("download_rows", with_views("fx_files", """
    SELECT DISTINCT uri_no, file_name, CASE part_no % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'csv'
               WHEN 2 THEN 'docx' WHEN 3 THEN 'png' WHEN 4 THEN 'unknown' ELSE 'qdpx' END AS file_type,
           CASE WHEN raw_status = 'TIMEOUT' THEN 'FAILED_SERVER_UNRESPONSIVE' ELSE raw_status END
               AS status
    FROM fx_files"""))
def _(spark, d):
    rows = spread(view(spark, d, "fx_files"), "project_id").select(
        "uri_no", "file_name", F.lit(" ").alias("file_type"), F.col("raw_status").alias("status"))
    return files.download_rows(rows, ["uri_no"])


# ---------------------------------------------------------------- files

def file_entries(spark, d):
    """Files as extracted entries with the fields the merge works on."""
    f = spread(view(spark, d, "fx_files"), "project_id")
    return f.select(
        F.col("project_id"), "dataset_number", "part_no", "uri_no",
        F.lit("").alias("resource_uuid"), F.lit(None).cast("bigint").alias("file_id"),
        F.concat(F.lit("https://h/f?x=1&path=/"), F.col("uri_no").cast("string")).alias("uri"),
        "file_name", F.col("file_name").alias("title"),
        F.when(F.col("part_no") % 4 == 0, F.lit("")).otherwise(F.col("file_category"))
        .alias("file_content"),
        "file_category", F.nullif(text.file_extension("file_name"), F.lit("unknown"))
        .alias("file_format"),
        text.flag("public_flag").alias("public"), F.col("restricted").alias("downloadable"),
        F.when(F.col("part_no") % 5 != 0, F.col("part_no")).alias("size_bytes"))


MERGE_COLUMNS = ["file_name", "file_content", "file_category", "file_format"]
_PLACE = "ORDER BY dataset_number, part_no, uri_no"


ENTRY_SQL = """entries AS (
    SELECT project_id, dataset_number, part_no, uri_no, file_name, file_category,
           CASE WHEN part_no % 4 = 0 THEN '' ELSE file_category END AS file_content,
           CASE part_no % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'csv' WHEN 2 THEN 'docx' WHEN 3 THEN 'png'
                WHEN 5 THEN 'qdpx' END AS file_format,
           CASE public_flag WHEN 'yes' THEN true WHEN '0' THEN false END AS public,
           restricted AS downloadable, CASE WHEN part_no % 5 <> 0 THEN part_no END AS size_bytes
    FROM fx_files),
merged AS (
    SELECT project_id, uri_no, """ + ", ".join(
    f"first({c} {_PLACE}) FILTER ({c} <> '') AS {c}" for c in MERGE_COLUMNS) + f""",
           first(size_bytes {_PLACE}) FILTER (size_bytes IS NOT NULL) AS size_bytes,
           bool_or(public) AS public, bool_or(downloadable) AS downloadable,
           count(*) AS raw_occurrence_count, min(dataset_number) AS first_dataset
    FROM entries GROUP BY project_id, uri_no)"""


def merged_files(spark, d):
    return files.merge_files(file_entries(spark, d), ["project_id"], FILE_ORDER, "datalumos",
                             MERGE_COLUMNS, ["public", "downloadable"], ["size_bytes"])


@query("merge_files", with_views("fx_files", "").rstrip() + ",\n" + ENTRY_SQL + """
    SELECT project_id, 'https://h/f?path=%2F' || CAST(uri_no AS VARCHAR) AS file_key, file_name,
           file_content, file_category, file_format, size_bytes, public, downloadable,
           raw_occurrence_count, first_dataset
    FROM merged""")
def merge_files_query(spark, d):
    return (merged_files(spark, d).withColumn("first_dataset", F.col("first_order.dataset_number"))
            .drop("first_order"))


@query("merge_file_lists", with_views("fx_files", """
    SELECT project_id, entry, min(dataset_number) AS first_dataset
    FROM (SELECT project_id, dataset_number, unnest([raw_status, file_category]) AS entry
          FROM fx_files) GROUP BY project_id, entry"""))
def _(spark, d):
    rows = view(spark, d, "fx_files").withColumn("entry", F.array("raw_status", "file_category"))
    return (dedupe.merge_list_values(rows, ["project_id"], FILE_ORDER, "entry")
            .select("project_id", "entry", F.col("place._o.dataset_number").alias("first_dataset")))


@query("file_summary", with_views("fx_files", "").rstrip() + ",\n" + ENTRY_SQL + """
    SELECT * FROM (SELECT project_id, count(*) AS raw_entry_count,
        count(*) FILTER (public) AS raw_public_entries,
        count(*) FILTER (NOT public) AS raw_restricted_or_nonpublic_entries,
        count(*) FILTER (downloadable) AS raw_downloadable_entries
        FROM entries GROUP BY project_id)
    JOIN (SELECT project_id, count(*) AS unique_file_count,
        count(*) FILTER (public) AS unique_public_files,
        count(*) FILTER (NOT public) AS unique_restricted_or_nonpublic_files,
        count(*) FILTER (downloadable) AS unique_downloadable_files,
        count(*) FILTER (downloadable AND public) AS downloadable_public_files,
        count(*) FILTER (downloadable AND file_category = 'documentation')
            AS downloadable_documentation_files,
        count(*) FILTER (downloadable AND file_category = 'data') AS downloadable_data_files,
        count(*) FILTER (file_category = 'documentation') AS documentation_file_count,
        count(*) FILTER (file_category = 'data') AS data_file_count,
        count(*) FILTER (file_category = 'setup') AS setup_file_count,
        count(*) FILTER (file_category = 'other') AS other_file_count
        FROM merged GROUP BY project_id) USING (project_id)""")
def _(spark, d):
    return files.file_counters(file_entries(spark, d), merged_files(spark, d), ["project_id"])


@query("file_histograms", with_views("fx_files", "").rstrip() + ",\n" + ENTRY_SQL + """
    SELECT project_id, grain, field, value, count(*) AS n FROM (
        SELECT project_id, 'raw' AS grain, 'file_format' AS field, file_format AS value FROM entries
        UNION ALL SELECT project_id, 'raw', 'file_content', file_content FROM entries
        UNION ALL SELECT project_id, 'unique', 'file_format', file_format FROM merged
        UNION ALL SELECT project_id, 'unique', 'file_content', file_content FROM merged)
    WHERE value <> '' GROUP BY ALL""")
def _(spark, d):
    return files.file_histograms(file_entries(spark, d), merged_files(spark, d), ["project_id"])


def _access_sql(profile):
    head = with_views("fx_files", "").rstrip() + ",\n" + ENTRY_SQL + """,
facts AS (
    SELECT o_orderkey AS project_id, o_orderkey % 5 = 0 AS restricted_type,
           o_orderkey % 3 = 0 AS restricted_button, o_orderkey % 4 AS download_options FROM orders),
counted AS (
    SELECT f.*, coalesce(n, 0) AS n, coalesce(p, 0) AS p, coalesce(c, 0) AS c, coalesce(w, 0) AS w
    FROM facts f LEFT JOIN (SELECT project_id, count(*) AS n, count(*) FILTER (public) AS p,
        count(*) FILTER (NOT public) AS c, count(*) FILTER (downloadable) AS w
        FROM merged GROUP BY project_id) m ON m.project_id = f.project_id)
"""
    marked = "(restricted_type OR restricted_button)"
    if profile == "icpsr":
        cols = f"""w > 0 OR download_options > 0 AS has_downloadable_files,
            {marked} AS has_restricted_files,
            CASE WHEN p > 0 THEN true WHEN c > 0 THEN false END AS has_public_files,
            CASE WHEN {marked} THEN false WHEN n > 0 OR download_options > 0 THEN true END AS open_access,
            CASE WHEN {marked} THEN true END AS authentication_required"""
    else:
        public = ("CASE WHEN p > 0 THEN true WHEN n > 0 THEN false END" if profile == "datalumos"
                  else "CASE WHEN p > 0 THEN true END")
        cols = f"""w > 0 AS has_downloadable_files, c > 0 OR {marked} AS has_restricted_files,
            {public} AS has_public_files,
            CASE WHEN n > 0 AND p = n THEN true WHEN c > 0 THEN false END AS open_access,
            CASE WHEN c > 0 OR {marked} THEN true END AS authentication_required"""
    return head + f"SELECT project_id, {cols} FROM counted"


def _access(profile):
    def run(spark, d):
        facts = table(spark, d, "orders").select(
            F.col("o_orderkey").alias("project_id"),
            (F.col("o_orderkey") % 5 == 0).alias("restricted_type"),
            (F.col("o_orderkey") % 3 == 0).alias("restricted_button"),
            (F.col("o_orderkey") % 4).alias("download_options"))
        return files.access_flags(merged_files(spark, d), ["project_id"], facts, profile)
    return run


query("access_flags_study", _access_sql("icpsr"))(_access("icpsr"))
query("access_flags_open", _access_sql("openicpsr"))(_access("openicpsr"))
query("access_flags_folder", _access_sql("datalumos"))(_access("datalumos"))


@query("file_count_mismatches", with_views("fx_files", "").rstrip() + ",\n" + ENTRY_SQL + """,
actual AS (
    SELECT project_id, count(*) AS u, count(*) FILTER (file_category = 'documentation') AS dc,
           count(*) FILTER (file_category = 'data') AS da,
           count(*) FILTER (file_category = 'setup') AS se,
           count(*) FILTER (file_category = 'other') AS ot FROM merged GROUP BY project_id),
declared AS (
    SELECT o_orderkey AS project_id, o_orderkey % 7 AS u, o_orderkey % 3 AS dc,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 4 END AS da, 0 AS se, 1 AS ot FROM orders)
    SELECT project_id, counter, declared, actual FROM (
        SELECT d.project_id, unnest(['unique_file_count', 'documentation_file_count',
                   'data_file_count', 'setup_file_count', 'other_file_count']) AS counter,
               CAST(unnest([d.u, d.dc, d.da, d.se, d.ot]) AS BIGINT) AS declared,
               CAST(unnest([coalesce(a.u, 0), coalesce(a.dc, 0), coalesce(a.da, 0),
                   coalesce(a.se, 0), coalesce(a.ot, 0)]) AS BIGINT) AS actual
        FROM declared d LEFT JOIN actual a ON a.project_id = d.project_id)
    WHERE declared <> actual""")
def _(spark, d):
    k = F.col("o_orderkey")
    declared = table(spark, d, "orders").select(
        k.alias("project_id"), (k % 7).alias("unique_file_count"),
        (k % 3).alias("documentation_file_count"),
        F.when(k % 2 == 0, k % 4).alias("data_file_count"),
        F.lit(0).cast("bigint").alias("setup_file_count"),
        F.lit(1).cast("bigint").alias("other_file_count"))
    return files.count_mismatches(declared, merged_files(spark, d), ["project_id"])


@query("fallback_candidates", with_views("fx_labels fx_files", """,
menu AS (
    SELECT project_id, dataset_number, label_text, min(k) AS k, arg_min(s, (part_no, uri_no)) AS s,
           arg_min(m, (part_no, uri_no)) AS m
    FROM (SELECT *, trim(regexp_replace(label, ' +', ' ', 'g')) AS label_text, part_no % 8 AS k,
                 CAST(uri_no AS VARCHAR) AS s, CAST(uri_no % 3 AS VARCHAR) AS m FROM fx_labels)
    WHERE label_text <> '' GROUP BY ALL),
known AS (
    SELECT project_id, description, arg_max(file_name, (dataset_number, part_no, uri_no)) AS name,
           arg_max(file_category, (dataset_number, part_no, uri_no)) AS category,
           arg_max(ext, (dataset_number, part_no, uri_no)) AS ext
    FROM (SELECT *, CASE part_no % 2 WHEN 0 THEN 'Stata' ELSE 'usage_report' END AS description,
                 CASE part_no % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'csv' WHEN 2 THEN 'docx'
                     WHEN 3 THEN 'png' WHEN 4 THEN 'unknown' ELSE 'qdpx' END AS ext FROM fx_files)
    GROUP BY project_id, description)
    SELECT m.project_id, 'DS' || CAST(m.dataset_number AS VARCHAR) AS dataset_identifier,
           label_text AS label, coalesce(name, guess) AS file_name,
           coalesce(ext, CASE WHEN contains(guess, '.') THEN lower(regexp_extract(guess, '[^.]*$'))
                         ELSE 'unknown' END) AS file_type,
           coalesce(category, 'other') AS file_category, m.dataset_number AS sort_dataset,
           CAST(CASE coalesce(category, 'other') WHEN 'data' THEN 1 WHEN 'setup' THEN 2
                WHEN 'documentation' THEN 3 ELSE 4 END AS BIGINT) AS sort_priority,
           lower(label_text) AS sort_label
    FROM (SELECT *, CASE k WHEN 0 THEN 'Report_' || s || '.pdf' WHEN 1 THEN 'Stata'
                 WHEN 2 THEN 'SPSS_Setup_' || m WHEN 3 THEN 'notes_' || s || '.txt'
                 WHEN 4 THEN 'Qualitative_Data' WHEN 5 THEN s || '.xlsx'
                 ELSE 'usage_report' END AS guess FROM menu) m
    LEFT JOIN known ON known.project_id = m.project_id AND known.description = label_text
""").replace(")\n,\n", "),\n", 1))
def _(spark, d):
    menu = spread(view(spark, d, "fx_labels"), "project_id").withColumn(
        "dataset_identifier", F.concat(F.lit("DS"), F.col("dataset_number").cast("string")))
    known = (view(spark, d, "fx_files")
             .withColumn("file_description",
                         F.when(F.col("part_no") % 2 == 0, F.lit(" Stata ")).otherwise(
                             F.lit("usage_report")))
             .withColumn("file_extension", text.file_extension("file_name")))
    return files.fallback_candidates(menu, known, ["project_id"], ["part_no", "uri_no"], FILE_ORDER)


@query("package_priority", with_views("fx_people", """
    SELECT person_id, CASE WHEN person_id % 2 = 0 THEN
        'SAS|Custom ' || CAST(person_id AS VARCHAR)
            || '|Qualitative Data|Stata|SPSS|R|ASCII|Delimited|Documentation Only'
        ELSE 'Qualitative Data|Stata|SPSS|SAS|R|ASCII|Delimited|Documentation Only' END AS formats
    FROM fx_people"""))
def _(spark, d):
    offered = F.when(F.col("person_id") % 2 == 0, F.array(
        F.lit(" SAS"), F.concat(F.lit("Custom  "), F.col("person_id").cast("string")), F.lit("")))
    return view(spark, d, "fx_people").select(
        "person_id", F.array_join(files.package_formats(offered), "|").alias("formats"))


@query("dataset_menu", with_views("fx_labels", """
    SELECT project_id, dataset_number, identity_key, bool_or(mode = 0) AS previewable,
           bool_or(mode = 1) AS downloadable
    FROM (SELECT *, uri_no % 2 AS mode, CASE k
              WHEN 0 THEN lower(substr(raw, 21)) || '|pdf|documentation'
              WHEN 1 THEN 'stata|stata|stata' WHEN 2 THEN lower(raw) || '|sps|' || lower(raw)
              WHEN 3 THEN substr(raw, 15) || '|txt|readme'
              WHEN 4 THEN 'qualitative data|qda|qualitative data'
              WHEN 5 THEN substr(raw, 15) || '|xlsx|table'
              ELSE 'usage_report||usage_report' END AS identity_key
          FROM (SELECT *, part_no % 8 AS k, trim(regexp_replace(label, ' +', ' ', 'g')) AS raw
                FROM fx_labels) WHERE raw <> '')
    GROUP BY project_id, dataset_number, identity_key"""))
def _(spark, d):
    labelled = add_resource_label(spread(view(spark, d, "fx_labels"), "project_id"), "label").filter("raw_label <> ''")
    return labelled.groupBy("project_id", "dataset_number", "identity_key").agg(
        F.bool_or(F.col("uri_no") % 2 == 0).alias("previewable"),
        F.bool_or(F.col("uri_no") % 2 == 1).alias("downloadable"))


# ---------------------------------------------------------------- people, versions

_BUCKET = """CASE raw_role WHEN 'Contact Person' THEN 'CONTACT' WHEN 'Co-Producer' THEN 'PRODUCER'
    WHEN 'Creator' THEN 'AUTHOR' WHEN 'author' THEN 'AUTHOR' ELSE 'CONTRIBUTOR' END"""


@query("people_buckets", with_views("fx_people", f"""
    SELECT DISTINCT project_key, {_BUCKET} AS role, trim(name) AS name FROM fx_people"""))
def _(spark, d):
    return people.person_roles(view(spark, d, "fx_people"), "project_key", "name", "raw_role")


@query("latest_version", with_views("fx_versions", """
    SELECT project_key, first(version ORDER BY download_date DESC, version_key DESC)
               FILTER (version <> '') AS version,
           first(download_version_folder ORDER BY download_date DESC, version_key DESC)
               FILTER (download_version_folder <> '') AS download_version_folder
    FROM fx_versions GROUP BY project_key"""))
def _(spark, d):
    return versions.latest_version_info(view(spark, d, "fx_versions"), "project_key",
                                        "download_date", "version_key")


def version_input(spark, d):
    return view(spark, d, "fx_versions").select(
        "project_key", "version_key", "version", F.col("raw_date").alias("published_date"),
        (F.col("is_current") & (F.col("project_key") % 3 == 0)).alias("is_current"),
        F.concat(F.lit("V"), (F.col("project_key") % 9).cast("string")).alias("project_version"),
        F.lit("2024-01-01").alias("project_date"))


VERSION_SQL = f"""input AS (
    SELECT project_key, version_key, coalesce(nullif(version, ''), 'V' || CAST(project_key % 9 AS VARCHAR))
               AS version, version AS raw,
           CASE version_key % 5 WHEN 0 THEN '2024-03-09' WHEN 1 THEN '3/9/2024'
                WHEN 2 THEN '03/09/2024 04:05:PM' WHEN 3 THEN 'Spring 2024' ELSE '2024-01-01' END
               AS publication_date,
           is_current AND project_key % 3 = 0 AS flag,
           CAST(project_key % 9 AS VARCHAR) || '.0' AS wanted
    FROM fx_versions),
normal AS (
    SELECT *, {version_sql('version')} AS v FROM input),
facts AS (
    SELECT project_key, bool_or(flag) AS flagged, min(version_key) AS first_key,
           min(version_key) FILTER (v = wanted) AS match_key FROM normal GROUP BY project_key),
version_rows AS (
    SELECT n.project_key, version_key,
           coalesce(TRY_CAST(nullif(regexp_extract(raw, '\\d+'), '') AS BIGINT),
                    CAST(regexp_extract(v, '\\d+') AS BIGINT)) AS version_id,
           v AS version, 'RELEASED' AS version_state, publication_date,
           'V' || v AS download_version_folder,
           CASE WHEN flagged THEN flag ELSE version_key = coalesce(match_key, first_key) END AS is_current
    FROM normal n JOIN facts f ON f.project_key = n.project_key
    QUALIFY row_number() OVER (PARTITION BY n.project_key, v, publication_date ORDER BY version_key) = 1)
"""


@query("version_rows", with_views("fx_versions", "").rstrip() + ",\n" + VERSION_SQL
       + "SELECT * FROM version_rows")
def _(spark, d):
    return versions.version_rows(version_input(spark, d), "project_key", "version_key")


@query("current_version", with_views("fx_versions", "").rstrip() + ",\n" + VERSION_SQL + """
    SELECT project_key, version_key, version FROM version_rows
    QUALIFY row_number() OVER (PARTITION BY project_key ORDER BY NOT is_current,
        version <> CAST(project_key % 9 AS VARCHAR) || '.0', version_key) = 1""")
def _(spark, d):
    source = version_input(spark, d)
    rows = versions.version_rows(source, "project_key", "version_key")
    wanted = source.groupBy("project_key").agg(
        F.first("project_version").alias("project_version"))
    return versions.version_for_files(rows, wanted, "project_key", "version_key")


@query("page_versions", with_views("fx_versions", """
    SELECT project_key, version_key, version, published_date, url,
           CASE WHEN any_match THEN version = 'V3' ELSE version_key = first_key END AS is_current
    FROM (SELECT *, bool_or(version = 'V3') OVER (PARTITION BY project_key) AS any_match,
                 min(version_key) OVER (PARTITION BY project_key) AS first_key
          FROM (SELECT project_key, version_key, version, CASE version_key % 5 WHEN 3 THEN 'Spring 2024'
                    WHEN 4 THEN '' ELSE '2024-03-09' END AS published_date,
                    'https://h/p/' || CAST(project_key AS VARCHAR) AS url FROM fx_versions
                QUALIFY row_number() OVER (PARTITION BY project_key, version, published_date
                                           ORDER BY version_key) = 1))"""))
def _(spark, d):
    rows = view(spark, d, "fx_versions").select(
        "project_key", "version_key", "version", F.col("raw_date").alias("published_date"),
        F.concat(F.lit("https://h/p/"), F.col("project_key").cast("string"), F.lit("?s="),
                 F.col("version_key").cast("string")).alias("url"),
        F.lit("V3").alias("current_version"))
    return versions.page_versions(rows, "project_key", "version_key")


@query("row_numbers", """
    WITH keyed AS (SELECT row_number() OVER (ORDER BY o_orderkey) + 1000 AS id FROM orders)
    SELECT id FROM keyed""")
def _(spark, d):
    """All ids after 1000: dense, each once."""
    ids = dedupe.row_numbers(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"],
                             after=1000)
    return ids.select("id")
