"""Views that give the benchmark tables the roles of a harvest.

One SQL text per view, the same for Spark and for the checking database. All
but `fx_records` are row-wise projections of one table: no window, no sort and
no join, so whatever shuffles in a query is the operator's own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS = {
    "fx_projects": """
        SELECT doc_id AS project_id, CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 15 END AS repository_id,
               CASE doc_id % 4 WHEN 0 THEN 'icpsr' WHEN 1 THEN 'openicpsr' WHEN 2 THEN 'datalumos'
                               ELSE 'other' END AS page_type,
               source AS repository, lang AS language, text AS description, n_chars
        FROM documents""",
    # one response page per 100 consecutive events of a term
    "fx_hits": """
        SELECT event_id, ts,
               CASE event_type WHEN 'signup' THEN 'qualitative' WHEN 'click' THEN 'interview'
                               WHEN 'view' THEN 'transcript' WHEN 'purchase' THEN 'focus group'
                               ELSE '*' END AS term,
               CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3
                               WHEN 'purchase' THEN 4 ELSE 5 END AS BIGINT) AS term_ord,
               concat('doi:10.17026/', CAST(user_id AS STRING)) AS global_id,
               CAST(floor(event_id / 100) * 20 AS BIGINT) AS start_pos,
               event_id % 100 AS pos
        FROM events
        WHERE user_id % 5 < CASE event_type WHEN 'signup' THEN 1 WHEN 'click' THEN 2
                                            WHEN 'view' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END""",
    "fx_versions": """
        SELECT o_custkey AS project_key, o_orderkey AS version_key, o_orderpriority AS raw_version,
               CASE WHEN o_orderstatus = 'P' THEN ''
                    ELSE concat('V', CAST(o_orderkey % 7 + 1 AS STRING)) END AS version,
               CASE WHEN o_orderstatus = 'O' THEN NULL
                    ELSE concat('V', CAST(o_orderkey % 7 + 1 AS STRING), '.0') END
                    AS download_version_folder,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS download_date,
               CASE o_orderkey % 5 WHEN 0 THEN '2024-03-09' WHEN 1 THEN '3/9/2024'
                                   WHEN 2 THEN '03/09/2024 04:05:PM'
                                   WHEN 3 THEN ' Spring  2024 ' ELSE '' END AS raw_date,
               CASE o_orderkey % 3 WHEN 0 THEN '3/2001 - 12/2005' WHEN 1 THEN '03/2001-1/2005'
                                   ELSE '2001--2005' END AS raw_period,
               o_orderkey % 4 = 0 AS is_current
        FROM orders""",
    "fx_files": """
        SELECT l_orderkey AS project_id, l_suppkey AS uri_no, l_linestatus = 'F' AS restricted,
               CAST(l_linenumber AS BIGINT) AS dataset_number, l_partkey AS part_no,
               concat(CASE l_suppkey % 9 WHEN 0 THEN 'interview_' WHEN 1 THEN 'Codebook '
                                         WHEN 2 THEN 'setup/' ELSE '' END,
                      'part_', CAST(l_partkey AS STRING), '_', CAST(l_suppkey AS STRING),
                      CASE l_partkey % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.CSV' WHEN 2 THEN '.docx'
                                         WHEN 3 THEN '.png' WHEN 4 THEN '' ELSE '.qdpx' END)
                      AS file_name,
               CASE l_partkey % 6 WHEN 0 THEN 'documentation' WHEN 1 THEN 'data'
                                  WHEN 2 THEN 'documentation' WHEN 3 THEN 'other'
                                  WHEN 4 THEN 'setup' ELSE 'data' END AS file_category,
               CASE l_linenumber % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '0' WHEN 2 THEN 'True'
                                     ELSE NULL END AS public_flag,
               CASE l_returnflag WHEN 'A' THEN 'SUCCEEDED' WHEN 'R' THEN 'FAILED_LOGIN_REQUIRED'
                                 ELSE 'TIMEOUT' END AS raw_status
        FROM lineitem""",
    "fx_labels": """
        SELECT l_orderkey AS project_id, CAST(l_linenumber AS BIGINT) AS dataset_number,
               l_partkey AS part_no, l_suppkey AS uri_no,
               CASE l_partkey % 8
                    WHEN 0 THEN concat('Documentation [PDF] Report ', CAST(l_suppkey AS STRING))
                    WHEN 1 THEN 'Stata'
                    WHEN 2 THEN concat(' SPSS  Setup  ', CAST(l_suppkey % 3 AS STRING))
                    WHEN 3 THEN concat('Readme [Text] notes_', CAST(l_suppkey AS STRING), '.txt')
                    WHEN 4 THEN 'Qualitative Data'
                    WHEN 5 THEN concat('Table [Excel] ', CAST(l_suppkey AS STRING))
                    WHEN 6 THEN 'usage_report' ELSE '  ' END AS label
        FROM lineitem""",
    "fx_fetch_log": """
        SELECT event_id AS fetch_id, user_id AS project_id, ts AS fetched_at,
               CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 200 WHEN 'signup' THEN 401
                               WHEN 'purchase' THEN 413 ELSE 503 END AS http_status,
               CAST(floor(value * 100000000) AS BIGINT) AS size_bytes
        FROM events""",
    "fx_people": """
        SELECT c_custkey AS person_id, CAST(c_nationkey AS BIGINT) AS project_key,
               concat('  ', c_name, ' ') AS name,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Contact Person'
                                 WHEN 'AUTOMOBILE' THEN 'Co-Producer' WHEN 'MACHINERY' THEN 'Creator'
                                 WHEN 'HOUSEHOLD' THEN 'author' ELSE 'Funder' END AS raw_role,
               CASE c_custkey % 3 WHEN 0 THEN 'ICPSR' WHEN 1 THEN 'datalumos'
                                  ELSE 'Some University' END AS affiliation
        FROM customer""",
    "fx_licenses": """
        SELECT doc_id AS project_key,
               CASE doc_id % 6 WHEN 0 THEN 'https://creativecommons.org/licenses/by/4.0'
                               WHEN 1 THEN 'http://creativecommons.org/licenses/by/4.0/'
                               WHEN 2 THEN 'cc-by-nc-nd-4.0' WHEN 3 THEN ' CC0 1.0 ' WHEN 4 THEN ''
                               ELSE 'MIT License' END AS license
        FROM documents""",
    "fx_dois": """
        SELECT doc_id,
               CASE doc_id % 5
                    WHEN 0 THEN concat('http://dx.doi.org/10.17026/x-', CAST(doc_id AS STRING))
                    WHEN 1 THEN concat('10.3886/S', CAST(doc_id AS STRING))
                    WHEN 2 THEN concat('HTTPS://DOI.ORG/10.1/', CAST(doc_id AS STRING))
                    WHEN 3 THEN concat('hdl:1/', CAST(doc_id AS STRING)) ELSE ' ' END AS raw_doi
        FROM documents""",
    "fx_links": """
        SELECT l_orderkey AS link_id, l_partkey AS part_no, l_suppkey AS uri_no,
               CAST(l_linenumber AS BIGINT) AS pos,
               concat(CASE l_linenumber % 2 WHEN 0 THEN 'HTTPS' ELSE 'http' END,
                      '://Data.example.org/project/', CAST(l_orderkey AS STRING), '/version/V',
                      CAST(l_linenumber AS STRING), '/view',
                      CASE l_partkey % 5
                        WHEN 0 THEN concat('?type=file&path=/a%20b/f', CAST(l_partkey AS STRING),
                                           '.PDF&jsessionid=9')
                        WHEN 1 THEN concat('/x+y%2Fz', CAST(l_partkey AS STRING), '.csv')
                        WHEN 2 THEN '?pageSize=10&pageSelected=2&flag'
                        WHEN 3 THEN '#top' ELSE '/?' END) AS url
        FROM lineitem""",
}
VIEWS["fx_records"] = f"""
    SELECT d.doc_id AS record_id,
           CASE WHEN d.doc_id % 11 = 0 THEN '  '
                ELSE concat('Study ', CAST(d.doc_id AS STRING)) END AS title,
           CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(d.doc_id AS STRING) END AS study_id,
           CAST(d.doc_id - d.doc_id % 2 AS STRING) AS nested_study_id, x.raw_doi AS doi,
           CASE WHEN d.doc_id % 10 = 1 THEN 'https://doi.org/10.1/other' ELSE x.raw_doi END
               AS nested_doi,
           l.quality = 1 AS open_access, l.toxic = 1 AS has_restricted_files,
           d.doc_id % 4 = 0 AS access_restricted_data_button,
           d.doc_id % 6 = 0 AS any_restricted_type,
           d.doc_id % 3 AS publications_count, d.doc_id % 2 + 1 AS publications_items,
           '2024-01-01' AS published_date,
           CASE WHEN d.doc_id % 7 = 0 THEN '2024-01-02' ELSE '2024-01-01' END
               AS nested_published_date
    FROM documents d JOIN ({VIEWS['fx_dois']}) x ON x.doc_id = d.doc_id
    LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the tables of one folder."""
    text = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN)\s+{t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a table out by key: a small one is a single file that one task would read.

    The number is given, as adaptive execution would put rows of few bytes, from which whole pages
    are written, back into a few tasks.
    """
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, 16), *keys)


def with_views(names: str, body: str) -> str:
    """Checking SQL with the views it needs in front."""
    parts = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    return f"WITH {parts}\n{body}"
