"""The JSON pipeline: responses and documents to catalogue tables and a summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import codes
from gleanery.operators import dedupe, documents, signals, summary
from gleanery.operators import files as file_ops
from gleanery.schemas import TABLES
from gleanery.session import cut_lineage


@dataclass(frozen=True)
class ApiConfig:
    """What a run is called, its dictionary, and where its rows say they come from."""

    terms: list[str]
    repository_id: int = 5
    repository_url: str = ""
    folder: str = "repository"
    method: str = "API-CALL"
    run_time: str = ""
    engine: str = "automaton"


def first_hits(responses: DataFrame) -> DataFrame:
    """Hits of all searches, each dataset under the first term that found it."""
    hits = documents.search_hits(responses, "body")
    return dedupe.first_wins(hits, ["global_id"], ["term_ord", "start_pos", "pos"])


def last_landed(datasets: DataFrame) -> DataFrame:
    """One document for each dataset: the last that landed, by `landed_at` where that is known."""
    last = F.max_by("body", F.struct("landed_at", "body")) if "landed_at" in datasets.columns else F.max("body")
    return datasets.groupBy("global_id").agg(last.alias("body"))


def evaluate(
    hits: DataFrame, datasets: DataFrame, version_lists: DataFrame, config: ApiConfig
) -> dict[str, DataFrame]:
    """Projects with signals and decision, their labelled versions and files.

    `datasets` has global_id and body, `version_lists` project_key and body. A
    hit whose document never landed is a failure like one that is no dataset.
    Projects with their signals, and versions, feed several tables each and are
    written once.
    """
    fetched = hits.select("global_id", "term").join(last_landed(datasets), "global_id", "left")
    rows = cut_lineage(documents.project_rows(
        fetched, "body", "term", config.repository_id, config.repository_url, config.folder,
        config.method, config.run_time), "projects")
    failures = documents.failed_documents(rows, config.run_time)
    projects = signals.description_signal(
        rows.filter("project_key IS NOT NULL"), "description", config.terms, config.engine)
    versions = cut_lineage(documents.version_rows(
        version_lists, "body", "project_key", config.run_time), "versions")
    files = documents.file_rows(versions, "project_key")
    decided = cut_lineage(signals.classify_projects(projects, files, "project_key"), "decided")
    return {"projects": decided, "versions": versions.drop("files"), "files": files,
            "failures": failures}


def catalogue(
    evaluated: dict[str, DataFrame], fetch_log: DataFrame, after: dict[str, int] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Seen project keys, and the new rows of every stored table for the kept projects.

    A project is kept when it has files and qualifies. `fetch_log` has file_id
    and http_status; a file without an entry counts as unresponsive. `after`
    has the largest id of every stored table (`last_ids`), so that the new rows
    get ids no stored row has. Of several attempts at a file the last one counts.
    """
    after = after or {}
    projects = evaluated["projects"]
    seen = projects.select("project_key")
    kept = projects.filter("has_files AND qualitative")
    keys = kept.select("project_key")
    number = lambda table, df, *by: dedupe.row_numbers(
        df, list(by), after=after.get(table, 0))
    versions = cut_lineage(number(
        "project_versions", evaluated["versions"].join(keys, "project_key", "left_semi"),
        "project_key", "version_no").withColumnRenamed("id", "version_key"), "versions")
    states = file_ops.last_states(fetch_log, ["file_id"], "http_status").select(
        "file_id", codes.http_status_code("http_status").alias("status"))
    files = (
        evaluated["files"].join(versions.select("project_key", "version_no", "version_key"),
                                ["project_key", "version_no"])
        .join(states, "file_id", "left")
        .withColumn("status", codes.file_status(F.coalesce("status", F.lit(""))))
    )
    roles = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.array_distinct(column).alias("names"))
        for role, column in (("AUTHOR", "authors"), ("CONTACT", "contacts"),
                             ("PRODUCER", "producers"), ("CONTRIBUTOR", "contributors"))]))
    people = kept.select("project_key", roles.alias("r")).select(
        "project_key", F.col("r.role").alias("role"), F.explode("r.names").alias("name"))
    new = {
        "projects": kept,
        "project_versions": versions,
        "files": number("files", files, "version_key", "idx", "file_name"),
        "keywords": number(
            "keywords", kept.select("project_key", F.explode("keywords").alias("keyword")),
            "project_key", "keyword"),
        "person_role": number("person_role", people, "project_key", "role", "name"),
        "licenses": number(
            "licenses", kept.filter("license <> ''").select("project_key", "license"),
            "project_key"),
        "failures": number("failures", evaluated["failures"], "project_key", "reason"),
    }
    return seen, {name: df.select(*TABLES[name].names) for name, df in new.items()}


def last_ids(stored: dict[str, DataFrame]) -> dict[str, int]:
    """The largest id of each stored table, 0 where it has none: one number a table."""
    out = {}
    for name, df in stored.items():
        column = "version_key" if name == "project_versions" else "id"
        if column in df.columns:
            out[name] = df.agg(F.max(column)).first()[0] or 0
    return out


def run_summary(evaluated: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Counters of the run and the members of its buckets."""
    projects = evaluated["projects"]
    return summary.run_counts(projects), summary.bucket_members(projects, "project_id")


