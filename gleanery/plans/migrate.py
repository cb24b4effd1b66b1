"""Migration of the seven-table catalogue to the five-table one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.codes import license_name, role_code
from gleanery.operators.versions import latest_version_info

PROJECT_COLUMNS = [
    "id", "query_string", "repository_id", "repository_url", "project_url", "version", "title",
    "description", "language", "doi", "upload_date", "download_date",
    "download_repository_folder", "download_project_folder", "download_version_folder",
    "download_method",
]


def migrate(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rename keys, fold the newest version info into projects, map roles and licences."""
    latest = latest_version_info(
        tables["project_versions"], "project_key", "download_date", "version_key")
    projects = (
        tables["projects"].drop("project_id").join(latest, "project_key", "left")
        .withColumnRenamed("project_key", "id").select(*PROJECT_COLUMNS)
    )
    owner = F.col("project_key").alias("project_id")
    return {
        "projects": projects,
        "files": tables["files"].select("id", owner, "file_name", "file_type", "status"),
        "keywords": tables["keywords"].select("id", owner, "keyword"),
        "person_role": tables["person_role"].select(
            "id", owner, "name", role_code(F.coalesce("role", F.lit(""))).alias("role")),
        "licenses": tables["licenses"].select(
            "id", owner, license_name(F.coalesce("license", F.lit(""))).alias("license")),
    }
