"""Dataset and version documents: JSON to project, version and file rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.functions import codes
from gleanery.functions.text import file_extension, safe_folder

_LIST = "array<variant>"
# typeName of each people bucket and the sub-field that holds the name
PEOPLE = {
    "authors": ("author", "authorName"), "contacts": ("datasetContact", "datasetContactName"),
    "producers": ("producer", "producerName"),
    "contributors": ("contributor", "contributorName"),
}


def search_hits(responses: DataFrame, body: str) -> DataFrame:
    """Landed search responses to one row per hit, in page order.

    Adds global_id, pos and total_count to the other columns; hits without an
    id are left out.
    """
    parsed = responses.withColumn("_r", F.from_json(body, schemas.SEARCH_RESPONSE))
    keep = [c for c in responses.columns if c != body]
    return (
        parsed.select(*keep, F.col("_r.data.total_count").alias("total_count"),
                      F.posexplode("_r.data.items").alias("pos", "_i"))
        .select(*keep, "total_count", F.col("pos").cast("bigint").alias("pos"),
                F.col("_i.global_id").alias("global_id"))
        .filter(F.coalesce("global_id", F.lit("")) != "")
    )


def field_value(fields: Column, name: str) -> Column:
    """Value of the first field with a type name."""
    return F.get(F.filter(fields, lambda f: f["typeName"] == name), F.lit(0))["value"]


def compound_values(value: Column, key: str) -> Column:
    """Texts under `<key>.value` of a list of objects; anything else gives no texts."""
    items = F.coalesce(F.try_variant_get(value, "$", _LIST), F.array().cast(_LIST))
    texts = F.transform(items, lambda v: F.trim(F.try_variant_get(v, f"$.{key}.value", "string")))
    return F.filter(texts, lambda t: t.isNotNull() & (t != ""))


def text_value(value: Column) -> Column:
    """A field as one text: lists are joined by a space, objects give their `value`."""
    items = F.try_variant_get(value, "$", _LIST)
    texts = F.transform(items, lambda v: F.trim(F.coalesce(
        F.try_variant_get(v, "$.value", "string"), F.try_variant_get(v, "$", "string"))))
    joined = F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), " ")
    return F.coalesce(joined, F.trim(F.try_variant_get(value, "$", "string")), F.lit(""))


def project_rows(
    documents: DataFrame, body: str, query: str, repository_id: int, repository_url: str,
    folder: str, method: str, run_time: str,
) -> DataFrame:
    """Dataset documents to project rows with their list fields.

    A document that is no dataset (no numeric id) gives a row with NULL keys;
    `failed_documents` turns those into failures.
    """
    parsed = (
        documents.withColumn("_d", F.from_json(body, schemas.DATASET_DOCUMENT)["data"])
        .withColumn("_f", F.col("_d.latestVersion.metadataBlocks.citation.fields"))
    )
    fields = F.col("_f")
    people = [compound_values(field_value(fields, t), k).alias(c) for c, (t, k) in PEOPLE.items()]
    return parsed.select(
        *[c for c in documents.columns if c != body],
        codes.project_key(F.lit(repository_id), F.col("_d.id")).alias("project_key"),
        F.col("_d.id").alias("project_id"), F.col(query).alias("query_string"),
        F.lit(repository_id).cast("bigint").alias("repository_id"),
        F.lit(repository_url).alias("repository_url"),
        F.coalesce("_d.persistentUrl", F.lit("")).alias("project_url"),
        text_value(field_value(fields, "title")).alias("title"),
        F.array_join(compound_values(field_value(fields, "dsDescription"), "dsDescriptionValue"),
                     " ").alias("description"),
        text_value(field_value(fields, "language")).alias("language"),
        F.coalesce("_d.persistentUrl", F.lit("")).alias("doi"),
        F.coalesce(F.nullif(F.col("_d.latestVersion.publicationDate"), F.lit("")),
                   "_d.publicationDate", F.lit("")).alias("upload_date"),
        F.lit(run_time).alias("download_date"),
        F.lit(folder).alias("download_repository_folder"),
        safe_folder(F.coalesce("_d.identifier", F.lit(""))).alias("download_project_folder"),
        F.lit(method).alias("download_method"),
        F.sort_array(F.array_distinct(
            compound_values(field_value(fields, "keyword"), "keywordValue"))).alias("keywords"),
        *people,
        F.trim(F.coalesce("_d.latestVersion.license.name", F.lit(""))).alias("license"),
    )


def version_rows(lists: DataFrame, body: str, key: str, run_time: str) -> DataFrame:
    """Version lists to one row per labelled version, files still nested.

    `version_no` is the place in the list; versions without a number are left out.
    """
    parsed = lists.select(key, F.posexplode(
        F.from_json(body, schemas.VERSION_LIST)["data"]).alias("_p", "_v"))
    label = codes.version_label("_v.versionNumber", "_v.versionMinorNumber")
    return parsed.withColumn("version", label).filter(F.col("version") != "").select(
        key, F.col("_p").cast("bigint").alias("version_no"), F.col("_v.id").alias("version_id"),
        "version", F.coalesce("_v.versionState", F.lit("")).alias("version_state"),
        F.coalesce("_v.publicationDate", F.lit("")).alias("publication_date"),
        F.coalesce("_v.releaseTime", F.lit("")).alias("release_time"),
        F.lit(run_time).alias("download_date"),
        F.concat(F.lit("v"), "version").alias("download_version_folder"),
        F.col("_v.files").alias("files"))


def file_rows(versions: DataFrame, key: str) -> DataFrame:
    """Files of versions, one row each; `idx` counts from one inside a version."""
    exploded = versions.select(key, "version_no", F.posexplode("files").alias("_p", "_f"))
    name = F.coalesce(F.nullif(F.col("_f.dataFile.filename"), F.lit("")), "_f.label", F.lit(""))
    return exploded.withColumn("file_name", name).select(
        key, "version_no", (F.col("_p") + 1).cast("bigint").alias("idx"),
        F.col("_f.dataFile.id").alias("file_id"), "file_name",
        file_extension("file_name").alias("file_type"),
        F.coalesce("_f.restricted", F.lit(False)).alias("restricted"),
        F.coalesce("_f.dataFile.contentType", F.lit("")).alias("content_type"),
        F.coalesce("_f.dataFile.fileAccessRequest", F.lit(False)).alias("file_access_request"))


def failed_documents(projects: DataFrame, time: str) -> DataFrame:
    """Rows whose document gave no key, as failures."""
    return projects.filter("project_key IS NULL").select(
        F.lit(None).cast("bigint").alias("project_key"),
        F.concat(F.lit("No dataset document for "), "global_id").alias("reason"),
        F.lit(time).alias("timestamp"))
