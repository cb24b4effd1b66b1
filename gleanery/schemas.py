"""Declared schemas: landed JSON, the stored tables and the page facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()

# the value of a field is text, a list of texts or a list of objects
FIELD = _struct(typeName=_S, value=T.VariantType())
SEARCH_RESPONSE = _struct(data=_struct(
    items=T.ArrayType(_struct(global_id=_S)), total_count=_L))
DATASET_DOCUMENT = _struct(data=_struct(
    id=_L, identifier=_S, persistentUrl=_S, publicationDate=_S,
    latestVersion=_struct(
        publicationDate=_S, license=_struct(name=_S),
        metadataBlocks=_struct(citation=_struct(fields=T.ArrayType(FIELD))))))
VERSION_LIST = _struct(data=T.ArrayType(_struct(
    id=_L, versionNumber=_L, versionMinorNumber=_L, versionState=_S, publicationDate=_S,
    releaseTime=_S,
    files=T.ArrayType(_struct(
        label=_S, restricted=_B,
        dataFile=_struct(id=_L, filename=_S, contentType=_S, fileAccessRequest=_B))))))
SEARCH_PAYLOAD = _struct(
    response=_struct(numFound=_L, docs=T.ArrayType(T.VariantType())),
    pagination=_struct(numFound=_L), meta=_struct(total=_L), total=_L)

# the stored catalogue
TABLES = {
    "projects": _struct(
        project_key=_L, project_id=_L, query_string=_S, repository_id=_L, repository_url=_S,
        project_url=_S, title=_S, description=_S, language=_S, doi=_S, upload_date=_S,
        download_date=_S, download_repository_folder=_S, download_project_folder=_S,
        download_method=_S),
    "project_versions": _struct(
        version_key=_L, project_key=_L, version_id=_L, version=_S, version_state=_S,
        publication_date=_S, release_time=_S, download_date=_S, download_version_folder=_S),
    "files": _struct(id=_L, project_key=_L, version_key=_L, file_name=_S, file_type=_S, status=_S),
    "keywords": _struct(id=_L, project_key=_L, keyword=_S),
    "person_role": _struct(id=_L, project_key=_L, name=_S, role=_S),
    "licenses": _struct(id=_L, project_key=_L, license=_S),
    "failures": _struct(id=_L, project_key=_L, reason=_S, timestamp=_S),
}


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The stored tables without rows."""
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


# The unified record, section by section. `any` fields may hold
# anything including null; `flag` fields are booleans, `count` fields integers.
RECORD = {
    "": {
        "text": [
            "schema_version", "source_url", "final_url", "page_title", "page_type", "repository",
            "repository_url", "study_id", "title", "subtitle", "version", "published_date",
            "modified_date", "publisher", "citation", "summary", "abstract", "purpose",
            "study_design", "sample", "universe", "unit_of_analysis", "generated_at_utc",
        ],
        "list": [
            "alternate_titles", "authors", "author_affiliations", "contributors", "distributors",
            "language", "keywords", "topics", "subjects", "funding", "export_formats", "versions",
        ],
        "object": [
            "identifiers", "dates", "relationships", "time", "coverage", "methodology", "access",
            "notes", "variables", "publications", "files", "provenance", "diagnostics",
            "source_specific",
        ],
    },
    "identifiers": {
        "text": [
            "study_id", "source_record_id", "doi", "doi_canonical", "handle", "ark", "isbn",
            "issn",
        ],
        "list": ["other_identifiers"]},
    "dates": {"text": [
        "published_date", "modified_date", "created_date", "deposit_date", "release_date",
    ]},
    "relationships": {"list": [
        "series", "projects", "collections", "related_datasets", "related_materials", "replaces",
        "is_replaced_by", "supplements", "is_supplement_to",
    ]},
    "time": {"list": ["time_method", "collection_dates", "temporal_coverage"]},
    "coverage": {"list": [
        "geographic_coverage", "geographic_unit", "country", "state", "city", "spatial_coverage",
    ]},
    "methodology": {"list": [
        "analysis_units", "kind_of_data", "collection_mode", "sampling_procedure",
        "mode_of_observation", "data_source",
    ]},
    "access": {
        "text": ["license", "license_url", "terms_url", "restrictions"], "list": ["access_notes"],
        "object": ["restricted_data_types"],
        "flag": [
            "has_restricted_files", "has_downloadable_files", "documentation_only_download",
            "access_restricted_data_button", "analyze_online",
        ],
        "any": ["has_public_files", "open_access", "embargoed", "authentication_required"]},
    "access.restricted_data_types": {"flag": [
        "idars", "useAgreement", "restricted", "vde", "enclave",
    ]},
    "notes": {"list": [
        "collection_notes", "collection_changes", "cleaning_notes", "processing_notes",
        "quality_notes",
    ]},
    "variables": {"any": ["count"], "list": ["groups"], "text": ["overview"]},
    "publications": {"any": ["count"], "list": ["items"]},
    "files": {
        "text": ["endpoint", "content_type", "source", "counting_basis"], "any": ["status_code"],
        "list": [
            "filesets", "raw_files", "unique_files", "downloadable_files", "documentation_files",
            "data_files", "setup_files", "other_files",
        ],
        "object": ["summary"]},
    "files.summary": {
        "count": [
            "raw_entry_count", "unique_file_count", "raw_public_entries", "unique_public_files",
            "raw_restricted_or_nonpublic_entries", "unique_restricted_or_nonpublic_files",
            "raw_downloadable_entries", "unique_downloadable_files", "downloadable_public_files",
            "downloadable_documentation_files", "downloadable_data_files",
            "documentation_file_count", "data_file_count", "setup_file_count", "other_file_count",
        ],
        "object": ["raw_formats", "unique_formats", "raw_file_contents", "unique_file_contents"]},
    "provenance": {
        "text": [
            "repository", "repository_url", "page_type", "parser_version", "schema_version",
        ],
        "list": [
            "source_urls_visited", "api_endpoints_called", "html_pages_fetched", "fetch_methods",
        ]},
    "diagnostics": {
        "list": ["fetch_warnings", "field_warnings", "validation_warnings", "metadata_sources"],
        "object": ["completeness"]},
    "diagnostics.completeness": {
        "flag": ["required_fields_present"], "list": ["missing_required_fields"]},
    "source_specific": {
        "any": ["raw_jsonld"],
        "object": ["raw_meta_tags", "raw_page_blocks", "raw_api_payloads", "extra"],
        "list": ["raw_export_signals", "raw_action_signals"]},
}

# Fields a record must fill.
REQUIRED = [
    "schema_version", "source_url", "page_type", "repository", "repository_url", "study_id",
    "title", "generated_at_utc", "identifiers.study_id", "provenance.repository",
    "provenance.repository_url", "provenance.page_type", "provenance.schema_version",
]

# The fields of the entries of a record's lists, by kind.
ENTRIES = {
    "identifier": {"text": ["type", "value"], "url": ["url"]},
    "contributor": {"text": ["name", "role", "affiliation", "orcid"], "url": ["url"]},
    "funding": {"text": ["funder_name", "identifier", "grant_number", "display"], "url": ["url"]},
    "publication": {
        "text": ["title", "journal", "year", "citation"], "doi": ["doi"], "list": ["authors"],
        "url": ["url"]},
    "version": {
        "text": ["version", "published_date", "modified_date", "label"], "url": ["url"],
        "flag": ["is_current"]},
    "file": {
        "text": [
            "title", "file_name", "file_stem", "file_format", "file_extension", "mime_type",
            "file_content", "file_category", "file_description", "checksum", "checksum_type",
            "required_for_bundle", "resource_uuid", "parent_path", "folder_path", "last_modified",
            "display_size", "language", "source", "dataset_identifier", "file_id",
        ],
        "url": ["uri", "download_url", "api_url"],
        "list": ["include_in_bundle", "dataset_format_flags", "terms_of_use"],
        "flag": ["public", "listed_on_public_page", "downloadable", "deliver_download"],
        "number": ["dataset_number", "raw_occurrence_count"]},
    "page": {
        "text": ["page_name", "fetch_method"], "url": ["requested_url", "final_url"],
        "number": ["status_code"]},
    "endpoint": {"text": ["name", "content_type"], "url": ["url"], "number": ["status_code"]},
}
# Which lists of a record hold entries, all others hold texts.
ENTRY_LISTS = {
    "contributors": "contributor", "funding": "funding", "versions": "version",
    "identifiers.other_identifiers": "identifier", "publications.items": "publication",
    "files.raw_files": "file", "files.unique_files": "file", "files.downloadable_files": "file",
    "files.documentation_files": "file", "files.data_files": "file", "files.setup_files": "file",
    "files.other_files": "file", "provenance.html_pages_fetched": "page",
    "provenance.api_endpoints_called": "endpoint",
}
# Fields of kind `any` that are numbers or texts; the others are tri-state flags.
ANY_NUMBERS = ["files.status_code", "variables.count", "publications.count"]
ANY_TEXTS = ["source_specific.raw_jsonld"]


def entry_type(kind: str) -> T.StructType:
    """The type of one entry; a fileset is the one that holds entries itself."""
    if kind == "fileset":
        return _struct(dataset_number=_L, identifier=_S, title=_S, description=_S, file_count=_L,
                       files=T.ArrayType(entry_type("file")))
    of = {"text": _S, "url": _S, "doi": _S, "list": T.ArrayType(_S), "flag": _B, "number": _L}
    return _struct(**{n: of[k] for k, names in ENTRIES[kind].items() for n in names})


def field_type(path: str, kind: str) -> T.DataType:
    """The type of one declared field of a record."""
    if path == "files.filesets":
        return T.ArrayType(entry_type("fileset"))
    if path in ENTRY_LISTS:
        return T.ArrayType(entry_type(ENTRY_LISTS[path]))
    if kind == "object":
        if path in RECORD:
            return record_type(path)
        return T.MapType(_S, _L if path.startswith("files.") else _S)
    if kind == "any":
        return _L if path in ANY_NUMBERS else _S if path in ANY_TEXTS else _B
    return {"text": _S, "list": T.ArrayType(_S), "flag": _B, "count": _L}[kind]


def record_fields(section: str = "") -> list[tuple[str, str]]:
    """(path, kind) of the fields of a section, in their declared order."""
    return [(f"{section}.{n}" if section else n, kind)
            for kind, names in RECORD[section].items() for n in names]


def record_type(section: str = "") -> T.StructType:
    """The declared shape as a type, every section in it."""
    return T.StructType([T.StructField(path.split(".")[-1], field_type(path, kind))
                         for path, kind in record_fields(section)])
