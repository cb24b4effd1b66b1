"""Record validation as data-quality columns and a violations table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import schemas
from gleanery.functions.text import text_or_null
from gleanery.functions.urls import canonical_doi


def _yes(c) -> Column:
    """True only where a tri-state flag is set."""
    return F.col(c).eqNullSafe(F.lit(True))


def _no(c) -> Column:
    return F.col(c).eqNullSafe(F.lit(False))


def _differ(a: Column, b: Column) -> Column:
    """Both filled and not equal."""
    return F.coalesce(F.nullif(a, F.lit("")) != F.nullif(b, F.lit("")), F.lit(False))


def _messages(*rules: tuple[Column, Column | str]) -> Column:
    found = [F.when(test, F.lit(m) if isinstance(m, str) else m) for test, m in rules]
    return F.array_distinct(F.array_compact(F.array(*found)))


def identifier_rules(doi, nested_doi, canonical, study, nested_study) -> list:
    top = canonical_doi(doi)
    return [
        (_differ(top, canonical_doi(nested_doi)),
         "Top-level doi and identifiers.doi differ after normalization."),
        (_differ(top, canonical_doi(canonical)),
         "Top-level doi and identifiers.doi_canonical differ after normalization."),
        (_differ(text_or_null(study), text_or_null(nested_study)),
         "Top-level study_id and identifiers.study_id differ."),
    ]


def doi_rules(doi) -> list:
    """A DOI that normalising could not bring to canonical form."""
    value = F.nullif(canonical_doi(doi), F.lit(""))
    return [(F.coalesce(~value.startswith("https://doi.org/"), F.lit(False)),
             "DOI is present but is not in canonical https://doi.org/... form.")]


def access_rules(restricted, any_type, button, opened) -> list:
    return [
        (_yes(restricted) & ~_yes(any_type),
         "access.has_restricted_files is True but no restricted_data_types flag is True."),
        (_yes(button) & _no(restricted),
         "Restricted-data action button was detected while access.has_restricted_files is False."),
        (_yes(opened) & _yes(restricted),
         "Record indicates both open access and restricted files."),
    ]


def publication_rules(count, items) -> list:
    return [(F.coalesce(F.col(count) < F.col(items), F.lit(False)),
             "publications.count is smaller than the number of parsed publications.items.")]


def date_rules(published, nested_published, modified=None, nested_modified=None) -> list:
    rules = [(_differ(text_or_null(published), text_or_null(nested_published)),
              "Top-level published_date and dates.published_date differ.")]
    if modified is not None:
        rules.append((_differ(text_or_null(modified), text_or_null(nested_modified)),
                      "Top-level modified_date and dates.modified_date differ."))
    return rules


def counter_rules(declared: dict[str, str], actual: dict[str, tuple[str, str]]) -> list:
    """Declared file counters against list sizes; a missing counter is not checked.

    `actual` maps a counter to the list it counts and the column with its size.
    """
    return [
        (F.coalesce(F.col(column) != F.col(actual[name][1]), F.lit(False)),
         F.concat(F.lit(f"files.summary.{name}="), F.col(column).cast("string"),
                  F.lit(f" but len(files.{actual[name][0]})="),
                  F.col(actual[name][1]).cast("string"), F.lit(".")))
        for name, column in declared.items()
    ]


def validate(df: DataFrame, required: dict[str, str], warnings: list) -> DataFrame:
    """Add missing_required_fields, errors, warnings and valid.

    `required` maps a field name to the column that holds it; `warnings` is a
    list of (condition, message) rules.
    """
    missing = F.array_compact(F.array(*[
        F.when(text_or_null(F.col(c).cast("string")).isNull(), F.lit(name))
        for name, c in required.items()]))
    return (
        df.withColumn("missing_required_fields", missing)
        .withColumn("errors", F.transform(
            "missing_required_fields", lambda f: F.concat(F.lit("Missing required field: "), f)))
        .withColumn("warnings", _messages(*warnings))
        .withColumn("valid", F.size("errors") == 0)
        .withColumn("required_fields_present", F.size("missing_required_fields") == 0)
    )


def violations(checked: DataFrame, key: str) -> DataFrame:
    """Every error and warning as one row."""
    rows = F.explode(F.concat(
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("level"), m.alias("message"))),
        F.transform("warnings",
                    lambda m: F.struct(F.lit("warning").alias("level"), m.alias("message")))))
    return checked.select(key, rows.alias("v")).select(key, "v.*")


def split_valid(checked: DataFrame, key, time: str) -> tuple[DataFrame, DataFrame]:
    """Valid records, and the others as failure rows under `key`, the key of their project."""
    bad = checked.filter(~F.col("valid")).select(
        (F.col(key) if isinstance(key, str) else key).cast("bigint").alias("project_key"),
        F.concat(F.lit("Metadata record validation failed: "), F.array_join("errors", "; "))
        .alias("reason"), F.lit(time).alias("timestamp"))
    return checked.filter("valid"), bad


# ---------------------------------------------------------------- shape of raw records

_EXPECTED = {"text": "str", "list": "list", "object": "dict", "flag": "bool", "count": "int"}


def _type_name(value: Column) -> Column:
    """Kind of a JSON value; NULL where the key is missing."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(kind == "VOID", F.lit("NoneType")).when(kind == "STRING", F.lit("str"))
        .when(kind == "BOOLEAN", F.lit("bool")).when(kind == "BIGINT", F.lit("int"))
        .when(kind.startswith("ARRAY"), F.lit("list")).when(kind.startswith("OBJECT"), F.lit("dict"))
        .otherwise(F.lit("float"))
    )


def shape_mismatches(records: DataFrame, key: str, record: str) -> DataFrame:
    """Where a raw record (variant) departs from the declared shape: rows path, problem, level.

    Missing keys are warnings, wrong kinds are errors. Null is accepted for
    scalars; keys below a missing or wrong parent are not reported again.
    """
    sections = []
    for section, kinds in schemas.RECORD.items():
        expected = F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit(_EXPECTED.get(kind, "any")).alias("expected"))
            for kind, names in kinds.items() for n in names])
        # a section that is missing or no object gives NULL and is left out here
        values = F.try_variant_get(record, f"$.{section}" if section else "$", "map<string,variant>")
        sections.append(F.struct(F.lit(f"{section}." if section else "").alias("prefix"),
                                 expected.alias("fields"), values.alias("values")))

    def departs(m):
        expected, actual = m["expected"], m["actual"]
        fits = (
            (expected == "any") | (actual == expected)
            | (expected.isin("str", "bool", "int") & (actual == "NoneType"))
            | ((expected == "int") & (actual == "bool")))
        return actual.isNull() | ~fits

    # compared inside the row: only what departs becomes a row
    def compared(s):
        fields = F.transform(s["fields"], lambda f: F.struct(
            F.concat(s["prefix"], f["name"]).alias("path"), f["expected"].alias("expected"),
            _type_name(F.try_element_at(s["values"], f["name"])).alias("actual")))
        return F.filter(fields, departs)

    there = F.filter(F.array(*sections), lambda s: s["values"].isNotNull())
    rows = records.select(key, F.explode(F.flatten(F.transform(there, compared))).alias("m"))
    missing = F.col("m.actual").isNull()
    return rows.select(
        key, F.col("m.path").alias("path"),
        F.when(missing, F.lit("missing key")).otherwise(F.concat(
            F.lit("expected "), "m.expected", F.lit(", got "), "m.actual")).alias("problem"),
        F.when(missing, F.lit("warning")).otherwise(F.lit("error")).alias("level"))


def entry_shapes(records: DataFrame, key: str, record: str) -> DataFrame:
    """Contributors and funding entries that are no objects, and such fields that are no lists."""
    out = None
    for field in ("contributors", "funding"):
        value = F.try_variant_get(record, f"$.{field}", "variant")
        items = F.try_variant_get(record, f"$.{field}", "array<variant>")
        rows = records.select(key, _type_name(value).alias("kind"), items.alias("items"))
        whole = rows.filter("kind NOT IN ('list', 'NoneType')").select(
            key, F.lit(f"Field '{field}' must be a list.").alias("message"))
        each = rows.select(key, F.posexplode("items").alias("i", "v")).filter(
            _type_name(F.col("v")) != "dict").select(key, F.concat(
                F.lit(f"Field '{field}["), F.col("i").cast("string"),
                F.lit("]' must be a dict.")).alias("message"))
        part = whole.unionByName(each)
        out = part if out is None else out.unionByName(part)
    return out
