"""Writers: catalogue tables, records, summaries, search output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import safe_file
from gleanery.operators.record import file_stem_of
from gleanery.session import cut_lineage


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Each table as parquet under its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def read_tables(spark: SparkSession, root: str, schemas: dict) -> dict[str, DataFrame]:
    return {name: spark.read.schema(s).parquet(f"{root}/{name}") for name, s in schemas.items()}


def record_documents(records: DataFrame) -> DataFrame:
    """One JSON document per record with the file stem it is known by."""
    return records.select(
        "page_type", file_stem_of(records).alias("file_stem"),
        F.to_json(F.struct(*records.columns)).alias("document"))


def write_records(records: DataFrame, path: str) -> None:
    """Record documents as JSON lines, partitioned by page type."""
    record_documents(records).write.mode("overwrite").partitionBy("page_type").json(path)


def write_record_files(documents: DataFrame, folder: str, stem: str = "file_stem",
                       document: str = "document") -> DataFrame:
    """(file_stem, path): each document as a file `stem.json` of its own in a folder tasks can open.

    Documents of one stem get the beginning of their digest behind it, equal
    ones are one file. Tasks write under names of their attempt and list what
    they wrote; only when all have ended, listed files are moved into place, in
    a second job that may run again. A killed task leaves nothing in the folder.
    """
    root = folder.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    rows = documents.select(F.col(stem).alias("file_stem"), F.col(document).alias("document")).filter(
        "file_stem IS NOT NULL AND document IS NOT NULL").withColumn("digest", F.sha2("document", 256))
    several = rows.groupBy("file_stem").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter(
        "a <> b").select("file_stem", F.lit(True).alias("several"))
    named = rows.join(several, "file_stem", "left").select("document", F.when(
        F.col("several"), F.concat("file_stem", F.lit("-"), F.substring("digest", 1, 16))).otherwise(
        F.col("file_stem")).alias("file_stem"))

    def place(path):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def write(batches):
        import uuid

        import pyarrow as pa

        system, base = place(staging)
        base = f"{base}/{uuid.uuid4().hex}"
        made = False
        for batch in batches:
            stems, kept = [], []
            for name, text in zip(batch["file_stem"].to_pylist(), batch["document"].to_pylist()):
                if not made:
                    system.create_dir(base)
                    made = True
                path = f"{base}/{len(stems)}-{uuid.uuid4().hex}.json"
                with system.open_output_stream(path) as out:
                    out.write(text.encode())
                stems.append(name)
                kept.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(kept, pa.string())],
                                             names=["file_stem", "staged"])

    def move(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, base = place(root)
        for batch in batches:
            paths = [f"{base}/{name}.json" for name in batch["file_stem"].to_pylist()]
            for old, new in zip(batch["staged"].to_pylist(), paths):
                if system.get_file_info(old).type != fs.FileType.NotFound:  # else moved by an earlier attempt
                    system.move(old, new)
            yield pa.RecordBatch.from_arrays([batch["file_stem"], pa.array(paths, pa.string())],
                                             names=["file_stem", "path"])

    listed = cut_lineage(named.mapInArrow(write, "file_stem string, staged string"), "staged")
    written = cut_lineage(listed.mapInArrow(move, "file_stem string, path string"), "written")
    system, base = place(staging)
    from pyarrow import fs

    if system.get_file_info(base).type != fs.FileType.NotFound:
        system.delete_dir(base)
    return written.distinct()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Saved record documents; lines whose document is no object are left out."""
    rows = spark.read.schema("file_stem string, document string, page_type string").json(path)
    parsed = rows.withColumn("record", F.try_parse_json("document"))
    return parsed.filter(F.schema_of_variant("record").startswith("OBJECT"))


def write_summary(counts: DataFrame, members: DataFrame, terms: list[str], path: str,
                  run_time: str) -> None:
    """Run summary: one JSON object with the counters, and the bucket members beside it.

    The counters are one row, so one file is right; the member lists grow with
    the run and stay a partitioned table.
    """
    (counts.withColumn("searched_terms", F.array(*map(F.lit, terms)).cast("array<string>"))
     .withColumn("generated_at_utc", F.lit(run_time))
     .coalesce(1).write.mode("overwrite").json(f"{path}/counts"))
    members.write.mode("overwrite").partitionBy("bucket").json(f"{path}/members")


def write_search_output(studies: DataFrame, path: str, term: str = "term") -> None:
    """Studies of each search as JSON lines, one folder per search."""
    name = F.when(F.col(term) == "*", F.lit("all_studies")).otherwise(safe_file(term, "search"))
    studies.withColumn("search", name).write.mode("overwrite").partitionBy("search").json(path)
