"""Incremental ingest: landed files as a stream, each batch through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.operators import refresh
from gleanery.operators.dedupe import first_wins
from gleanery.session import cut_lineage

ORDER = ["term_ord", "start_pos", "pos"]


def merge_first_hits(
    spark: SparkSession, path: str, schema, batch: DataFrame, buckets: int = refresh.BUCKETS
) -> None:
    """Merge one batch of hits into the stored first hits.

    A new hit may come earlier in term order than the stored one, so the first
    hit is decided again over both. Only buckets of ids in the batch are read
    and rewritten; the batch is reduced to one row per id before that.
    """
    fresh = cut_lineage(first_wins(batch.select(*schema.names), ["project_key"], ORDER), "batch")
    keys = fresh.select("project_key")
    ids = refresh.touched_buckets(keys, buckets)
    stored = refresh.read_table(spark, path, schema, ids).join(keys, "project_key", "left_semi")
    best = first_wins(stored.unionByName(fresh.select(*schema.names)), ["project_key"], ORDER)
    refresh.refresh_path(spark, path, schema, keys, best.select(*schema.names), buckets)


def append_first_hits(path: str, schema, batch: DataFrame, batch_id: int) -> None:
    """Add one batch of hits to a log, reduced to one row per id.

    A batch writes its own rows and nothing else, however scattered its ids are.
    A batch that is run again replaces what it wrote before.
    """
    fresh = first_wins(batch.select(*schema.names), ["project_key"], ORDER)
    fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_first_hits(spark: SparkSession, path: str, schema) -> DataFrame:
    """The first hit of each id over all batches of a log."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*")
    return first_wins(rows.select(*schema.names), ["project_key"], ORDER)


def compact(spark: SparkSession, path: str, target: str, schema) -> None:
    """Write the first hits of a log as the only batch of a new one, a job of its own.

    Readers and the stream go over to `target` afterwards; the batches that
    arrive there later are added to it as before.
    """
    read_first_hits(spark, path, schema).write.mode("errorifexists").parquet(f"{target}/batch=-1")


def run_available(
    spark: SparkSession, source: DataFrame, handle: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> None:
    """Process everything landed so far and stop; finished files are not read again.

    `handle` gets each batch and its number, which is the same when it is run again.
    """
    query = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, folder: str, schema, pattern: str, files: int = 1000) -> DataFrame:
    """Stream over the parquet files of a landing folder."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files).parquet(folder)
    )


