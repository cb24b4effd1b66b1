"""The whole JSON pipeline as a stream: landed rows of all kinds to the stored catalogue.

A batch holds search responses, dataset documents, version lists and fetch logs
in any mixture. It is added to the log of its kind, and every dataset that the
batch says something about is evaluated again from all that has landed for it:
a hit waits until its document is there, an earlier hit of a later batch still
gives a project its search term. The stored tables are then refreshed for these
projects alone. A batch that is run again replaces its own log and gives the same
rows under the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators import dedupe, documents, refresh
from gleanery.plans import api_run
from gleanery.schemas import TABLES
from gleanery.session import cut_lineage

_S, _L = T.StringType(), T.LongType()

#: A landed row: what it is, and what rows of its kind say. `attempt` tells which of several
#: fetches, documents or version lists of one key is the last; without it the batch does.
LANDED = T.StructType([
    T.StructField("kind", _S), T.StructField("term", _S), T.StructField("term_ord", _L),
    T.StructField("start_pos", _L), T.StructField("global_id", _S), T.StructField("project_key", _L),
    T.StructField("file_id", _L), T.StructField("http_status", T.IntegerType()),
    T.StructField("attempt", _L), T.StructField("body", _S)])
HIT = "global_id string, term string, term_ord long, start_pos long, pos long"
DATASET = "global_id string, body string, landed_at long, project_key long"
VERSIONS = "project_key long, body string, landed_at long"
FETCH = "project_key long, file_id long, http_status int, attempt long"
LOGS = {"hit": HIT, "dataset": DATASET, "versions": VERSIONS, "fetch": FETCH}
#: Ids of a batch begin behind its number times this.
ID_RANGE = 1 << 40


def create(spark: SparkSession, root: str, buckets: int = refresh.BUCKETS) -> None:
    """The stored tables, empty, and empty logs."""
    for name, schema in TABLES.items():
        if name != "failures":
            refresh.create_table(spark.createDataFrame([], schema), f"{root}/tables/{name}", buckets)
    spark.createDataFrame([], TABLES["failures"]).write.parquet(f"{root}/tables/failures/batch=-1")
    for kind, schema in LOGS.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/landed/{kind}/batch=-1")


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table."""
    if name == "failures":
        return _log(spark, f"{root}/tables/failures", TABLES[name])
    return refresh.read_table(spark, f"{root}/tables/{name}", TABLES[name])


def _log(spark: SparkSession, path: str, schema) -> DataFrame:
    columns = schema.names if isinstance(schema, T.StructType) else [c.split()[0] for c in schema.split(", ")]
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*").select(*columns)


def landed(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All that has landed of a kind."""
    return _log(spark, f"{root}/landed/{kind}", LOGS[kind])


def waiting(spark: SparkSession, root: str) -> DataFrame:
    """The first hits whose document has not landed yet."""
    hits = dedupe.first_wins(landed(spark, root, "hit"), ["global_id"], ["term_ord", "start_pos", "pos"])
    return hits.join(landed(spark, root, "dataset").select("global_id"), "global_id", "left_anti")


def handle(root: str, config: api_run.ApiConfig, buckets: int = refresh.BUCKETS):
    """The function that `ingest.run_available` calls with each batch and its number."""

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = cut_lineage(batch, "batch")
        of = lambda kind: batch.filter(F.col("kind") == kind)
        keyed = documents.project_rows(
            of("dataset").select("global_id", "body", F.coalesce("attempt", F.lit(number)).cast("long").alias("landed_at"), "term",
                                 F.col("body").alias("whole")),
            "body", "term", config.repository_id, config.repository_url, config.folder, config.method, config.run_time)
        new = {
            "hit": documents.search_hits(of("response").select("term", "term_ord", "start_pos", "body"), "body").select(
                "global_id", "term", "term_ord", "start_pos", "pos"),
            "dataset": keyed.select("global_id", F.col("whole").alias("body"), "landed_at", "project_key"),
            "versions": of("versions").select("project_key", "body", F.coalesce("attempt", F.lit(number)).cast("long").alias(
                "landed_at")),
            "fetch": of("fetch").select("project_key", "file_id", "http_status", "attempt"),
        }
        for kind, rows in new.items():
            rows.write.mode("overwrite").parquet(f"{root}/landed/{kind}/batch={number}")
        known = landed(spark, root, "dataset")
        mine = {kind: _log_of(spark, root, kind, number) for kind in LOGS}
        spoken = mine["versions"].select("project_key").unionByName(mine["fetch"].select("project_key")).distinct()
        touched = cut_lineage(
            mine["hit"].select("global_id").unionByName(mine["dataset"].select("global_id"))
            .unionByName(known.join(spoken, "project_key", "left_semi").select("global_id")).distinct(), "touched")
        there = known.join(touched, "global_id", "left_semi")
        # a hit whose document has not landed waits
        hits = landed(spark, root, "hit").join(there.select("global_id").distinct(), "global_id", "left_semi")
        hits = dedupe.first_wins(hits, ["global_id"], ["term_ord", "start_pos", "pos"])
        keys = cut_lineage(there.select("project_key").filter("project_key IS NOT NULL").distinct(), "keys")
        lists = landed(spark, root, "versions").join(keys, "project_key", "left_semi").groupBy("project_key").agg(
            F.max_by("body", F.struct("landed_at", "body")).alias("body"))
        log = landed(spark, root, "fetch").join(keys, "project_key", "left_semi")
        run = api_run.evaluate(hits, there.select("global_id", "body", "landed_at"), lists, config)
        _, rows = api_run.catalogue(run, log.drop("project_key"), {name: number * ID_RANGE for name in TABLES})
        for name, df in rows.items():
            if name == "failures":
                df.write.mode("overwrite").parquet(f"{root}/tables/failures/batch={number}")
            else:
                refresh.refresh_path(spark, f"{root}/tables/{name}", TABLES[name], keys, cut_lineage(df, name), buckets)

    return process


def _log_of(spark: SparkSession, root: str, kind: str, number: int) -> DataFrame:
    return spark.read.schema(LOGS[kind]).parquet(f"{root}/landed/{kind}/batch={number}")
