"""The pipeline as a stream gives what one batch gives."""

import json

from pyspark.sql import functions as F

from gleanery.plans import api_run
from gleanery.schemas import TABLES
from gleanery.streaming import catalogue, ingest

CONFIG = api_run.ApiConfig(terms=["interview"], run_time="now", engine="builtin")


def document(i):
    if i == 5:
        return "<html>busy</html>"
    field = lambda name, value: {"typeName": name, "value": value}
    return json.dumps({"data": {"id": i, "identifier": f"FK2/{i}", "persistentUrl": f"https://doi.org/10.1/{i}", "latestVersion": {
        "license": {"name": "CC0 1.0"}, "metadataBlocks": {"citation": {"fields": [
            field("title", f"Title {i}"), field("keyword", [{"keywordValue": {"value": f"k{i}"}}]),
            field("dsDescription", [{"dsDescriptionValue": {"value": "An interview" if i % 2 else "Numbers"}}]),
            field("author", [{"authorName": {"value": f"A{i}"}}])]}}}}})


def versions(i, n):
    return json.dumps({"data": [{"id": 10 * i + v, "versionNumber": v + 1, "versionMinorNumber": 0, "files": [
        {"label": f"interview {i}.txt", "dataFile": {"id": 100 * i + v, "filename": f"interview {i}.txt"}}]} for v in range(n)]})


def row(kind, **values):
    return {"kind": kind, **values}


def landed_rows():
    """Three batches: hits before their documents, a better hit, versions and fetches that come late."""
    response = lambda term, order, start, ids: row("response", term=term, term_ord=order, start_pos=start, body=json.dumps(
        {"data": {"items": [{"global_id": f"g{i}"} for i in ids], "total_count": len(ids)}}))
    dataset = lambda i: row("dataset", global_id=f"g{i}", body=document(i))
    listed = lambda i, n: row("versions", project_key=int(f"5{i}"), body=versions(i, n), attempt=n)
    fetch = lambda i, v, status, attempt: row("fetch", project_key=int(f"5{i}"), file_id=100 * i + v, http_status=status, attempt=attempt)
    first = [response("b", 2, 0, [1, 2, 3, 4]), dataset(1), listed(1, 1), fetch(1, 0, 503, 1), response("b", 2, 4, [5, 6])]
    second = [dataset(2), dataset(3), dataset(5), listed(3, 2), response("a", 1, 0, [3, 1, 9]), fetch(1, 0, 200, 2), fetch(3, 1, 200, 1)]
    third = [dataset(4), dataset(6), dataset(9), listed(9, 1), listed(2, 1), listed(1, 2), fetch(9, 0, 401, 1)]
    return [first, second, third]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(n) for n in catalogue.LANDED.names) for r in rows], catalogue.LANDED)


def content(spark, root):
    """All stored tables without their ids; files with the version they belong to."""
    tables = {name: catalogue.read(spark, root, name) for name in TABLES}
    owners = tables["project_versions"].select("version_key", "version")
    tables["files"] = tables["files"].join(owners, "version_key", "left")
    for name, df in tables.items():
        assert "id" not in df.columns or df.select("id").distinct().count() == df.count()
    return {name: sorted(map(str, df.drop("id", "version_key").collect())) for name, df in tables.items()}


def test_batches_of_a_stream_equal_one_batch(spark, tmp_path):
    parts = landed_rows()
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    catalogue.create(spark, one, 4)
    catalogue.handle(one, CONFIG, 4)(frame(spark, sum(parts, [])), 0)
    for i, rows in enumerate(parts):
        frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    catalogue.create(spark, many, 4)
    process = catalogue.handle(many, CONFIG, 4)
    for i in range(3):
        source = ingest.landed(spark, f"{tmp_path}/in/{i}", catalogue.LANDED, "*.parquet")
        ingest.run_available(spark, source, lambda df, _, n=i: process(df, n), f"{tmp_path}/checkpoint{i}")
        if i == 0:
            assert {r.global_id for r in catalogue.waiting(spark, many).collect()} == {f"g{n}" for n in (2, 3, 4, 5, 6)}
    want = content(spark, one)
    got = content(spark, many)
    assert {n: (set(got[n]) - set(want[n]), set(want[n]) - set(got[n])) for n in want if got[n] != want[n]} == {}
    assert len(want["projects"]) == 3
    assert len(want["failures"]) == 1 and any("query_string='a'" in r for r in want["projects"])
    assert sum("SUCCEEDED" in r for r in want["files"]) == 2
    # the last batch once more
    ids = sorted(r.id for r in catalogue.read(spark, many, "files").collect())
    process(frame(spark, parts[2]), 2)
    assert content(spark, many) == want
    assert sorted(r.id for r in catalogue.read(spark, many, "files").collect()) == ids
    assert catalogue.waiting(spark, many).count() == 0
