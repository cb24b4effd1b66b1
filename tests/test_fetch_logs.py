"""Fetch logs with several attempts, documents that landed twice, keys of failure rows."""

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.operators import files
from gleanery.plans import api_run, page_run

LOG = "study_id string, safe_name string, status string, attempt int"


def test_a_file_tried_twice_is_one_file(spark):
    found = spark.createDataFrame([("s", "a b/c.pdf"), ("s", "x"), ("t", "x")], "study_id string, file_name string")
    log = spark.createDataFrame([("s", "a b_c.pdf", "FAILED_TOO_LARGE", 2), ("s", "a b_c.pdf", "SUCCEEDED", 1),
                                 ("s", "x", "SUCCEEDED", 5), ("s", "x", "FAILED_TOO_LARGE", 4), ("s", "x", "SUCCEEDED", 5)], LOG)
    got = {(r.study_id, r.safe_name): r.status for r in files.file_states(found, log, ["study_id"]).collect()}
    assert got == {("s", "a b_c.pdf"): "FAILED_TOO_LARGE", ("s", "x"): "SUCCEEDED", ("t", "x"): "FAILED_SERVER_UNRESPONSIVE"}
    assert files.file_states(found, log, ["study_id"]).count() == 3
    # without an order a success counts over a failure
    assert {r.safe_name: r.status for r in files.last_states(log.drop("attempt"), ["safe_name"]).collect()} == {
        "a b_c.pdf": "SUCCEEDED", "x": "SUCCEEDED"}
    assert files.last_states(log.limit(0), ["safe_name"]).collect() == []


def test_a_dataset_landed_twice_is_one_document(spark):
    rows = [("d", "old", 1), ("d", "new", 2), ("e", "only", 1)]
    landed = spark.createDataFrame(rows, "global_id string, body string, landed_at int")
    assert {r.global_id: r.body for r in api_run.last_landed(landed).collect()} == {"d": "new", "e": "only"}
    assert api_run.last_landed(landed.drop("landed_at")).count() == 2


def folder(names):
    rows = "".join(f'<tr><td><a href="?path={n}&type=file">{n}</a></td><td>x</td><td>1 MB</td><td>d</td></tr>' for n in names)
    return f'<html><title>Study</title><body><table class="table"><tbody>{rows}</tbody></table></body></html>'


def test_page_runs_key_files_by_uri_and_failures_by_project(spark):
    site = "https://www.datalumos.org/datalumos/project/{}/version/V1/view"
    pages = spark.createDataFrame([
        (site.format(7), 0, folder(["/one/data.csv", "/two/data.csv"])),
        (site.format(8), 0, "<html><body>no title</body></html>"), ("https://elsewhere.example.org/x", 0, "<p>x</p>")],
        "url string, page_ord int, html string")
    routed = page_run.route(pages)
    run = page_run.evaluate(routed, "datalumos", 15, "studies", "now", "*")
    assert run["files"].filter("file_name = 'data.csv'").count() == 2
    failed = run["failures"].collect()
    assert [(r.project_key, "Missing required field: title" in r.reason) for r in failed] == [(1538, True)]
    run["projects"] = run["projects"].withColumn("qualitative", F.lit(True))
    uris = sorted(r.uri for r in run["files"].collect())
    fetched = spark.createDataFrame([("7", "data.csv", uris[0], "SUCCEEDED", 2), ("7", "data.csv", uris[0], "FAILED_TOO_LARGE", 1),
                                     ("7", "data.csv", uris[1], "FAILED_TOO_LARGE", 1)],
                                    "study_id string, file_name string, uri string, status string, attempt int")
    _, new = page_run.catalogue(run, fetched, "now", more_failures=page_run.unsupported(routed, "now"))
    assert sorted(r.status for r in new["files"].collect()) == ["FAILED_TOO_LARGE", "SUCCEEDED"]
    rows = new["failures"].collect()
    assert sorted(r.id for r in rows) == [1, 2] and {r.project_key for r in rows} == {1538, None}
    assert any("elsewhere" in r.reason for r in rows)
    assert vocab.PAGE_TYPES["datalumos"] == 3
