"""Which search pages the queries see."""

from pyspark.sql import functions as F

from gleanery.checks import QUERIES, load, pages

FOLDER = "/root/testdata/sf0.001"


def test_link_fallback_sees_every_search_page(spark, monkeypatch):
    load()
    search_page = pages.search_page
    # other ids on the same pages: the pages alone decide
    monkeypatch.setattr(pages, "search_page", lambda s, d: search_page(s, d).withColumn("page_id", F.col("page_id") + 1))
    want = {(r.c_custkey + 1, str(r.c_custkey)) for r in
            spark.read.parquet(f"{FOLDER}/customer.parquet").filter("c_custkey % 3 = 2").collect()}
    got = QUERIES["search_link_fallback"](spark, FOLDER).collect()
    assert want and sorted((r.page_id, r.study_id) for r in got) == sorted(want)
