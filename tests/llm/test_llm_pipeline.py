"""The pipeline and the registered queries on the smallest tables."""

import collections
import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))

import check  # noqa: E402
import corpus_pipeline  # noqa: E402

from gleanery import checks  # noqa: E402
from gleanery.llm import queries  # noqa: E402
from gleanery.session import cut_lineage  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(checks, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(checks, "ORACLES", queries.ORACLES)
    assert check.compare(spark, check.connect(FOLDER), FOLDER, name) == ""


def test_each_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def stages(spark):
    docs, out = queries.table(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER), name)
        out[name] = docs
    return out


def test_stages_filter_and_pack(spark):
    source = queries.table(spark, FOLDER, "documents")
    got = stages(spark)
    for name in ("toxicity", "exact_dedup", "simhash_near_dedup", "mixing"):
        assert got[name].columns == source.columns
    clean = {r.doc_id: r.text for r in got["toxicity"].collect()}
    unique = {r.doc_id: r.text for r in got["exact_dedup"].collect()}
    best = {}
    for key, text in clean.items():
        best[text] = max(best.get(text, -1), key)
    assert unique == {key: text for text, key in best.items()}
    apart = {r.doc_id for r in got["simhash_near_dedup"].collect()}
    assert apart <= set(unique) and len(apart) >= 0.5 * len(unique)
    mixed = collections.Counter(r.doc_id for r in got["mixing"].select("doc_id").collect())
    assert set(mixed) <= apart and max(mixed.values()) <= 2
    packed = got["best_fit_packing"]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(mixed)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert full.filter("n <> m or n > 1024").count() == 0
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


def test_stages_on_odd_rows(spark):
    long = " ".join(f"word{i % 900}" for i in range(30_000))
    rows = [(900_000, None, "xx", None, None), (900_001, "", None, "s", 0), (900_002, " \t\n", "xx", "s", 3),
            (900_003, long, "xx", "s", None), (900_004, long, "xx", "t", 1), (900_005, "a b", "xx", "t", 1),
            (900_005, "a b", "xx", "t", 1), (None, "no key", "xx", "s", 1), (900_006, "é 東京 \U0001F600", "xx", "s", 2)]
    source = queries.table(spark, FOLDER, "documents")
    odd = spark.createDataFrame(rows, source.schema)
    clash = {"node": "own", "row": "own", "shingle": "own", "k": "own", "length": "own", "n": "own"}
    docs = source.limit(30).unionByName(odd).withColumns({c: F.lit(v) for c, v in clash.items()})
    told = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = cut_lineage(stage(spark, docs, FOLDER), name)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            kept = [r.doc_id for r in out.collect()]
            assert set(kept) <= told
            if name == "exact_dedup":
                assert kept.count(900_005) == 1 and 900_003 not in kept and 900_004 in kept
        else:
            assert {r.doc_id for r in out.collect()} <= told and out.count() >= 30
        docs = out
    empty = docs_of_nothing = source.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_of_nothing = stage(spark, docs_of_nothing, FOLDER)
        assert docs_of_nothing.count() == 0
        docs_of_nothing = empty
