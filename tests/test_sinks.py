"""Files written and read back."""

import json
import pathlib

from pyspark.sql import functions as F

from gleanery.schemas import TABLES, empty_tables
from gleanery.sources import landing, sinks


def test_records_round_trip(spark, tmp_path):
    path = str(tmp_path / "records")
    df = spark.createDataFrame([("icpsr", "https://doi.org/10.1/x", "1", "T"), ("web", "", "", "A b")],
                               "page_type string, doi string, study_id string, title string")
    sinks.write_records(df, path)
    got = {r.file_stem: r for r in sinks.read_records(spark, path).collect()}
    assert set(got) == {"doi.org_10.1_x", "A_b"} and got["A_b"].page_type == "web"


def test_summary_files(spark, tmp_path):
    path = str(tmp_path / "summary")
    counts = spark.range(1).select(F.lit(3).alias("total_projects"))
    members = spark.createDataFrame([("b1", 1), ("b1", 2), ("b2", 3)], "bucket string, project_id long")
    sinks.write_summary(counts, members, ["*"], path, "now")
    line = next(pathlib.Path(path, "counts").glob("*.json")).read_text()
    assert json.loads(line) == {"total_projects": 3, "searched_terms": ["*"], "generated_at_utc": "now"}
    assert spark.read.json(f"{path}/members").groupBy("bucket").count().count() == 2


def test_search_output_folders(spark, tmp_path):
    path = str(tmp_path / "search")
    sinks.write_search_output(spark.createDataFrame([("*", "u"), ("focus group", "v")], "term string, url string"), path)
    assert {p.name for p in pathlib.Path(path).glob("search=*")} == {"search=all_studies", "search=focus_group"}


def test_tables_round_trip(spark, tmp_path):
    sinks.write_tables(empty_tables(spark), str(tmp_path))
    got = sinks.read_tables(spark, str(tmp_path), TABLES)
    assert all(t.schema.names == TABLES[n].names and t.count() == 0 for n, t in got.items())


def test_dictionary_and_responses(spark, tmp_path):
    (tmp_path / "terms.csv").write_text("list_name,lang,term,ord\na,en,zeta,1\na,en,alpha,2\nb,nl,zeta,3\nb,nl,,4\n")
    assert landing.read_terms(spark, str(tmp_path / "terms.csv")) == ["alpha", "zeta"]
    (tmp_path / "r.json").write_text('{"term":"t","start_pos":0,"body":"{}"}\n')
    assert landing.read_responses(spark, str(tmp_path / "r.json")).first().term == "t"




def test_one_file_for_each_record(spark, tmp_path):
    rows = [(f"s{i}", json.dumps({"i": i})) for i in range(40)]
    rows += [("same", '{"v":1}'), ("same", '{"v":2}'), ("twice", '{"v":"ü"}'), ("twice", '{"v":"ü"}'), (None, "{}"), ("x", None)]
    df = spark.createDataFrame(rows, "file_stem string, document string").repartition(5)
    (tmp_path / "out").mkdir()
    written = sinks.write_record_files(df, str(tmp_path / "out"))
    files = {p.name: p.read_text() for p in (tmp_path / "out").iterdir()}
    assert len(files) == 43 and files["s7.json"] == '{"i": 7}' and files["twice.json"] == '{"v":"ü"}'
    assert sorted(v for k, v in files.items() if k.startswith("same-")) == ['{"v":1}', '{"v":2}']
    assert {pathlib.Path(r.path).name for r in written.collect()} == set(files)
    # once more: the same files
    sinks.write_record_files(df, f"file://{tmp_path}/out")
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == files


def test_a_task_that_fails_publishes_nothing(spark, tmp_path):
    (tmp_path / "out").mkdir()
    bad = spark.range(50).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("file_stem"), F.when(
        F.col("id") < 49, F.lit("{}")).otherwise(F.raise_error(F.lit("lost")).cast("string")).alias("document"))
    try:
        sinks.write_record_files(bad, str(tmp_path / "out"))
        raise AssertionError("should fail")
    except Exception as error:
        assert "lost" in str(error)
    assert not [p for p in (tmp_path / "out").glob("*.json")]
