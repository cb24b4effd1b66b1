"""Page trees leave the worker in bounded pieces; a query parses its pages once."""

import pyarrow as pa
from pyspark.sql import functions as F

from gleanery.functions import workers
from gleanery.operators import pages as P

PANEL = ('<div class="panel-title">Methodology</div><div class="panel-heading">'
         "<strong>Related Publications:</strong> {}</div>")


def test_a_batch_is_parsed_in_bounded_pieces():
    pages = ["<p>a</p>"] * 1000 + ["<p>" + "x" * (1 << 19) + "</p>"] * 5 + [None]
    pieces = list(workers._pieces(pa.array(pages)))
    assert [x for piece in pieces for x in piece] == pages
    assert max(map(len, pieces)) <= workers.PIECE_PAGES
    assert max(sum(len(x or "") for x in p) for p in pieces) < 2 * workers.PIECE_CHARS


def test_trees_of_odd_pages(spark):
    html = [None, "", "text", "<a b=1 b=2 C>x</z></a>", "<ul><li>1<li>2</ul>t", "<script>a<b;</script>&amp"]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    rows = {r.page_id: r for r in P.parse_pages(df).collect()}
    assert rows[0].elems == rows[1].elems == [] and rows[2].texts == ["text"] and rows[2].owners == [-1]
    assert [e.attrs for e in rows[3].elems] == [{"b": "2", "c": ""}]
    assert [(e.ord, e.parent, e.last, e.tag, e.t0, e.t1, e.up) for e in rows[4].elems] == [
        (0, -1, 2, "ul", 0, 2, []), (1, 0, 2, "li", 0, 2, [0]), (2, 1, 2, "li", 1, 2, [0, 1])]
    assert rows[5].scripts == ["a<b;"] and rows[5].texts == ["&"]


def test_related_publications_parse_a_page_once(spark):
    said = ["Paper (2001) 10.1234/a", "No related publications for this project", "no Related publications"]
    df = spark.createDataFrame([(i, PANEL.format(x)) for i, x in enumerate(said)], "page_id long, html string")
    found = P.related_publications(P.parse_pages(df), "page_id")
    assert [(r.page_id, r.year, r.doi) for r in found.collect()] == [(0, "2001", "https://doi.org/10.1234/a")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_tree(") == 1
    assert found.filter(F.col("title").isNull()).count() == 0


def trees(pages, reader):
    found = workers._Trees(reader)
    for page in pages:
        found.add(page)
    return found.columns().to_pylist()


class NoReader:
    def read(self, page):
        raise AssertionError(f"not read as plain: {page}")


class OnlyReader(workers._Trees):
    def read(self, *_):
        return False


def test_plain_pages_are_read_as_the_library_reads_them():
    plain = ["", "text", "<p a='&amp;x' b=\"c>d\" e=f q>t &lt; u</p>", "<A HREF='x' href='y'>z<br/><hr></a>x&amp",
             "<!DOCTYPE html><!-- c --><ul><li>1<li>2</ul></z>t", "<script>a<b;</script><STYLE>q</StYle>v", "\xa0<p>&nbsp;"]
    odd = ["<", "<a b = 1>x", "</a b>", "<script>a", "<script>x</ script>y", "<!-- a -- b -->c", "<?p>x", "a < b<p>c",
           "<a\x0bb>x", "<a x=\"1\"y='2'>q", "<![CDATA[x]]>y", "<p>a<b", None]
    only = OnlyReader(workers._reader())
    for page in plain + odd:
        only.add(page)
    assert trees(plain + odd, workers._reader()) == only.columns().to_pylist()
    assert len(trees(plain, NoReader())) == len(plain)


def test_pages_of_few_bytes_are_dealt_to_several_tasks(spark):
    from gleanery.checks.pages import study

    assert study(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 16


def test_variable_count_parses_a_page_once_and_moves_nothing(spark):
    html = ["<script>var b = {\"response\":{\"numFound\":4}}; var a = {\"response\":{\"numFound\":7}};</script>",
            "<p>1 to 20 of 350</p>", "<p>No search results found</p>", "<script>var b = 3;</script>x", None]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    found = P.parse_pages(df).select("page_id", P.variable_count().alias("n"))
    assert dict(found.collect()) == {0: 7, 1: 350, 2: 0, 3: None, 4: None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_tree(") == 1 and "Join" not in plan


def test_facts_of_pages_come_from_the_written_tree(spark):
    from gleanery.plans import page_run

    page = "<title>T</title><meta name=a content=b><script>var title = 'x';</script>"
    routed = spark.createDataFrame([("1", 0, "icpsr", "https://h/1", page)],
                                   "study_id string, page_ord int, page_type string, url string, html string")
    tree = page_run.page_trees(routed, "icpsr")
    facts = page_run.page_facts(routed.filter("false"), "icpsr", tree)  # the pages are not read again
    assert {(r.source, r.name, r.value) for r in facts.collect()} >= {
        ("page", "title", "T"), ("meta", "a", "b"), ("variable", "title", "'x'")}
