"""The near-duplicate stage against a brute-force join of shingle sets."""

import collections
import pathlib
import random
import re
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from gleanery.llm import near_dedup, queries, tokens  # noqa: E402
from gleanery.llm.common import WORD_RE  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_shingles(text):
    words = WORD_RE.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def slow_stay(rows):
    """Ids that stay, and the pairs of different texts that are alike."""
    held, holders, root = {k: slow_shingles(t) for k, t in rows}, collections.defaultdict(list), {}
    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x
    pairs = set()
    for key in sorted(held):
        near = collections.Counter(o for s in held[key] for o in holders[s])
        for other, both in near.items():
            if both / (len(held[key]) + len(held[other]) - both) >= 0.8:
                pairs.add((other, key))
                a, b = find(key), find(other)
                root[max(a, b)] = min(a, b)
        for s in held[key]:
            holders[s].append(key)
    return {k for k in held if find(k) == k}, pairs


def edited(rng, words, most):
    words = list(words)
    for _ in range(rng.randint(0, most)):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
    cut = rng.randint(0, 6)
    return words[cut:] if rng.random() < 0.5 else words + [f"t{i}" for i in range(cut)]


def near_copies(seed):
    rng, texts = random.Random(seed), [None, "", " \t", "a b", "A  b", "a b c d e", "é É x y z w"]
    common = [f"c{i}" for i in range(30)]
    for group in range(25):
        words = [f"g{group}w{rng.randrange(80)}" for _ in range(rng.choice([5, 9, 40, 150, 300]))]
        words = words + common if group % 2 else words
        texts += [" ".join(edited(rng, words, max(1, len(words) // 30)))
                  for _ in range(rng.choice([2, 5, 30]))]
    # one shingle in nine differs: the similarity is 0.8 and counts
    texts += [" ".join(f"e{i}" for i in range(13)), " ".join([f"e{i}" for i in range(12)] + ["x"])]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("bounds", [(20_000, 65_536), (40, 5), (1, 1)])
def test_stage_equals_a_brute_force_join(spark, monkeypatch, bounds):
    monkeypatch.setattr(near_dedup, "SAMPLE_ROWS", bounds[0])
    monkeypatch.setattr(near_dedup, "MOST_FREQUENT", bounds[1])
    rows = near_copies(bounds[0])
    want, pairs = slow_stay(rows)
    assert len(pairs) > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(want)


def test_stage_on_the_documents_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = corpus_pipeline.drop_copies(spark, docs, "")
    want, pairs = slow_stay([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert pairs
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_rows_without_a_key_and_copies(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(10, words), (4, words), (7, words + " tail"), (None, words), (None, None), (1, "lonely words")]
    stay = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = [r.doc_id for r in stay.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4] and ids.count(None) == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.drop_near_duplicates(empty).collect() == []


def test_the_stage_links_by_simhash(spark, monkeypatch):
    """Near copies come through SimHash, checked on their sets; the exact step only completes them."""
    words = [f"w{i}" for i in range(400)]
    near, far = " ".join(words + ["end"]), " ".join(words[:360] + ["x"] * 5)
    docs = spark.createDataFrame([(1, " ".join(words)), (2, near), (3, far), (4, "other words here")],
                                 "doc_id long, text string")
    prints = {k: near_dedup.simhash.of_hashes(near_dedup.shingles(t)) for k, t in docs.collect()}
    assert bin((prints[1] ^ prints[2]) & (1 << 64) - 1).count("1") <= 4
    assert near_dedup.simhash.of_hashes(near_dedup.shingles("a b", 4)) & (1 << 64) - 1 == \
        near_dedup.simhash.fingerprint("a b", 4)
    asked, checked, links = [], [], near_dedup.simhash.links
    monkeypatch.setattr(near_dedup.simhash, "links", lambda p, *a: asked.append(p.count()) or links(p, *a))
    of_links = near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda p: checked.append(p.count()) or of_links(p))
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert asked == [len(set(prints.values()))] and checked[0] >= 1
    assert {r.doc_id for r in kept} == {1, 4}


def test_fingerprints_of_the_stage_are_those_of_the_operator(spark):
    """Repeats count and texts without words have zero."""
    rows = ["", " \t", "a b", "A b", "x y z u v " * 9 + "one two three four five six seven", "k " * 40 + "end of it"]
    texts = spark.createDataFrame(list(enumerate(rows)), "node long, text string")
    found = near_dedup.cells(texts, 5, 0.8).filter("pos = 0").select("node", "fp").collect()
    assert {r.node: r.fp & (1 << 64) - 1 for r in found} == {
        i: near_dedup.simhash.fingerprint(text, 5) for i, text in enumerate(rows)}


def test_fingerprints_are_spread_after_an_aggregation(spark):
    """They become many rows each; after a distinct() Spark put all of them into one task."""
    prints = spark.range(500).select((F.col("id") * 7919).alias("fp")).distinct()
    dealt = near_dedup.simhash.spread(prints)
    assert dealt.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt.count() == 500


def test_stages_bound_their_batches(spark):
    """Also in a session that was built elsewhere; a lower bound stays."""
    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.createDataFrame([], "doc_id long, text string")
    before = spark.conf.get(key)
    try:
        for given, want in (("10000", "2000"), ("0", "2000"), ("300", "300")):
            spark.conf.set(key, given)
            corpus_pipeline.drop_near_copies(spark, docs, "")
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


def test_a_worker_keeps_nothing_of_other_operators(monkeypatch):
    """The encoder that packing leaves in a worker goes when near-dedup runs there, and its own
    freed memory when the task is over."""
    class Texts:
        mapInArrow = staticmethod(lambda code, schema: code)

    given = []
    monkeypatch.setattr(pa, "default_memory_pool", lambda: type(
        "Pool", (), {"release_unused": lambda self: given.append(tokens.encoder.cache_info().currsize)})())
    tokens.encoder(queries.vocabulary())
    assert tokens.encoder.cache_info().currsize == 1
    batch = pa.RecordBatch.from_pydict({"node": [1], "text": ["a b c"]})
    code = near_dedup.shingle_sets(Texts(), 5)
    out = list(code(iter([batch])))
    assert out[0].to_pydict() == {"node": [1], "held": [near_dedup.shingles("a b c").tolist()]}
    assert tokens.encoder.cache_info().currsize == 0 and given == [0]


def test_joins_of_cells_never_pass_the_driver(spark, monkeypatch):
    joins = []

    def watched(df, purpose="stage"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins.extend(re.findall(r"(\w+Join) \[(?:shingle|cell)#", plan))
        return kept(df, purpose)

    kept = near_dedup.cut_lineage
    monkeypatch.setattr(near_dedup, "cut_lineage", watched)
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words[1:])), (3, " ".join(words[:-1])), (4, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect()} == {
        (1, 1), (2, 1), (3, 1), (4, 4)}
    assert set(joins) == {"SortMergeJoin"}
