"""Nearest neighbours and toxicity: recall, exact scores, brute-force inference."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import ann, toxicity

VEC = "vec_id long, embedding array<float>"


def vectors(spark, rows):
    return spark.createDataFrame(rows, VEC)


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16)) * 3
    data = (centres[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    data[100:1500] = data[100] + (rng.normal(size=(1400, 16)) * 0.001).astype(np.float32)  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    got = ann.search(vectors(spark, rows), lambda i: i % 100 == 0, k=10).collect()
    wide, hits, n = data.astype(np.float64), 0, 0
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 6000, 100))
    for query, found in by_query.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        gap = np.sqrt(((wide - wide[query]) ** 2).sum(1))
        for r in found:
            assert r.vec_id != query and r.score == pytest.approx(gap[r.vec_id], rel=1e-12)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        gap[query] = np.inf
        hits += len({r.vec_id for r in found} & set(np.argsort(gap, kind="stable")[:10].tolist()))
        n += 10
    assert hits / n >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (100, [2.0]*2), (None, [1.0, 1.0]), (8, [1.0, 0.0]),
            (9, [1.0, 2.0, 3.0]), (10, [])]
    df = vectors(spark, rows).withColumns({c: F.lit("own") for c in ("list", "shard", "vec", "lists")})
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in
           ann.search(df, lambda i: i % 100 == 0, k=10).collect()]
    root = round(2 ** 0.5, 9)
    assert sorted(got) == sorted([
        (0, 1, 7, 0.0), (0, 2, 8, 0.0), (0, 3, 1, root), (0, 4, 100, round(5 ** 0.5, 9)),
        (100, 1, 0, round(5 ** 0.5, 9)), (100, 2, 1, round(5 ** 0.5, 9)), (100, 3, 7, round(5 ** 0.5, 9)),
        (100, 4, 8, round(5 ** 0.5, 9))])
    assert ann.search(df.limit(0), lambda i: i % 100 == 0).collect() == []


def test_boundary_vectors_are_in_several_lists():
    rng = np.random.default_rng(1)
    data = rng.normal(size=(4000, 8))
    index = ann.Index(ann.CentroidGraph(ann.balanced_centroids(data, 40), 24), ann.Settings())
    lists = index.assign(data)
    sizes = np.bincount([x[0] for x in lists])
    assert sizes.max() <= 4 * 4000 / 40 and any(len(x) > 1 for x in lists)
    gaps = ann.distances(data, index.graph.centres)
    assert np.mean([x[0] == g.argmin() for x, g in zip(lists, gaps)]) > 0.95


def test_graph_search_finds_what_all_distances_find():
    rng = np.random.default_rng(2)
    centres, points = rng.normal(size=(700, 12)), rng.normal(size=(60, 12))
    ids, gaps = ann.CentroidGraph(centres, 24).search(points, 96)
    true = np.argsort(ann.distances(points, centres), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids[:, :96].tolist(), true.tolist())]) > 0.97
    assert (np.diff(gaps, axis=1) >= 0).all()


def test_chain_equals_one_step_after_the_other():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 100, 1037):
        a, b, c, d = rng.uniform(0.1, 3, (4, n))
        a[0] = c[0] = 0
        want, x = [], 1.0
        for i in range(n):
            x = (a[i] * x + b[i]) / (c[i] * x + d[i])
            want.append(x)
        assert np.allclose(toxicity.run_chain(a, b, c, d), want, rtol=1e-9)


def test_marginals_equal_all_taggings():
    rng = np.random.default_rng(5)
    field = toxicity.Field(pairs=np.array([[0.0, -1.0], [0.4, 1.1]]), start=-0.3)
    lengths = [3, 1, 0, 6, 2]
    score = rng.normal(size=sum(lengths)) * 2
    got, at = field.marginals(score, np.cumsum(lengths)), 0
    for n in lengths:
        total, mass = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            s = sum(score[at + i] * t for i, t in enumerate(tags)) + (field.start * tags[0] if n else 0)
            s += sum(field.pairs[x, y] for x, y in itertools.pairwise(tags))
            total += np.exp(s)
            mass += np.exp(s) * np.array(tags)
        assert np.allclose(got[at:at + n], mass / total)
        at += n


def toxic_corpus(n=700, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "re", "ti", "on", "er", "sh"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randint(5, 120))], int(rng.random() < 0.25)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Scum,", "grol" + word(), "grol" + word(), "vile!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_learns_and_marks(spark):
    rows, labels = toxic_corpus()
    odd = [(10_000, None), (10_001, ""), (10_002, " \n "), (None, "scum vile scum"), (10_003, "reon tisher " * 60_000),
           (10_004, "Ein grolxyz und İ scum.")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").withColumns(
        {c: F.lit("own") for c in ("score", "predicted", "row", "tagged")})
    marks = spark.createDataFrame(labels + [(3, None), (None, 1), (77_777, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    got = toxicity.score(docs, model).select("row.doc_id", "row.text", "score", "predicted", "spans",
                                             toxicity.held_out("row.doc_id").alias("held")).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held and r.doc_id in truth]
    assert len(held) > 80
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[10_000].predicted == by_id[10_001].predicted == by_id[10_003].predicted == 0
    assert by_id[None].predicted == 1
    strange = by_id[10_004]
    assert strange.predicted == 1
    assert {strange.text[s.start:s.end] for s in strange.spans} == {"grolxyz", "scum."}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert model is None
    assert [(r.score, r.predicted, r.spans) for r in toxicity.score(docs, model).collect()] == [(0.0, 0, [])] * 2
    only = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.train(docs, only) is None


def test_long_documents_do_not_end_the_sample():
    sizes, labels = np.array([3, 900, 4, 5, 90, 2]), np.array([1, 0, 1, 0, 1, 0])
    assert toxicity.within(sizes, labels, 100).tolist() == [0, 2, 3, 5]
    assert toxicity.within(sizes[::-1], labels[::-1], 97).tolist() == [0, 1, 2]
    # a class of which no document fits
    assert toxicity.within(np.array([900, 800, 3]), np.array([1, 1, 0]), 10).tolist() == [1, 2]


def test_the_field_sees_the_documents_behind_a_long_one(monkeypatch):
    rows, labels = toxic_corpus()
    toxic = dict(labels)
    seen, field = [], toxicity.fit_field
    monkeypatch.setattr(toxicity, "MOST_WORDS", 5000)
    monkeypatch.setattr(toxicity, "fit_field", lambda codes, table, ends, y: seen.append(
        (len(ends), len(codes))) or field(codes, table, ends, y))
    texts, marks = [t for _, t in rows], [toxic.get(i, 0) for i, _ in rows]
    toxicity.fit([" ".join(f"long{i}" for i in range(6000))] + texts, [0] + marks)
    assert seen[0][0] > 20 and seen[0][1] <= 5000


def brute(rows, k=10, step=100):
    """Every query's nearest, among vectors of its length."""
    out = []
    for q, v in rows:
        if q % step == 0:
            near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i)
                          for i, w in rows if i != q and len(w) == len(v))
            out += [(q, rank, i) for rank, (_, i) in enumerate(near[:k], 1)]
    return sorted(out)


def test_vectors_of_several_lengths_do_not_hide_one_another(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_ROWS", 2)  # the queries of a list come in several blocks
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(rng.normal(size=4 if i % 3 else 6)).tolist()) for i in range(300)] + [(1000, [1.0, 2.0])]
    got = ann.search(vectors(spark, rows).repartition(4), lambda i: i % 10 == 0, k=10)
    # 300 vectors are three lists, nearly all of which are read
    want = brute(rows, step=10)
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect())
    assert {q for q, _, _ in found} == {q for q, _, _ in want}
    assert len(set(found) & set(want)) >= 0.9 * len(want)


def test_the_beam_widens_to_the_ratio():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(600, 24))
    index = ann.Index(ann.CentroidGraph(centres, 24), ann.Settings(beam=16, prune=1.3))
    index.primary = np.full(600, 50)
    points = rng.normal(size=(20, 24))
    gaps = ann.distances(points, centres)
    read = index.lists_for(points, 10)
    wanted = [set(np.flatnonzero(gap <= 1.3 * gap.min()).tolist()) for gap in gaps]
    assert max(map(len, wanted)) > 100  # far more than the beam begins with
    assert sum(len(w & set(x)) for w, x in zip(wanted, read)) >= 0.95 * sum(map(len, wanted))


def test_a_sampled_id_gives_one_text_within_the_bound(spark, monkeypatch):
    rows, labels = toxic_corpus()
    seen, real = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks: seen.append((texts, marks)) or real(texts, marks))
    copies = [rows[1]] * 400 + [(rows[1][0], rows[1][1] + " and more of it")] * 5
    long = [(rows[2][0], "very long " * 50_000), (rows[3][0], None)]
    docs = spark.createDataFrame(rows[:2] + copies + long + rows[4:], "doc_id long, text string").repartition(5)
    monkeypatch.setattr(toxicity, "MOST_CHARS", 60_000)
    toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    texts, marks = seen[0]
    assert sum(map(len, texts)) <= 60_000 and len(texts) == len(marks) > 50
    assert texts.count(rows[1][1]) <= 1 and not any("and more of it" in t for t in texts)
    monkeypatch.setattr(toxicity, "MOST_CHARS", 10 ** 9)
    toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len(seen[1][0]) == len({i for i, _ in labels if not toxic_held(i)})


def toxic_held(key):
    import zlib

    return zlib.crc32(str(key).encode()) % 5 == 0


def test_recall_where_neighbours_lie_beyond_the_ratio(spark):
    rng = np.random.default_rng(5)
    groups = np.repeat(rng.normal(size=(700, 16)), 6, axis=0)  # the nearest five close, the others far
    tight = groups + rng.normal(size=groups.shape) * 0.01
    shifted = 1e6 + rng.normal(size=(4000, 16))
    for data in (tight, shifted):
        rows = [(i, v.tolist()) for i, v in enumerate(data)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
        found = {}
        for r in ann.search(df, lambda i: i % 100 == 0, k=10).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        hits = 0
        for query in range(0, len(data), 100):
            gap = np.sqrt(((data - data[query]) ** 2).sum(1))
            gap[query] = np.inf
            hits += len(found[query] & set(np.argsort(gap, kind="stable")[:10].tolist()))
        assert hits / (10 * len(range(0, len(data), 100))) >= 0.94
