"""Mixing, sharding and preference formatting."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import mixing, preference, sharding

ROWS = "doc_id long, source string, text string"


def corpus(seed=1, n=600):
    rng, rows = random.Random(seed), []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "B", "é", None, "tiny"] if i > 5 else ["tiny"])
        rows.append((i, source, "w " * (7 if i % 3 == 0 else rng.randint(0, 400))))
    return rows + [(9000, "nothing", ""), (9001, "nothing", None), (None, "a", "w w w"), (5, "a", "w " * 30),
                   (9002, "B", "w " * 20_000)]


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, stop=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        rest = budget - sum(stop * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and rest * weight[s] / free > stop * sizes[s]]
        if not over:
            return {s: stop * sizes[s] if s in full else rest * weight[s] / free for s in names}
        full |= set(over)


def test_mix_meets_its_targets(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("own") for c in ("size", "pair", "bucket", "n")})
    mixed = mixing.mix(docs, mixing.words_in(F.col("text")))
    got = mixed.collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    sizes = collections.Counter()
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    want, taken = slow_targets(sizes), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
    for source, target in want.items():
        # an exact subset exists for all these sources
        assert abs(taken[source] - target) <= 1, (source, taken[source], target)
    again = mixing.mix(docs.repartition(5), mixing.words_in(F.col("text")))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_mixed_rows_repeat_and_keep_columns(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * 10) for i in range(20)], ROWS).withColumn("copies", F.lit(9))
    got = mixing.mixed_rows(docs, mixing.words_in(F.col("text")))
    assert got.columns == docs.columns
    counts = collections.Counter(r.source for r in got.collect())
    assert counts == {"a": 20, "b": 10}  # of 300 words 5/7 are a's, which stops at 200; b has the rest


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], ROWS), mixing.words_in(F.col("text"))).collect() == []


def test_fit_finds_what_a_subset_can():
    rng = random.Random(2)
    for _ in range(300):
        lengths = np.array(sorted(rng.sample(range(0, 30), rng.randint(1, 6))), dtype=np.int64)
        counts = np.array([rng.randint(1, 4) for _ in lengths], dtype=np.int64)
        budget = rng.randint(0, int((lengths * counts).sum()) + 5)
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        total = int((lengths * taken).sum())
        assert total <= budget
        # within what is left beside the even spread, no subset comes nearer
        if budget <= lengths.max():
            sums = {0}
            for x, n in zip(lengths.tolist(), counts.tolist()):
                sums = {s + x * i for s in sums for i in range(n + 1)}
            assert total == max(s for s in sums if s <= budget)


def test_table_is_full_even_and_stable():
    names = [f"s{i}" for i in range(10)]
    table = sharding.fill_table(names, 1009)
    assert table == sharding.fill_table(names[::-1], 1009)
    held = collections.Counter(table)
    assert len(table) == 1009 and max(held.values()) - min(held.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.25 * 1009
    assert sharding.fill_table(["x"], 2) == [0, 0]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 7)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 8)


def test_placement(spark):
    rows = spark.createDataFrame([(i % 50 if i else None, "x") for i in range(300)], "doc_id long, shard string")
    names = ["north", "south", "west"]
    table, order = sharding.fill_table(names, 101), sorted(names)
    got = sharding.place(rows, "doc_id", names, 101)
    seen = {}
    for r in got.collect():
        assert r.shard == order[table[r.slot]] and r.row.shard == "x"
        assert seen.setdefault(r.row.doc_id, r.shard) == r.shard
    assert got.count() == 300 and set(seen.values()) == set(names)
    assert sharding.place(rows.limit(0), "doc_id", names, 101).collect() == []


TURN = "array<struct<role:string,text:string>>"


def pairs(spark, rows):
    return spark.createDataFrame(rows, f"pair_id long, chosen {TURN}, rejected {TURN}, prompt string")


def test_preference_pairs(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes"), ("assistant", "no")
    rows = [(1, [u, a], [u, b], "own"), (2, [u, a], [u, a], "own"), (3, [u], [u, a, u, b], "own"),
            (4, None, [b], "own"), (5, [], [], "own"), (6, [a], [("user", "yes")], "own")]
    df = preference.format_pairs(pairs(spark, rows))
    got = {r.pair_id: r for r in df.collect()}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.n_prompt_turns == 1
    assert one.chosen == "<|assistant|>\nyes<|end|>\n" and one.rejected == "<|assistant|>\nno<|end|>\n"
    assert [one.chosen[s.start:s.end] for s in one.chosen_mask] == ["yes<|end|>\n"]
    assert got[2].n_prompt_turns == 2 and got[2].chosen == got[2].rejected == "" and not got[2].chosen_mask
    three = got[3]
    assert three.chosen == "" and three.n_prompt_turns == 1
    assert [three.rejected[s.start:s.end] for s in three.rejected_mask] == ["yes<|end|>\n", "no<|end|>\n"]
    assert got[4].n_prompt_turns == 0 and got[4].chosen == "" and got[4].rejected.endswith("no<|end|>\n")
    assert got[5].prompt == got[5].chosen == ""
    assert got[6].n_prompt_turns == 0 and not got[6].rejected_mask
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_branches_of_odd_turns(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, "user", None), (1, 1, None, "b"), (1, 1, None, "b"),
            (7, 0, "user", "only"), (None, 0, "user", "lost"), (9, None, "user", "x" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r.pair_id: r for r in preference.branch_pairs(turns).collect()}
    assert set(got) == {0, 1, 7, 9}
    assert [t.text for t in got[0].rejected] == ["q", "b", "b"]
    assert [t.text for t in got[1].rejected] == ["", "a"] and len(got[1].chosen) == 3
    assert [t.text for t in got[7].chosen] == ["only"] and got[7].rejected == []
    assert preference.branch_pairs(turns.limit(0)).collect() == []


def test_the_table_equals_a_plain_fill_and_slots_follow_the_hash(spark):
    """The preference orders written out whole, shards taking turns; a key's slot is its hash."""
    import xxhash

    names, size = ["c", "a", "e", "b", "d"], 101
    orders = {n: [(xxhash.xxh64_intdigest(n, 1) + j * (xxhash.xxh64_intdigest(n, 2) % (size - 1) + 1)) % size
                  for j in range(size)] for n in names}
    assert all(sorted(o) == list(range(size)) for o in orders.values())
    owner = {}
    while len(owner) < size:
        for n in sorted(names):
            free = [slot for slot in orders[n] if slot not in owner]
            if free:
                owner[free[0]] = n
    keys = ["7", "", "é" * 3, "long " * 9000, None, *map(str, range(300)), "7"]
    docs = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "doc_id string, slot int")
    got = sharding.place(docs.repartition(4), "doc_id", names, size).collect()
    assert len(got) == len(keys)
    for r in got:
        raw = xxhash.xxh64_intdigest((r.row.doc_id or "").encode(), 42) if r.row.doc_id is not None else 42
        signed = raw - (1 << 64) if raw >> 63 else raw
        assert r.slot == signed % size and r.shard == owner[r.slot]
