"""Exact dedup, SimHash near-dedup and substring dedup against brute force."""

import collections
import hashlib
import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gleanery.llm import exact_dedup, simhash, substring
from gleanery.llm.common import WORD_RE, components

DOC = "doc_id long, text string"
CLASH = ["row", "k", "h", "t", "sha", "salt", "head", "n", "fp", "keep_id", "component_id"]


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


ODD = [(1, "a b"), (2, "a b"), (3, ""), (4, None), (5, "A b"), (6, " a b"), (None, "a b"),
       (None, "alone"), (7, "x" * 300_000), (8, "x" * 300_000), (9, "é"), (9, "é"), (None, None)]


def brute_groups(rows):
    groups = collections.defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for key, text in rows:
        keys = groups[text or ""]
        known = [k for k in keys if k is not None]
        out.append((key, max(known) if known else None, len(keys),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def test_exact_groups_of_odd_rows(spark):
    got = exact_dedup.exact_groups(with_clashes(frame(spark, ODD))).collect()
    key = lambda r: str(r)
    assert sorted(((r.row.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) \
        == sorted(brute_groups(ODD), key=key)
    kept = collections.Counter(r.row.text or "" for r in got if r.kept)
    assert kept == collections.Counter({(t or "") for _, t in ODD})


def test_exact_dedup_keeps_columns_and_hot_groups(spark):
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(900)] + [(5000 + i, "warm") for i in range(40)]
    docs = with_clashes(frame(spark, rows))
    stay = exact_dedup.exact_dedup(docs)
    assert stay.columns == docs.columns
    got = {(r.doc_id, r.text) for r in stay.collect()}
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), i)
    assert got == {(i, t) for t, i in best.items()}


def test_exact_dedup_is_native_and_takes_no_rows(spark):
    empty = exact_dedup.exact_groups(frame(spark, []))
    assert empty.collect() == []
    plan = empty._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_normaliser(spark):
    got = exact_dedup.exact_dedup(frame(spark, [(1, "A"), (2, "a")]), normalise=F.lower).collect()
    assert [r.doc_id for r in got] == [2]


def slow_fingerprint(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD_RE.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    rng = random.Random(3)
    for text in [None, "", " \t\n", "One", "ÀB c d", "a b c d", "a b c d e\x0bf  g",
                 " ".join(rng.choice("abcdefg") for _ in range(500)), "é ü x y z w"]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def slow_components(prints, bits):
    keys, root = sorted(prints), {}
    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {a: find(a) for a in keys}


def test_every_four_groups_are_missing_in_some_cell():
    blocks = simhash.steiner_blocks()
    assert len(blocks) == 66 and all(len(b) == 5 for b in blocks)
    count = collections.Counter(four for b in blocks for four in itertools.combinations(sorted(b), 4))
    assert set(count.values()) == {1} and len(count) == 330
    assert len(simhash.cell_masks(4, 11)) == 66


@pytest.mark.parametrize("bits,groups", [(4, 11), (4, 7), (2, 4), (0, 1)])
def test_links_against_all_pairs(spark, bits, groups):
    rng, prints = random.Random(bits), set()
    for _ in range(25):
        near = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            for _ in range(rng.randint(0, bits + 2)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    prints |= {0, 1, 2 ** 64 - 1}
    signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
    got = {r.node: r.root for r in simhash.links(frame(spark, [(p,) for p in signed], "fp long"),
                                                bits, groups).collect()}
    want = slow_components(signed, bits)
    parts = collections.defaultdict(set)
    for p in signed:
        parts[got.get(p, p)].add(p)
    other = collections.defaultdict(set)
    for p, r in want.items():
        other[r].add(p)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, other.values()))


def test_near_duplicates_of_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(10, words), (4, words), (7, words + " tail"), (2, None), (3, ""), (1, "lonely words"),
            (None, words), (None, None), (20, "y " * 100_000)]
    got = simhash.near_duplicates(with_clashes(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (10, 4, 2, 3, 1)} == {
        (10, 4), (4, 4), (2, 2), (3, 2), (1, 1)}
    docs = with_clashes(frame(spark, rows))
    stay = simhash.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    ids = [r.doc_id for r in stay.collect()]
    assert {4, 2, 1} <= set(ids) and not {10, 3} & set(ids) and ids.count(None) == 2
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 200)]
    got = {r.node: r.root for r in components(frame(spark, links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 0 for i in range(1, 50)}}


def slow_removal(rows, window):
    count, words = collections.Counter(), [WORD_RE.findall(t or "") for _, t in rows]
    for w in words:
        for i in range(len(w) - window + 1):
            count[tuple(w[i:i + window])] += 1
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def removed(spark, rows, window, k):
    got = substring.remove_repeats(with_clashes(frame(spark, rows)), window, k).collect()
    for r in got:
        assert r.n_removed == sum(s.end - s.start for s in r.removed)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str)


@pytest.mark.parametrize("seed,letters,window,k", [(1, "ab", 6, 3), (2, "abcd", 5, 1), (3, "abcde", 4, 4),
                                                   (4, "abcdefghij", 3, 2)])
def test_substrings_against_all_windows(spark, seed, letters, window, k):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(25)]
    rows += [(100, rows[3][1]), (101, rows[4][1] + " z"), (102, "a " * 50), (103, None), (103, ""),
             (None, rows[5][1]), (None, "q r s t u v q r s t u v"), (7, rows[7][1])]
    assert removed(spark, rows, window, k) == slow_removal(rows, window)


def test_substrings_with_passages_and_a_long_text(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(40):
        text = [word() for _ in range(rng.randint(30, 200))]
        if i % 4 == 0:
            at, cut = rng.randrange(len(text)), rng.choice([30, 35, 36, 60])
            text[at:at] = passage[:cut]
        rows.append((i, " ".join(text)))
    rows.append((99, " ".join([word() for _ in range(30_000)] + passage)))
    assert removed(spark, rows, 35, 8) == slow_removal(rows, 35)
    assert substring.remove_repeats(frame(spark, [])).collect() == []


def test_cells_never_pass_the_driver(spark, monkeypatch):
    plans = []

    def watched(df, purpose="stage"):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return kept(df, purpose)

    kept = simhash.cut_lineage
    monkeypatch.setattr(simhash, "cut_lineage", watched)
    rows = [(i,) for i in (0, 1, 3, 1 << 40, (1 << 40) + 1, 0x0F0F << 20)]
    prints = kept(spark.createDataFrame(rows, "fp long"), "nodes")  # files have a size
    roots = simhash.links(prints).collect()
    assert {(r.node, r.root) for r in roots} == {
        (1, 0), (3, 0), (1 << 40, 0), ((1 << 40) + 1, 0)}
    first = next(plan for purpose, plan in plans if purpose == "cells")
    assert "Generate" in first and "SortMergeJoin" in first and "Broadcast" not in first
