"""Token store and packing: round trips and brute force."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import packing, token_store
from gleanery.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(5, "Hello, world's  end\n\n next"), (1, None), (2, ""), (3, "   "), (9, "naïve 東京 <|endoftext|> 1234  x y"),
       (7, "word " * 3000), (7, "word " * 3000), (7, "another"), (None, "no key"), (-4, "\t\tTab\r\n")]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_encoder_equals_the_library(plain):
    rng = random.Random(1)
    texts = [t or "" for _, t in ODD] + [
        "".join(rng.choice("ab 'st\n\t.,9é \x1c\x85 ") for _ in range(rng.randint(0, 80)))
        for _ in range(400)]
    coder = Encoder(PATH, most_pieces=50)
    for some in (texts[:10], texts[10:200], texts[200:]):
        ids, ends = coder.encode(some)
        start = 0
        for text, end in zip(some, ends):
            assert ids[start:end].tolist() == plain(text), repr(text)
            start = end


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 999])
def test_index_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(10 ** 15, n, replace=False).astype(np.int64)
    index = token_store.KeyIndex.build(keys)
    assert sorted(index.find(keys).tolist()) == list(range(n))
    strangers = np.arange(-1000, 0, dtype=np.int64)
    assert (index.find(strangers) >= 0).sum() <= 1


def test_store_round_trip(spark, tmp_path, plain):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("shard", F.lit("own"))
    manifest = token_store.write(docs, PATH, f"file://{tmp_path}/ids", end_id=0)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32)
                  for r in token_store.read(manifest).collect()))
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for key, text in order:
        ids = [*plain(text), 0]
        want.append((start, key, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    asked = spark.createDataFrame([(9,), (1,), (7,), (8,), (None,), (9,)], "doc_id long")
    found = {r.doc_id: r.ids for r in token_store.lookup(manifest, asked).collect()}
    assert found[9] == [*plain(ODD[4][1]), 0] and found[1] == [0] and found[8] is None
    assert found[7] == [*plain("another"), 0] and found[None] is None


def test_store_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = token_store.write(docs, PATH, str(tmp_path / "none"))
    assert token_store.read(manifest).collect() == []


def best_number(items, room):
    n = len(items)
    best = [(0, 0)] + [(99, 0)] * ((1 << n) - 1)
    for mask in range(1, 1 << n):
        for i in range(n):
            if mask >> i & 1:
                bins, last = best[mask ^ 1 << i]
                step = (bins, last + items[i]) if bins and last + items[i] <= room else (bins + 1, items[i])
                best[mask] = min(best[mask], step)
    return best[-1][0]


def test_reduction_keeps_an_optimum():
    rng, fixed_any = random.Random(4), 0
    for _ in range(400):
        room = rng.choice([10, 20, 30])
        items = [rng.randint(1, room) for _ in range(rng.randint(1, 9))]
        left = Counter(items)
        fixed = packing.reduce_instance(left, room)
        fixed_any += len(fixed) > 0
        used = Counter(x for one, n in fixed for x in one for _ in range(n))
        assert used + left == Counter(items) and all(sum(one) <= room for one, _ in fixed)
        rest = list(left.elements())
        assert sum(n for _, n in fixed) + (best_number(rest, room) if rest else 0) == best_number(items, room)
    assert fixed_any > 300


def slow_best_fit(items, room):
    bins = []
    for x in sorted(items, reverse=True):
        fit = [b for b in bins if sum(b) + x <= room]
        if fit:
            max(fit, key=sum).append(x)
        else:
            bins.append([x])
    return len(bins)


def test_best_fit_equals_item_by_item():
    rng = random.Random(5)
    for _ in range(300):
        room = rng.choice([12, 50])
        items = [rng.randint(1, room) for _ in range(rng.randint(0, 60))]
        got = packing.best_fit(Counter(items), room)
        assert Counter(x for one, n in got for x in one for _ in range(n)) == Counter(items)
        assert sum(n for _, n in got) == slow_best_fit(items, room)


def test_packed_documents(spark, plain):
    rng = random.Random(6)
    rows = ODD + [(100 + i, "tok " * rng.randint(0, 2000)) for i in range(60)] + [(500 + i, "same") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("own"))
    got = packing.pack_documents(docs, PATH, capacity=1024, end_id=2).collect()
    want = Counter()
    for key, text in rows:
        ids = [*plain(text), 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[(key, i, a, b - a, crc(ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.02 * -(-total // 1024) + 2


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, PATH).collect() == []
