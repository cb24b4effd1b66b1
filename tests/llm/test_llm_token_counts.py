"""Token counts against the libraries' own, whole text by whole text."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["Hello, world's  end\n\n next", None, "", "   ", "\t\tTab\r\n", "naïve 東京タワー café　x   1234  x y",
       "a<|endoftext|>b", " <|endoftext|> <|endoftext|><|endoftext|>'s", "<|endoftext|", "<|endoftext|>",
       "zero\0byte \0", "é combined \U0001F600\U0001F468‍\U0001F469", "\x1c\x1d sep \x85 nel \xa0nb",
       "word " * 5000, "x" * 3000, "don't we'll I'VE they're", "trailing   "]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def noise(rng, n):
    letters = "ab 'stSé\n\t.,9東 \x1c\x85<|>Ж"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
            + rng.choice(["", "<|endoftext|>", " <|endoftext|>x"]) for _ in range(n)]


@pytest.mark.parametrize("cached,block", [(400_000, 1_000_000), (20, 7)])
def test_counter_equals_the_library(plain, monkeypatch, cached, block):
    monkeypatch.setattr(token_counts._blocks, "__defaults__", (block,))
    texts = ODD + noise(random.Random(2), 500)
    frequent = {" the": 1, "word": plain("word"), " x": plain(" x")}
    counter = token_counts.PieceCounter(PATH, frequent, cached)
    assert counter.by_piece
    for some in (texts[:9], texts[9:300], texts[300:]):
        assert counter.counts(some).tolist() == [plain(t) for t in some]


def test_blocks_lose_nothing():
    text = "one two  three \n four" * 50
    blocks = list(token_counts._blocks(text, 10))
    assert "".join(blocks) == text and len(blocks) > 20
    assert list(token_counts._blocks("x" * 50, 10)) == ["x" * 50]


def test_rows(spark, plain):
    texts = ODD + noise(random.Random(4), 60) + ["the same text"] * 50
    rows = [(i if i % 9 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").withColumn("row", F.lit("own"))
    got = sorted(((r.row.n_tokens, r.row.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                  for r in token_counts.count_tokens(docs.repartition(5), PATH, limit=20).collect()))
    assert got == [(i, k, len((t or "").encode()), plain(t), plain(t) > 20) for k, t, i in rows]


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count_whole_texts(spark, file):
    path = public_tokenizers.path(file)
    texts = [t for t in ODD if t is None or "\0" not in t]
    if file.endswith("json"):
        t = Tokenizer.from_file(path)
        want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    else:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(x or "")) for x in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_frequent_pieces(spark):
    docs = spark.createDataFrame([("the cat the dog",), (" the end",), (None,), ("",), ("y" * 99,)], "text string")
    found = token_counts.frequent_pieces(docs.repartition(3), most=1)
    assert found == [" the"]
    assert "y" * 99 not in token_counts.frequent_pieces(docs)
    assert token_counts.frequent_pieces(docs.limit(0)) == []


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).collect() == []


def test_query_equals_the_library(spark, plain):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in queries.table(spark, folder, "documents").collect()}
    for row in queries.op11_token_counts(spark, folder).collect():
        n = plain(texts[row.doc_id])
        assert (row.n_tokens, row.over_limit) == (n, n > 1024)
        assert row.n_bytes == len((texts[row.doc_id] or "").encode())
