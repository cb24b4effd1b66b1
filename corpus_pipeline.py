"""From raw documents to packed training sequences: the corpus operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a frame. Between stages the
documents are written as Parquet in the session's shared folder and read again,
so a stage works on all its predecessor kept and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import exact_dedup, mixing, near_dedup, packing, queries, toxicity
from gleanery.session import bound_batches, cut_lineage

#: The stages include a learned score, seeded choices and packing, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not predict to be toxic."""
    bound_batches(spark)
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the largest id, of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each component of near copies: texts that
    SimHash links and whose sets of five-word shingles have a Jaccard similarity of 0.8 or more,
    completed by those of such similarity that SimHash leaves apart."""
    bound_batches(spark)
    return near_dedup.drop_near_duplicates(docs, shingle=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs, mixing.words_in(F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    bound_batches(spark)
    return packing.pack_documents(docs, queries.vocabulary(), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = queries.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, name)
    return docs
