"""A training corpus from raw documents: language, duplicates, the mix of sources, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
as the next stage's docs. All stages but the last return the columns of documents, with any further ones
that docs has. Texts may be of any length, and columns may have any names. An empty table passes
through all stages as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language, minhash, mixing, packing
from tidemark.llm.common import staged

MIN_SCORE, SEED = 0.4, 9


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts that are null or without letters go."""
    return language.accepted(docs, language.fit(docs), MIN_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the one with the most code points, then the smallest id; nulls count as empty.

    Of repeated rows one stays. Rows without an id come after those with one.
    """
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity, that of the smallest id.

    Texts without words, and rows without an id, link with nothing and stay. Rows that share an id stay or go together.
    """
    return minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight: documents come once, twice, in part or not at all.

    A null source is one of its own. Texts that are null or without words are never taken. Rows that share an id
    are documents of their own. Equal sizes and repeated rows are dealt by a hash of id and text; rows equal in both are interchangeable.
    """
    return mixing.mixed_documents(docs, seed=SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document that the mix takes twice has its pieces twice. A null text is empty; its one piece is the end's token. Pieces of equal
    lengths take their places in the order of id, piece, start and ids; equal in all of these, they are interchangeable.
    """
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.packed(staged(narrow, "pieces"), order=("doc_id", "piece", "start", "ids_crc32"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained network, similarity joins and draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
