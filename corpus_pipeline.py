"""The corpus pipeline: stages that each call one operator; see README.

No stage but the last changes the columns of ``documents``.  A stage works on all rows that the one before kept, and rows
with nulls in any column go through every stage; what each does with them is said in its operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tailmap.llm.common import stored, table
from tailmap.llm.exact_dedup import dedup_exact
from tailmap.llm.langid import keep_identified
from tailmap.llm.minhash import dedup_near
from tailmap.llm.mixing import take_mix
from tailmap.llm.pieces import Model, encode_decode


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or far from every language that was learned, go."""
    return keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays."""
    return dedup_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup at a similarity of 0.8: of each group the document with the smallest doc_id stays."""
    return dedup_near(docs, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents as often as the mix takes them, a row each time."""
    return take_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every row, and the checksum of what they are decoded to."""
    import public_tokenizers

    return encode_decode(docs, Model.load(public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

#: SQL can express neither the learned languages nor the encoding; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents table; what a stage keeps is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, stored(docs, f"stage-{i}") if i else docs, sf_dir)
    return docs
