"""From raw documents to token ids: the stages that make a training corpus.

Toxic documents go, of each group of near-duplicates one document stays, sources are
mixed to their target weights, and what is left is encoded. Every stage but the last returns
the columns of documents.

* Null and empty texts score by the model's intercept, are linked to nothing, have size 0 and are encoded as no
  pieces; they are taken as often as their source's rate says.
* Null and repeated ids: every row counts by itself. Rows without an id are judged, kept and drawn like others; of a group of
  near copies the row with the smallest id stays (nulls last, then by text and the other columns).
* Rows that are equal in every column are copies of each other: one stays.
* A text of any length is judged, compared and encoded whole; it must fit into a cell.
* An empty table, or labels that teach nothing, lets everything through; an empty stage leaves empty ones after it.
* Columns besides those of documents, whatever their names, pass through all stages but are part of what tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.llm import mixing, ngram_join, toxicity
from feedworks.llm.common import free_name, read_table, shipped, written
from feedworks.llm.queries import PIECES, TOXIC_FROM, toxicity_model
from feedworks.llm.sentencepiece_codec import encode_and_decode


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text does not score as toxic."""
    score = free_name(docs, "toxic_score")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir), out=score)
    return scored.where(F.col(score) < TOXIC_FROM).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that links connect, one row with the smallest id."""
    return ngram_join.keep_one_row_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text that is left, and the text they stand for."""
    return encode_and_decode(docs, PIECES)


STAGES = [
    ("toxicity", shipped(drop_toxic)),
    ("ngram_join", shipped(drop_near_duplicates)),
    ("mixing", shipped(mix_sources)),
    ("sentencepiece", shipped(tokenize)),
]

#: SQL can express neither the scores nor the pieces; tests compare with plain code instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the written rows of the one before."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
