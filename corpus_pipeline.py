"""Preparing a training corpus: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows of its
predecessor; the rows of a stage are written as Parquet and read again as the
next one's docs.  All but the last return the columns of documents.  The mix
writes its rows in the mixed order; as files that are read again promise none,
the last stage works out the place of each row in the mix once more (it depends
on the rows alone) and returns it as block, slot and position.

For every stage: a null or empty text is a document like any other, a null
source is a source of its own, texts of any length are worked on whole, an
empty table gives no rows, and columns beyond those of documents pass through,
but for those that carry the name of one that the last stage returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statuta.llm.common import stored
from statuta.llm.line_dedup import dedup_lines
from statuta.llm.mixing import mix_sources
from statuta.llm.pieces import encode_texts
from statuta.llm.quality import score_quality, train
from statuta.llm.simhash import dedup_simhash

PLACE = ("block", "slot", "position")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the training folds.

    Equal texts fare alike, so rows that repeat one another all stay or all go; a null doc_id has no label.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).where("predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without lines whose near copy stands earlier in the corpus (null doc_ids first).

    Rows that repeat one another are one document and keep the same lines.
    """
    return dedup_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest doc_id; of repeated rows one, all empty texts are one group."""
    return dedup_simhash(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixing schedule; rows with equal or null ids follow one another."""
    return mix_sources(docs).orderBy("position").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, whether they decode to its text, and its place in the mix; null and empty texts have no tokens."""
    return encode_texts(mix_sources(docs)).select("doc_id", "source", *PLACE, "n_tokens", "token_ids", "round_trip")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: The classifier's fit, MinHash and SimHash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
