"""A corpus pipeline: toxicity, exact dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and returns a DataFrame; ``run`` writes each stage's rows as Parquet in
the shared folder and reads them as the next one's documents.  All stages but
the last return the columns of documents.

Defined cases: null and empty texts are clean, copies of each other, of no size
in the mix, and so in no result; without labels nothing is toxic; rows that
repeat both identifier and text are one document from the second stage on; a
document that the mix takes twice comes twice; an empty table gives an empty
result; further columns are kept up to the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdigris.llm import exact_dedup, mixing, near_dedup, sentencepiece_codec, toxicity
from verdigris.llm.common import forget, table, tables, written

#: DuckDB cannot train the classifier, so the pipeline is tested against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from the labelled ones among them does not find toxic."""
    return toxicity.reject(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the smallest doc_id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document of the smallest doc_id."""
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents that it takes twice come twice."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, with source and language; decoding gave back each text if round_trip holds."""
    keep = tuple(c for c in ("source", "lang") if c in docs.columns)
    return sentencepiece_codec.encode(docs, keep=keep)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote on the way goes when its result is written, and that when the next one's is."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        earlier = tables(spark)
        result = stage(spark, docs, sf_dir)
        docs = written(result, "pipeline")
        forget(spark, [t for t in tables(spark)[:-1] if t not in earlier or "/pipeline-" in t])
    return docs
