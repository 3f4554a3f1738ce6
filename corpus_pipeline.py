"""A corpus pipeline over the training-data operators: from raw documents to packed sequences.

Quality, near duplicates, personal data, mixing, packing.  Every stage but the
last returns the columns of ``documents``; each works on what its predecessor
kept, written to the shared folder in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livestats.llm.bestfit_packing import pack
from livestats.llm.common import stored, table
from livestats.llm.jaccard_join import keep_one
from livestats.llm.nbsvm_quality import score
from livestats.llm.pii_anchors import mask_pii
from livestats.llm.source_mixing import domain_labels, resample

#: Token shares that the others are mixed down to; clean text gets the rest and is never thinned out.
MIXTURE = {"clean": 0.97, "low": 0.01, "toxic": 0.02}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    columns = docs.columns
    scored = score(docs, table(spark, sf_dir, "labels"), keep=tuple(columns))
    return scored.where(F.col("predicted") == 1).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked in the texts."""
    return mask_pii(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say."""
    return resample(docs, domain_labels(table(spark, sf_dir, "labels")), MIXTURE, gains="clean")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in packed sequences."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("mixing to target weights", mixing),
    ("best-fit packing", packing),
]

#: The classifiers, the masking and the packing have no SQL; the tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{k}")
    return docs
