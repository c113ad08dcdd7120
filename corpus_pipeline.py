"""The corpus pipeline: stages over documents, each written and read again by the next.

Every stage works on all that its predecessor kept. All but the last return the columns of
documents; the last returns the digest of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import decontaminate, embedding, jaccard, mixing, wavelet
from adlake.llm.queries import mix_weights, table, with_domain
from adlake.llm.units import release
from adlake.session import materialize

#: Tokens that the mix chooses, in percent of what is left when it begins.
MIX_PERCENT = 90


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return embedding.of_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return jaccard.single_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = with_domain(docs.select("doc_id", "text", "lang", "source", row))
    return mixing.mixed_documents(named, mix_weights(spark, named), MIX_PERCENT).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return wavelet.tokenized(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_weights),
    ("token-ID / binary output", token_output),
]

#: The classifier is fitted in numpy, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token digest of what the stages keep of documents: doc_id, start, n_tokens, ids_crc32, part, shard."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
