"""A training corpus from raw documents: language, exact and near copies, mix, tokens.

Every stage reads whole texts and gives an empty result for an empty table; all but the last keep the columns they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellstride.llm import bpe, common, exactdedup, langid, mixing, simhash
from cellstride.sources.staging import stage


def _keep(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are marked as kept; ``decided`` has their numbers (mark, kept)."""
    kept = decided.where("kept").select(F.col("mark").alias("__mark"))
    return common.mark_rows(docs, "__mark").join(kept, "__mark", "left_semi").drop("__mark")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in no known language: those without a letter, or without any n-gram of a learned one.

    Null and empty texts go; repeated rows are judged alike.
    """
    told = langid.predict(docs, langid.train_on_documents(docs))
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("support") > 0)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts: the smallest doc_id, null last; of rows with that id, the first of the stored table.

    Null texts equal empty ones.
    """
    return _keep(docs, exactdedup.exact_duplicates(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: fingerprints of three-word shingles, linked at three bits or fewer.

    The smallest doc_id stays (ties as in exact dedup); texts without a word have fingerprint zero and are linked like others.
    """
    return _keep(docs, simhash.near_duplicates(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, three times at most; a null source is a source, a null text has size 0."""
    taken = mixing.mix(docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text", "source"))
    return taken.where("passes > 0").select(
        "__row", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))).alias("__pass")).select("__row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and digests of them and of the text they decode to; a null text has no ids."""
    path = bpe.default_path()
    coded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), path)
    return coded.select("doc_id", "source", "ids", *bpe.digests(coded))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]

#: String kernels and fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"stage-{i + 1}")
    return docs
