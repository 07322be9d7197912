"""The corpus pipeline: quality filter, near-duplicate removal, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.

Defined for every stage: null and empty texts are texts without words (a null stays null until
packing), texts are read whole however long, null and repeated ids stand for rows of their
own, equal texts are judged alike, an empty table gives no row, and further columns of docs, whatever their
names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import common, neardup, packing, quality, secrets, tokens


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality classifier accepts: a score of 0.3 or more.

    A null text is scored as an empty one; equal texts get equal scores, so repeated rows stay or go
    together; without labels of both kinds every row stays; an empty table gives no row.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest id, of equal ids one row.

    Null and empty texts are one class, texts of fewer than five words are compared as one
    shingle; rows without an id stay only where their class has no id; an empty table gives no row.
    """
    return neardup.deduplicate(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark; every row stays.

    A null text stays null; overlapping findings become one mark; n_chars, where there is such a
    column, follows the new text; an empty table gives no row.
    """
    return secrets.redact(docs, tokens.vocabulary("byte_bpe_50k.tiktoken"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences.

    A null or empty text is a piece of its end id alone; long texts are cut into full pieces and a
    last one; repeated rows and ids are packed one by one; an empty table gives no row.
    """
    return packing.pack(docs, tokens.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicate removal", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack_sequences),
]

#: The classifier, the dedup and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents."""
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
