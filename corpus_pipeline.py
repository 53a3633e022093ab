"""The corpus pipeline: quality, near duplicates, contamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last return the columns of docs, whatever other columns these have and whatever their names. An empty table
gives an empty one. Texts of any length are judged whole. Each stage states what it does with nulls, empty texts, ties
and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import common, decontaminate, jaccard_join, mixing, quality_model, token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with a score of 0.7 or more.

    Null and empty texts have the score of the bias alone; a null doc_id teaches nothing but is judged; repeated rows are
    judged alike. Without any labels every score is 0.5, so nothing is accepted.
    """
    return quality_model.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose 5-word shingles are 0.8 similar or more, the one with the least doc_id.

    A null doc_id comes last; of rows with one doc_id the least content key stays; of equal rows one stays. Null, empty
    and white-space texts match nothing, so all of them stay.
    """
    return jaccard_join.drop_near(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within 0.35 of its words in edits.

    Null and empty texts hold none; null doc_ids and repeated rows are judged each by itself; equal items are one hit more,
    and items without words are in no document.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to 3 times, in the shuffled order of its shard.

    Null and empty texts have no words, and go with their blocks; a null source is a source of its own; rows with one
    doc_id and source, or without a doc_id, share their fate. Of equally near choices the first by hash is taken.
    """
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files of the mix hold: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone; null doc_ids come first; rows of one doc_id are in the order of their ids.
    """
    return token_files.token_digest(docs, token_files.default_tokenizer())


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", contamination), ("mixing sources", mix), ("token files", tokens)]

#: Learned weights, MinHash classes and tokenizers can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
