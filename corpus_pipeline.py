"""From raw documents to token digests: five stages, each written as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.bpe import tokenize
from velograph.llm.mixing import mix
from velograph.llm.ngram_join import keep_one
from velograph.llm.pii import sanitise
from velograph.llm.q_bpe import vocabulary_path
from velograph.llm.shared import drop_folder, fresh_path, read_table, working_tables
from velograph.llm.toxicity import reject


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return reject(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in every text."""
    return sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to one and a half times; every document stays at least once. Rows are written in the stream's order."""
    return mix(docs, max_repeats=1.5, in_order=True).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what each document is encoded to and decoded as."""
    return tokenize(docs, vocabulary_path(), emit=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", remove_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written along its way, and the stage before it, are deleted once it is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        with working_tables(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs


#: Learned scores and byte-pair merges are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None
