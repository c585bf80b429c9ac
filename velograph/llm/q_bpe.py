"""op8: encode and decode every whole text of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.bpe import tokenize
from velograph.llm.shared import read_table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe_rank_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokenize(docs, vocabulary_path(), emit=("n_tokens", "ids_sha256", "decoded_sha256"))


QUERIES = {"op8_bpe_rank_array": op8_bpe_rank_array}
ORACLES: dict[str, str] = {}
