"""Documents to tokens: language, near duplicates, benchmark passages, secrets, SentencePiece ids.

Each stage takes all rows that its predecessor kept, written as Parquet and read again. All but the last return the columns of
``documents``, and any others that the rows have, whatever their names: a row is carried as one struct.

Cases, in every stage: null and empty texts have no language and go with the first stage; rows that repeat an id and a text are copies, of which
``near_duplicates`` keeps one (texts without words all stay); ids may be null; long texts are whole; an empty table gives an empty table; other
columns, also ones named like the helpers' own, keep their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from briefwright.llm import decontamination, language, ngramjoin, secretscan, subwords
from briefwright.llm.common import stage, whole_row
from briefwright.llm.queries import table, tokenizer

#: A language is taken for undetermined, and its text rejected, if the winner is less likely than this.
LEAST_SCORE = 0.5


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is determined. Null texts, texts without letters and even contests go."""
    found = docs.select(whole_row(docs), language.predict(F.col("text"), language.fit(docs), spark).alias("language"))
    return found.where((F.col("language.lang_pred") != language.UNDETERMINED) & (F.col("language.score") >= LEAST_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of similar ones."""
    return ngramjoin.distinct(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text."""
    out = secretscan.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed) and digests of the ids and of the text that they decode to."""
    encoded = subwords.encode(docs, tokenizer("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language", languages), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages), ("secrets", secrets), ("tokens", tokens)]

#: SQL can't express the language model or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
