"""A corpus pipeline over ``documents``: each stage keeps, drops or changes whole documents.

Every stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it kept, and returns the
columns of documents; the last adds what it made of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.llm import byte_bpe, decontaminate, ngram_jaccard, secrets, toxicity
from lithos.llm._spark import Scratch

#: Documents that score so high are rejected; words of a shingle and percent of overlap of near duplicates; words of a benchmark window.
TOXIC, SHINGLE_WORDS, NEAR_PERCENT, WINDOW_WORDS = 0.7, 5, 80, 10


def _benchmark_or_labels(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity is ``TOXIC`` or more; null and empty texts stay, and each row, repeated or without an id, is judged by its own text.

    Without labelled documents of both kinds, as in an empty table, nothing is toxic.
    """
    model = toxicity.train_toxicity(docs, _benchmark_or_labels(spark, sf_dir, "labels"), held_out=None)
    return toxicity.drop_toxic(docs, model, limit=TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays; rows that repeat an id are judged each by its own text."""
    return ngram_jaccard.keep_one(docs, n=SHINGLE_WORDS, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item; null texts, null ids and repeated rows stay as they are."""
    return decontaminate.remove_hits(docs, _benchmark_or_labels(spark, sf_dir, "benchmark"), n=WINDOW_WORDS, whole=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars``, where there is such a column, counted anew.

    Each row is masked by its own text, so null and repeated ids are safe; a null text stays null, its length too; other columns stay as they are.
    """
    masked = secrets.mask_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``n_tokens`` and ``ids`` (4 bytes each), and their text as decoded from these.

    A null text stays null and has no ids. Where a column has one of the two names already, the new one ends with ``_new``.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rest = F.struct(F.col("text").isNull().alias("none"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns) if c != "text"])
    given = docs.select("doc_id", "text", rest.alias("rest"))
    decoded = byte_bpe.byte_bpe_round_trip(given, ranks, public_tokenizers.PATTERN, keep=["rest"])
    text = F.when(~F.col("rest.none"), F.decode("decoded", "UTF-8"))
    new = {c: c + "_new" if c in docs.columns else c for c in ("n_tokens", "ids")}
    columns = [(text if c == "text" else F.col(f"rest.c{k}")).alias(c) for k, c in enumerate(docs.columns)]
    return decoded.select(*columns, (F.octet_length("ids") / 4).cast("long").alias(new["n_tokens"]), F.col("ids").alias(new["ids"]))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("byte_bpe", encode),
]

#: A trained classifier decides what goes, which SQL can't express; tests hold the stages together against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all of ``documents``; each result but the last is written and read again, the one before it deleted.

    No row is lost but by a stage's own decision; an empty table goes through all stages and gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name, "zstd")
            scratch.drop(before)
    return docs
