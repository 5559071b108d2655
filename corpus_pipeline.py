"""From documents to training sequences: language, exact copies, near copies, personal data, packing.

Each stage works on all that its predecessor kept; ``run`` writes each result to the shared folder and
reads it again. All stages but the last return the columns of documents, further ones included, whatever their names.

Defined cases are those of the operators: a null or wordless text has no language and goes in the first stage; of rows
equal in text one stays, so rows that repeat end with the second; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, langid, ngram_join, packing, pii
from ledgerloom.llm.words import free_name
from ledgerloom.plans.scratch import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go: those without a letter, or unlike every language."""
    model = langid.train(docs, F.when(langid.learns(), F.col("lang")))
    judged = langid.identify(docs, model, out=(own := free_name(docs.columns, "_lm")))
    return judged.where(~F.col(f"{own}.rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of the least id stays."""
    return ngram_join.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind; ``n_chars`` follows the new text."""
    clean = pii.redacted(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast("long"))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece, with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies), ("pii", personal_data), ("best_fit_packing", packed)]

#: Models and tokens have no SQL form; tests/llm hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
