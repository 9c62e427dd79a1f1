"""Corpus pipeline over ``documents``: language, near duplicates, contamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``.

Cases: rows that share a doc_id are one document and stay or go together; a
row with null doc_id is never a near duplicate of another; null texts have no
language and go with the first stage; an empty table gives no rows; extra
columns stay until the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm import common, contamination, jaccard, language, pieces, secrets


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the fused evidence is sure of."""
    renamed, back = common.set_aside(docs, language.OWN)
    return back(language.identify_documents(renamed).where("lang_keep").select(*renamed.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id."""
    gone = common.materialize(jaccard.jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct(), "duplicates")
    return common.join_checked(docs, gone, "doc_id", "left_anti", jaccard.BROADCAST_ROWS).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return contamination.decontaminate(docs, common.table(spark, sf_dir, "benchmark")).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and n_chars brought up to date."""
    renamed, back = common.set_aside(docs, {"base_spans", "secret_spans"})
    found = secrets.scan_secrets(renamed)
    found = found.withColumn("text", secrets.redact(F.col("text"), F.col("secret_spans")))
    found = found.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(found.select(*renamed.columns))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    found = pieces.encode(docs)
    return found.select("doc_id", "lang", "source", "n_chars", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

#: The language model, the graph of links and the merges are beyond plain SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
