"""The corpus pipeline: documents that are fit to train on, packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to
the shared folder and read again as the next one's docs; a lost executor never costs more
than the running stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import decontaminate, line_dedup, minhash, packing, toxicity
from txrisk.llm.shared import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the factorization machine predicts toxic. It learns from
    the labelled ones among ``docs`` (op6's fold left out). Rows that share a doc_id are judged
    together (one toxic text drops them); rows with a null doc_id stay."""
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    bad = stored(found.where("predicted = 1 and doc_id is not null").select(F.col("doc_id").alias("__bad")), "toxic").distinct()
    return docs.join(bad, F.col("doc_id") == F.col("__bad"), "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out repeated lines; ``n_chars`` follows the text. A document stays even if no line is left."""
    names = docs.columns  # set aside, as an input column may be called n_lines too
    out = line_dedup.line_dedup(docs.toDF(*(f"__{c}" for c in names)), id_col="__doc_id", text_col="__text")
    cols = [F.col(f"__{c}").alias(c) for c in names]
    if "n_chars" in names:
        n = F.when(F.col("n_dropped") > 0, F.length("__text")).otherwise(F.col("__n_chars"))
        cols[names.index("n_chars")] = n.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*cols)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the smallest doc_id (5-word shingles,
    similarity 0.8). Documents without words are in no group."""
    found = minhash.near_duplicates(docs, minhash.MinHashConfig(words=5))
    lost = stored(found.where("not kept").select(F.col("doc_id").alias("__lost")), "copies").distinct()
    return docs.join(lost, F.col("doc_id") == F.col("__lost"), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of ``benchmark``."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens, one row a piece."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learnt models, SimHash search and tokens are beyond SQL; tests/llm checks each stage's
#: columns and edge rows, and op2, op3 and op7 against brute force, but not the whole run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
