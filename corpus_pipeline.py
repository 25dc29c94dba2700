"""Corpus pipeline: raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the docs of the next one. All but the last return the columns of ``documents``; rows with a null
doc_id or text pass like any others, as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netquill.llm.common import table, written
from netquill.llm.decontaminate import find_contamination
from netquill.llm.line_dedup import drop_repeated_lines
from netquill.llm.minhash_dedup import near_duplicates
from netquill.llm.mixing import mix
from netquill.llm.toxicity import score_toxicity, train_toxicity


def _columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = train_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _columns(score_toxicity(docs, model).filter("toxic_predicted = 0"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds."""
    out = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _columns(out, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id."""
    gone = near_duplicates(docs.select("doc_id", "text")).filter("not kept").select("doc_id").distinct()
    return _columns(docs.join(gone, "doc_id", "left_anti"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return _columns(find_contamination(docs, table(spark, sf_dir, "benchmark")).filter("n_hit = 0"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: for each document the words taken of it and its position, in order of it."""
    return mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: the classifier has no SQL form; tests hold the stages against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
