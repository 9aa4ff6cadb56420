"""Documents to training sequences: toxicity, near copies, benchmark passages, personal data, packing.

Each stage reads what the one before has kept, and its decision takes effect.
All but the last return the columns of ``documents``. Whole rows travel as one
struct, so a stage decides about every row, also about rows without an id or with
column names of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyloom.llm import decontaminate, minhash, packing, personal, toxicity
from tidyloom.llm.queries import contaminated, fold, tokenizer
from tidyloom.llm.store import saved, table


def _with_row(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    scored = toxicity.toxicity(_with_row(docs), table(spark, sf_dir, "labels"), fold(5) != 0, carry="row")
    return scored.where("score < 0.5").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more), the one of smallest id.

    Of rows with one id, the first text in byte order stays; rows without an id stay.
    """
    found = saved(minhash.near_duplicates(docs).where(F.col("doc_id").isNotNull()).select("doc_id", "kept"), "near-copies")
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    repeated = saved(found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    left = docs.join(saved(dropped, "dropped"), "doc_id", "left_anti").select(docs.columns)
    firsts = left.join(repeated, "doc_id", "left_semi").select(docs.columns)
    firsts = firsts.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("row")).select("row.*")
    return left.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(firsts)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate.contamination(_with_row(docs), table(spark, sf_dir, "benchmark"), carry="row")
    return found.where(~contaminated()).select("row.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    found = personal.personal_spans(_with_row(docs), carry="row")
    row = F.col("row")
    text = personal.masked(row.getField("text"), F.col("spans"))
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    # Inside a struct, a column's name cannot stand for another column of the same selection.
    return found.select(F.struct(*(changed.get(name, row.getField(name)).alias(name) for name in docs.columns)).alias("row")).select("row.*")


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens."""
    return packing.packed(docs, tokenizer())


STAGES = [
    ("toxicity", without_toxic),
    ("minhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("personal", without_personal_data),
    ("packing", in_sequences),
]

#: SQL cannot express trained models and tokenizers; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
