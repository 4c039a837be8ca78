"""The corpus pipeline: five operators of ``costloom.llm`` in a row over ``documents``.

Every stage works on all rows its predecessor kept and, but for the last, returns the columns
of ``documents`` (one row per kept document row). Defined cases are those of the operators. A
stage decides on rows, by a written row key, so rows that share a doc_id or have none are
judged each by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costloom.llm import decontaminate, ngram_join, quality, secrets, sentencepiece
from costloom.llm.common import materialize, read_table
from costloom.llm.queries import piece_model_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` and a row key, written so that it stays the same."""
    return materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")


def by_row(rows: DataFrame) -> DataFrame:
    """The texts under their row keys, for operators that name a row by its doc_id."""
    return rows.select(F.col("row").alias("doc_id"), "text")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels teach, they decide on no document."""
    rows = keyed(docs)
    scores = quality.score_documents(rows, read_table(spark, sf_dir, "labels"), keep=("row",))
    return rows.join(scores.where("predicted = 0").select("row"), "row", "left_anti").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (runs of five words, Jaccard similarity of 0.8 or more) the
    one row with the smallest doc_id (a null one comes last)."""
    rows = keyed(docs)
    groups = ngram_join.group_documents(by_row(rows), ngram_join.JoinParams(width=5, percent=80))
    members = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = members.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = keyed(docs)
    found = decontaminate.find_matches(by_row(rows), read_table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("row")).distinct()
    return rows.join(found, "row", "left_anti").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mask; n_chars follows the text."""
    docs = docs.select(*COLUMNS)
    clean = secrets.redact(secrets.scan(docs, keep=("lang", "source", "n_chars")))
    hit = F.size("spans") > 0
    return clean.select("doc_id", F.col("redacted").alias("text"), "lang", "source",
                        F.when(hit, F.char_length("redacted")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of each text, their number, and whether they decode to it."""
    docs = docs.select(*COLUMNS)
    model = sentencepiece.load_model(piece_model_path())
    done = sentencepiece.encode(docs, model, keep=("lang", "source"), decoded=True)
    return done.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [("quality", quality_stage), ("near duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("secrets", secret_stage), ("tokens", token_stage)]
#: Stages fit models and tokenize, which SQL cannot express; a test runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
