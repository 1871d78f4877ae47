"""From raw documents to tokens: quality, toxicity, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the
columns of documents; the last returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bpe_replay, cube_mixing, lsh_forest, pu_quality, zstd_toxicity
from gridloom.llm import queries as q
from gridloom.llm.storage import drop_since, mark, materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """The documents with ``_at``, a number for each row, as a written table: rows keep their numbers."""
    return materialise(docs.select(*COLUMNS).withColumn("_at", F.monotonically_increasing_id()), name)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score at least 0.7).

    Each row is decided by its own text, so null and repeated ids need no care; null and empty texts have
    the score of texts without shape.  Extra columns are dropped; an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality.classify(docs, labels, q._fold(4, 2), carry=COLUMNS[1:]).where("quality_ok").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject (score below 0.5).

    Each row is decided by its own text; null and empty texts score 0 and stay.  Extra columns are
    dropped; an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return zstd_toxicity.classify(docs, labels, q._fold(5, 0), carry=COLUMNS[1:]).where("not toxic").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8): that of the smallest
    doc_id, null ids last, the smallest digest of the text among equal ids.

    Rows are told apart by their place in the table, so those with null or repeated ids are compared by
    their texts; null and empty texts are no duplicates of each other.  Extra columns are dropped; an
    empty table gives an empty one.
    """
    rows = _rows(docs, "near-rows")
    found = lsh_forest.near_duplicates(rows.select(F.col("_at").alias("doc_id"), "text"), width=5, num=80, den=100)
    names = rows.select("_at", F.col("doc_id").alias("_id"), F.sha2("text", 256).alias("_digest"))
    members = found.select(F.col("doc_id").alias("_at"), "component_id").join(names, "_at")
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_digest", "_at"))
    kept = members.groupBy("component_id").agg(first.alias("first")).select(F.col("first._at").alias("_at"))
    return rows.join(kept, "_at", "left_semi").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice.

    Every row is a document of its own, with a null or repeated id too; null texts have size 0, a null
    source is a source.  Extra columns are dropped; an empty table gives an empty one.
    """
    rows = _rows(docs, "mix-rows")
    return cube_mixing.repeat(rows, cube_mixing.mix(rows, row="_at"), "_at").select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether decoding them gives its text back; a null text has no ids and
    counts as empty.  Extra columns are dropped; an empty table gives an empty one."""
    path, pattern = q.byte_bpe()
    coded = bpe_replay.round_trip(docs.select("doc_id", "source", "text"), path, pattern, cut_at_spaces=True)
    return coded.select(
        "doc_id",
        "source",
        "token_ids",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: The classifiers and the sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    began = mark()
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_since(spark, began, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
