"""One query for each training-data operator, over its whole table, and the SQL that some have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_replay, conversation_repair, cube_mixing, cws, license_rules, lsh_forest, pu_quality, string_kernel, threshold_topk, url_templates, vantage_tree, warc, zstd_toxicity
from .storage import fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def op1_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, sf_dir, "documents"), width=2, num=80, den=100)


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _fold(4, 2)
    scored = pu_quality.classify(docs, _table(spark, sf_dir, "labels"), held_out, threshold=0.7)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_ok").cast("int").alias("predicted"))


def op3_cws_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.successor_fingerprints(_table(spark, sf_dir, "documents"))


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_rules.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.size("licenses").alias("n_licenses"))


def op7_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _fold(5, 0)
    scored = zstd_toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out, threshold=0.5)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").cast("int").alias("predicted"))


def byte_bpe() -> tuple[str, str]:
    """Rank file and pattern of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op6_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = byte_bpe()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_replay.round_trip(docs, path, pattern, cut_at_spaces=True)
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = threshold_topk.quantised(_table(spark, sf_dir, "embeddings"))
    return threshold_topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    warc.write_archives(warc.plan_records(_table(spark, sf_dir, "pages")), path)
    records = warc.read_archives(spark, path)
    revisit = F.col("kind") == "revisit"
    return records.select(
        "page_id",
        F.when(revisit, F.col("stated_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_templates.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "block_rate")


def op10_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_vantage_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vantage_tree.labelled(_table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return vantage_tree.hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0), positives=5, k=3, low=50, high=95)


def op12_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _fold(4, 2)
    found = string_kernel.identify(docs.select("doc_id", "text"), string_kernel.fit(docs, held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Conversations with a fifth of their turns damaged in five ways, told by a checksum of conv_id and
    turn; a dropped turn stays as a row that is ``absent``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    way = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = rows.withColumn("way", way).withColumn("times", F.explode(F.array_repeat(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1))))
    spoilt = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), spoilt.alias("text"), (F.col("way") == 0).alias("absent"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged_turns(_table(spark, sf_dir, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(turns, absent=F.col("absent")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lsh_forest": op1_lsh_forest,
        "op2_pu_quality": op2_pu_quality,
        "op3_cws_fingerprints": op3_cws_fingerprints,
        "op4_threshold_topk": op4_threshold_topk,
        "op5_license_rules": op5_license_rules,
        "op6_bpe_replay": op6_bpe_replay,
        "op7_zstd_toxicity": op7_zstd_toxicity,
        "op8_warc_segments": op8_warc_segments,
        "op9_url_templates": op9_url_templates,
        "op10_cube_mixing": op10_cube_mixing,
        "op11_vantage_tree": op11_vantage_tree,
        "op12_string_kernel": op12_string_kernel,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_threshold_topk": """
            WITH v AS (
                SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
                FROM embeddings
                WHERE embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            ), pairs AS (
                SELECT q.vec_id AS query_id, c.vec_id,
                       CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
                FROM v q JOIN v c ON q.vec_id <> c.vec_id
                WHERE q.vec_id % 50 = 0
            ), ranked AS (
                SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
            )
            SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
        """,
        "op11_vantage_tree": """
            WITH v AS (
                SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                       list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            ), pairs AS (
                SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                       CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
                FROM v a JOIN v c ON a.vec_id <> c.vec_id
                WHERE a.vec_id % 50 = 0
            ), positives AS (
                SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
            ), negatives AS (
                SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
                       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
                FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
                 AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
            )
            SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
        """,
        "op8_warc_segments": """
            WITH p AS (
                SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
            ), g AS (
                SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keeper FROM p
            )
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN keeper IS NULL OR keeper = page_id THEN NULL ELSE keeper END AS refers_to
            FROM g
        """,
    }
