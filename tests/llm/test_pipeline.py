"""The pipeline's stages one by one, and as a whole."""

from __future__ import annotations

import corpus_pipeline
from gridloom.llm import cube_mixing
from pyspark.sql import functions as F
from tests.llm.test_operators import exact_components


def test_stages_keep_the_columns_and_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "toxicity", "near_dedup", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and 0.6 * docs.count() < kept.count() <= docs.count(), name
    kept = corpus_pipeline.near_dedup(spark, docs, sf)
    groups = exact_components([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups.values()))
    mixed = corpus_pipeline.mixing(spark, docs, sf)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in cube_mixing.mix(docs).collect())


def test_run_gives_tokens_that_decode(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) // 4 for r in out)


def test_rows_of_null_and_repeated_ids_are_decided_by_their_texts(spark, sf):
    for at, stage in enumerate((corpus_pipeline.quality_classifier, corpus_pipeline.toxicity)):
        all_rows = spark.read.parquet(f"{sf}/documents.parquet")
        passed = {r["text"] for r in stage(spark, all_rows, sf).collect()}
        for same in (None, 10_000_000):
            copies = spark.createDataFrame([(same, *r[1:]) for r in all_rows.collect()], all_rows.schema)
            kept = [r["text"] for r in stage(spark, all_rows.unionByName(copies), sf).where(F.col("doc_id").eqNullSafe(F.lit(same))).collect()]
            assert 0 < len(kept) < copies.count(), at
            if stage is corpus_pipeline.toxicity:  # its model learns from labelled ids only
                assert sorted(map(str, kept)) == sorted(str(r["text"]) for r in all_rows.collect() if r["text"] in passed)
    texts = [" ".join(f"{word}{i}" for i in range(30)) for word in ("a", "b", "c")]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[0]), (7, texts[2]), (9, texts[1])]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, table, sf).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(7, texts[0]), (7, texts[2]), (9, texts[1])])


def test_stages_on_nulls_repeats_clashing_columns_and_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (5, None, "en", None, None), (5, long, None, "s", 1), (5, long, None, "s", 1), (6, " \n", "en", "s", 2)]
    odd = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    clash = odd.select("*", *[F.lit(1).alias(c) for c in ("shape", "_trusted", "toxicity", "toxic", "_at", "row", "copies", "size", "component_id", "kept", "token_ids", "_digest")])
    for name, stage in corpus_pipeline.STAGES:
        a, b = (stage(spark, table, sf) for table in (odd, clash))
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
        assert stage(spark, clash.limit(0), sf).count() == 0, name
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, odd, sf).collect()]
    assert sum(t == long for _, t in kept) == 1 and kept.count((None, None)) == kept.count((None, "")) == kept.count((5, None)) == kept.count((6, " \n")) == 1
    assert len(corpus_pipeline.bpe(spark, odd, sf).collect()) == odd.count()
