"""What the helpers of the operators state about nulls, repeats, empty tables and clashing names."""

from pyspark.sql import functions as F

from gridloom.llm import bpe_replay, cube_mixing, cws, pu_quality, storage, warc
from gridloom.llm import queries as q

ROWS = [(1, "one two three", "clash", 7), (1, "one two three", "clash", 7), (2, None, None, None), (3, "", "clash", 0), (4, " \t", None, 1)]
SCHEMA = "doc_id long, text string, out string, extra int"


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_fingerprints_replace_and_keep_columns(spark):
    table = spark.createDataFrame(ROWS, SCHEMA)
    got = cws.fingerprints(table, out="out", samples=16)
    assert got.columns == table.columns and cws.fingerprints(table.limit(0), out="out").count() == 0
    prints = {r["doc_id"]: r["out"] for r in got.collect()}
    assert len(prints[1]) == 64 and prints[2] == prints[3] == prints[4] == ""
    assert plain(got.select("doc_id", "extra")) == plain(table.select("doc_id", "extra"))
    assert got.where("doc_id = 1").select("out").distinct().count() == 1


def test_quality_scores_replace_and_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text"), F.lit("clash").alias("out"))
    featured = docs.withColumn("shape", F.udf(lambda t: [float(v) for v in pu_quality.features_of(t)], "array<double>")("text"))
    featured = storage.materialise(featured, "shapes")
    got = pu_quality.score(featured, pu_quality.fit(featured, F.col("doc_id") % 5 == 0, steps=20), out="out")
    assert got.columns == featured.columns and got.where("out between 0 and 1").count() == docs.count()
    assert pu_quality.score(featured.limit(0), pu_quality.fit(featured, F.lit(False), steps=2)).count() == 0


def test_decoding_nulls_repeats_and_no_rows(spark):
    path, pattern = q.byte_bpe()
    coded = bpe_replay.encode(spark.createDataFrame(ROWS, SCHEMA), path, pattern)
    coded = coded.unionByName(spark.createDataFrame([(9, None, "clash", None, None)], SCHEMA + ", token_ids binary"))
    got = bpe_replay.decode(coded, path, out="out")
    assert got.columns == coded.columns and bpe_replay.decode(coded.limit(0), path).count() == 0
    back = {r["doc_id"]: r["out"] and bytes(r["out"]).decode() for r in got.collect()}
    assert got.count() == 6 and back[1] == "one two three" and not back[2] and not back[3] and back[4] == " \t" and not back[9]


def test_repeats_of_a_mix(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(["a", "a", None, "d"])], "at long, text string, copies string")
    mixed = spark.createDataFrame([(0, 2), (1, 1), (2, 1), (3, 0), (99, 4)], "row long, copies int")
    got = cube_mixing.repeat(docs, mixed, "at")
    assert got.columns == ["text", "copies"] and plain(got) == sorted([("a", "x")] * 3 + [(None, "x")], key=repr)
    assert cube_mixing.repeat(docs.limit(0), mixed, "at").count() == 0 == cube_mixing.repeat(docs, mixed.limit(0), "at").count()


def test_archives_written_twice_and_none_at_all(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://u/1", "short"), (2, "http://u/2", "long " * 2000), (None, None, None)], "page_id long, url string, html string")
    path = str(tmp_path / "twice")
    for part in ("a", "b"):
        warc.write_archives(warc.plan_records(pages.coalesce(1)), f"{path}/{part}", segment_bytes=1000)
    one = warc.read_records(spark, f"{path}/a")
    both = one.unionByName(warc.read_records(spark, f"{path}/b"))
    assert both.count() == 2 * one.count()
    whole = warc.with_payload(warc.reassemble(both).withColumn("payload", F.lit("clash")))
    got = [(r["complete"], bytes(r["payload"])) for r in whole.collect()]
    assert sorted(got) == sorted([(True, b"short")] * 2 + [(True, b"long " * 2000)] + [(True, b"")] * 2)
    assert warc.with_payload(warc.reassemble(both.limit(0))).count() == 0
    (tmp_path / "nothing").mkdir()
    assert warc.read_archives(spark, str(tmp_path / "nothing")).count() == 0
