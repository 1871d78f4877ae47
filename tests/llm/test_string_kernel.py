"""String kernels against sets of n-grams and kernel ridge regression in full, held-out accuracy, awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
from gridloom.llm import queries as q
from gridloom.llm import string_kernel as sk
from pyspark.sql import functions as F


def grams(text):
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    low = " " + " ".join(low.split(" ")).strip() + " " if low.strip() else " "
    while "  " in low:
        low = low.replace("  ", " ")
    return {low[i : i + n] for n in sk.ORDERS for i in range(len(low) - n + 1)} - {" "}


def marked(text):
    present = np.zeros(sk.BINS, bool)
    sk.mark_grams(text, present)
    return present


@pytest.mark.parametrize("text", ["a", "Über uns!", "it's  12 o'clock\n", "été ÉTÉ", "日本語 テスト", "..a..", "x" * 50, "aİb"])
def test_bins_are_those_of_the_sets_of_grams(text):
    assert abs(int(marked(text).sum()) - len(grams(text))) <= 1  # two may share a bin


def test_kernel_equals_the_sets():
    texts = ["The cat sat on the mat.", "the CAT sat!", "Der Hund schläft.", "le chat dort"]
    _, rows = sk._matrix(texts)
    want = [[len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b))) for b in texts] for a in texts]
    assert np.allclose(rows @ rows.T, want, atol=0.02)


def test_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = "Straße, été 12 — niño " * 300
    whole = marked(text)
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(sk, "_BLOCK", size)
        assert (marked(text) == whole).all(), size


def test_outputs_equal_kernel_ridge_regression_on_landmark_features(spark):
    rng = np.random.default_rng(2)
    words = {"aa": ["the", "and", "king", "ring"], "bb": ["der", "und", "könig", "ring"]}
    rows = [(i, " ".join(rng.choice(words[lang], 6)), lang) for i, lang in enumerate(["aa"] * 30 + ["bb"] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = sk.fit(docs, F.lit(False), landmarks=1000, ridge=0.1)  # all texts are landmarks: plain kernel ridge regression
    texts = sorted({(t, lang) for _, t, lang in rows})
    k = sk._matrix([t for t, _ in texts])[1]
    k = (k @ k.T).astype(float)
    sizes = {lang: sum(other == lang for _, other in texts) for lang in words}
    weight = np.array([1 / sizes[lang] for _, lang in texts])
    y = np.array([[lang == other for other in ("aa", "bb")] for _, lang in texts], float)
    alpha = np.linalg.solve(np.diag(weight) @ k + 0.1 * 2 * np.eye(len(texts)), weight[:, None] * y)
    want = k @ alpha
    present = np.array([marked(t)[model.bins] for t, _ in texts], np.float32)
    norm = np.sqrt([marked(t).sum() for t, _ in texts])[:, None]
    assert model.languages == ("aa", "bb") and np.allclose(present @ model.weights / norm, want, atol=2e-3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = q.op12_string_kernel(spark, sf).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held) > 100
    assert all(r["lang"] == r["lang_pred"] for r in held if r["n_chars"] >= 200)


def test_sampled_teachers_are_bounded_and_enough(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    chosen, languages = sk._teachers(docs.select("doc_id", "text", "lang"), 20, 3000)
    counts = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    assert set(counts) == set(languages) and all(10 <= n <= 20 for n in counts.values())
    assert chosen.agg(F.max(F.char_length("text"))).head()[0] <= 3000
    model = sk.fit(docs, F.lit(False), landmarks=16, teachers=20, chars=3000)
    found = sk.identify(docs, model).where("n_chars >= 500")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_awkward_rows(spark, tmp_path):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("", "de"), (None, "en"), ("12 !", "fr"), ("the dog", None)] * 3)]
    rows += [rows[0], (None, "und der Hund", None), (91, "the " * 100_000 + "z", None), (92, "cat", "x" * 9)]
    table = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    found = sk.identify(table, sk.fit(table, F.lit(False)))
    assert sorted(found.columns) == sorted([*table.columns, "lang_score"]) and found.count() == len(rows)
    by = {(r["text"], r["lang_pred"], round(r["lang_score"], 6)) for r in found.collect()}
    assert len({t for t, _, _ in by}) == len(by)  # equal texts alike
    named = {t: (lang, s) for t, lang, s in by}
    assert named[None] == named[""] == named["12 !"] == ("und", 0.0)
    assert named["und der Hund"][0] == "de" and named["the dog"][0] == "en" and named["the " * 100_000 + "z"][0] == "en"
    empty = sk.identify(table.limit(0), sk.fit(table.limit(0), F.lit(False)))
    assert empty.count() == 0
    untaught = sk.identify(table, sk.fit(table, F.lit(True))).select("lang_pred", "lang_score").distinct().collect()
    assert [tuple(r) for r in untaught] == [("und", 0.0)]
    table.write.parquet(str(tmp_path / "documents.parquet"))
    assert q.op12_string_kernel(spark, str(tmp_path)).columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_a_language_of_long_texts_only_is_learnt(spark):
    rows = [(i, "alpha beta gamma " * 20 if i % 2 else "uno dos tres", "el" if i % 2 else "es") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = sk.fit(docs, F.lit(False), chars=50)
    assert model.languages == ("el", "es") and model.score(["beta gamma", "dos"])[0] == ["el", "es"]
    with pytest.raises(ValueError, match="languages"):
        sk.fit(docs.withColumn("lang", F.concat("lang", F.col("doc_id").cast("string"))).crossJoin(spark.range(40).toDF("n")).withColumn("lang", F.concat("lang", F.lit("-"), "n")), F.lit(False))
