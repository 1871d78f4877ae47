"""Language identification by string kernels.

Two texts are as alike as the character n-grams that both have: with G(x) the set of a text's n-grams of
one to four characters (the blended spectrum; presence, not counts),

    k(x, z) = |G(x) & G(z)| / sqrt(|G(x)| |G(z)|).

A few landmark texts z of each language stand for the kernel's space (Nystroem): phi(x) = K^-1/2 k(x),
with k(x) the kernel to all landmarks and K that among them.  Kernel ridge regression of one language
against the rest is then a ridge regression on phi.  Rows weigh as if all languages were equally common.

k(x) is a product of x's row of n-grams present with the landmarks' matrix of them, so a batch of texts
is scored by one matrix product.  For scoring, the landmarks' matrix and the regression's weights are
multiplied beforehand: (X B) P = X (B P).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import drop_since, mark, materialise, small_batches

#: n-grams of these lengths, hashed into so many bins.
ORDERS = (1, 2, 3, 4)
BINS = 1 << 18
#: Landmarks of all languages together, and languages at most.
LANDMARKS = 256
LANGUAGES = 256
#: Texts of a language that the regression is fitted on, and characters of such a text (longer ones where a
#: language has no shorter text).
TEACHERS = 2000
TEACHER_CHARS = 4000
RIDGE = 1e-3
#: Language of a text without letters.
UNDETERMINED = "und"
_BLOCK, _ROWS = 1 << 20, 128
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Lower-cased letter of each code point (itself, where that would be two), 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def mark_grams(text: str | None, present: np.ndarray) -> bool:
    """Set the bins of all n-grams of a text; whether it has a letter.

    What is no letter counts as one space, however long, and a text begins and ends with one.
    """
    if not text:
        return False
    any_letter, tail = False, np.zeros(1, np.uint32)
    for at in range(0, len(text), _BLOCK):
        code = _letters()[np.frombuffer(text[at : at + _BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        any_letter = any_letter or bool(code.any())
        code = np.concatenate([tail, code, np.zeros(int(at + _BLOCK >= len(text)), np.uint32)])
        code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
        h = np.zeros(len(code), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if n > len(code):
                break
            h = (h[: len(code) - n + 1] + code[n - 1 :] + np.uint64(1)) * _ODD
            if n in ORDERS:
                bins = ((h ^ (h >> np.uint64(29))) * _ODD) >> np.uint64(64 - 18)
                present[bins[code[: len(bins)] != 0] if n == 1 else bins] = True
            h ^= h >> np.uint64(32)
        tail = code[-(max(ORDERS) - 1) :]  # n-grams across blocks
    return any_letter


@dataclass(frozen=True)
class Model:
    """Languages, the bins that landmarks have, and each bin's weight for each language."""

    languages: tuple[str, ...] = ()
    bins: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def score(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language of each text and the winner's share of all positive outputs (0 for no letter or no model)."""
        names, shares = [], []
        present = np.zeros(BINS, bool)
        for at in range(0, len(texts), _ROWS):
            part = texts[at : at + _ROWS]
            x, n, lettered = np.zeros((len(part), len(self.bins)), np.float32), np.ones(len(part), np.float32), []
            for i, text in enumerate(part):
                present[:] = False
                lettered.append(mark_grams(text, present))
                x[i], n[i] = present[self.bins], max(1, np.count_nonzero(present))
            outputs = (x @ self.weights) / np.sqrt(n)[:, None] if self.languages else np.zeros((len(part), 1))
            best, held = outputs.argmax(1), np.clip(outputs, 0, 1)
            for i, has in enumerate(lettered):
                names.append(self.languages[best[i]] if has and self.languages else UNDETERMINED)
                total = float(held[i].sum())
                shares.append(float(held[i, best[i]]) / total if has and total > 0 else 0.0)
        return names, shares


def _matrix(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of any of the texts, and for each text its row of them, divided by the root of its number."""
    rows = np.zeros((len(texts), BINS), bool)
    for row, text in zip(rows, texts, strict=True):
        mark_grams(text, row)
    bins = np.flatnonzero(rows.any(0))
    return bins, rows[:, bins].astype(np.float32) / np.sqrt(np.maximum(1, rows.sum(1, dtype=np.float32)))[:, None]


def _moments(bins: np.ndarray, landmarks: np.ndarray, languages: tuple[str, ...]):
    """Of a task's teachers: weighted sums of k k' and of k by language, as one row of bytes."""

    def run(batches):
        m, at = len(landmarks), {l: i for i, l in enumerate(languages)}
        square, sums = np.zeros((m, m)), np.zeros((m, len(languages)))
        present = np.zeros(BINS, bool)
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch[start : start + _ROWS]
                x, n = np.zeros((len(part), len(bins)), np.float32), np.zeros(len(part), np.float32)
                for i, text in enumerate(part["text"]):
                    present[:] = False
                    mark_grams(text, present)
                    x[i], n[i] = present[bins], max(1, np.count_nonzero(present))
                k = ((x @ landmarks.T) / np.sqrt(n)[:, None]).astype(float)
                weight = part["weight"].to_numpy(float)[:, None]
                square += (k * weight).T @ k
                for i, lang in enumerate(part["lang"]):
                    sums[:, at[lang]] += k[i] * weight[i]
        yield pd.DataFrame({"square": [square.tobytes()], "sums": [sums.tobytes()]})

    return run


def _teachers(learn: DataFrame, per_language: int, chars: int) -> tuple[DataFrame, list[str]]:
    """lang, text, nth (from 1) of at most ``per_language`` texts a language, first by a hash of all that a row
    has, equal texts once; and the languages."""
    spark = learn.sparkSession
    long = F.char_length("text")
    known = learn.groupBy("lang").agg(F.count(F.when(long <= chars, 1)).alias("n"), F.min(long).alias("least"))
    known = known.orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not known:
        return spark.createDataFrame([], "lang string, text string, nth int"), []
    # twice as many as needed are drawn by a hash, so that no language's texts are sorted whole
    share = lambda r: min(1.0, 2 * per_language / max(1, r["n"]))
    limits = spark.createDataFrame([(r["lang"], max(chars, r["least"]), int(share(r) * 2**31)) for r in known], "lang string, most long, below long")
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**31))
    chosen = learn.withColumn("drawn", drawn).join(F.broadcast(limits), "lang").where((long <= F.col("most")) & (F.col("drawn") < F.col("below")))
    chosen = chosen.groupBy("lang", "text").agg(F.min("drawn").alias("drawn"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "text"))
    return chosen.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "text", "nth"), [r["lang"] for r in known]


def fit(docs: DataFrame, held_out: Column, landmarks: int = LANDMARKS, teachers: int = TEACHERS, chars: int = TEACHER_CHARS, ridge: float = RIDGE) -> Model:
    """A model of the languages in ``lang`` from the rows that are not held out, have a language and a letter.

    ``docs`` has doc_id (only to draw by), text and lang.  The regression is fitted on a bounded sample:
    at most ``teachers`` texts a language of at most ``chars`` characters, of which the first are the
    landmarks (``landmarks`` together).  Without such rows the model knows no language.
    """
    began = mark()
    learn = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    chosen, languages = _teachers(learn, teachers, chars)
    if not languages:
        return Model()
    chosen = materialise(chosen, "teachers")
    quota = max(1, landmarks // len(languages))
    marks = chosen.where(F.col("nth") <= quota).orderBy("lang", "nth").collect()
    bins, rows = _matrix([r["text"] for r in marks])
    weight = F.lit(1.0) / F.count(F.lit(1)).over(Window.partitionBy("lang"))
    taught = small_batches(chosen).select("lang", "text", weight.alias("weight"))
    gathered = taught.mapInPandas(_moments(bins, rows, tuple(languages)), "square binary, sums binary").collect()
    drop_since(docs.sparkSession, began)
    m = len(rows)
    square = sum(np.frombuffer(r["square"]).reshape(m, m) for r in gathered)
    sums = sum(np.frombuffer(r["sums"]).reshape(m, len(languages)) for r in gathered)
    values, vectors = np.linalg.eigh((rows @ rows.T).astype(float))
    root = vectors / np.sqrt(np.maximum(values, 1e-8 * max(values.max(), 1e-8))) @ vectors.T
    solved = np.linalg.solve(root @ square @ root + ridge * len(languages) * np.eye(m), root @ sums)
    return Model(tuple(languages), bins, (rows.T @ (root @ solved).astype(np.float32)).astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with lang_pred and lang_score (0 to 1), by the column text alone.

    Null, empty and letterless texts are ``und`` with score 0; so is every text if the model knows no
    language.  Whole texts are read, however long.  Equal texts have equal results; ties go to the first
    language by name.  Other columns stay (lang_pred and lang_score are replaced), and so do repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def scored(text: pd.Series) -> pd.DataFrame:
        names, shares = shared.value.score([t if isinstance(t, str) else None for t in text])
        return pd.DataFrame({"lang": names, "score": shares})

    found = small_batches(docs).withColumn("_found", scored("text"))
    return found.withColumns({"lang_pred": F.col("_found.lang"), "lang_score": F.col("_found.score")}).drop("_found")
