"""Document fingerprints by consistent weighted sampling.

A text is a bag of word pairs weighted by their counts.  For each of ``samples`` draws, every
weighted term S(k) has gamma-distributed r, c ~ Gamma(2, 1) and b ~ U(0, 1) that depend on the term
and the draw alone; with t = floor(ln S / r + b) and ln a = ln c - r (t - b) - r the draw keeps the
(k, t) of least a.  Two texts agree on a draw with a probability equal to the generalised Jaccard
similarity sum(min)/sum(max) of their weights.

The edited text needs the next document by id, so documents are dealt to id ranges; the first
document of every range is also sent, as a follower, to the range before it.  One shuffle of the
texts, no window over the whole table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import small_batches
from .words import mix, shingle_hashes, word_hashes

SAMPLES = 64
_ROWS = 512  # terms at a time, so that a block stays in the processor's cache


def _gamma2_quantiles(bits: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    low, high = np.zeros_like(p), np.full_like(p, 60.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


class Sampler:
    """Signatures of ``samples`` 16-bit draws for bags of words."""

    def __init__(self, samples: int = SAMPLES, width: int = 2) -> None:
        self.samples, self.width = samples, width
        self._seeds = (mix(np.arange(1, samples + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None]
        gamma = _gamma2_quantiles(8)
        self._r = np.repeat(gamma, 256).astype(np.float32)  # 8 bits choose r, 8 bits b
        self._b = np.tile((np.arange(256) + 0.5) / 256, 256).astype(np.float32)
        self._light = self._r * (self._b - 1)  # ln(a / c) of a term of weight 1, whose t is 0
        self._log_c = np.log(_gamma2_quantiles(16)).astype(np.float32)
        self._draw = np.arange(samples)

    def terms(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the distinct word pairs of a text, and how often each stands in it."""
        hashes = np.sort(shingle_hashes(word_hashes(text), self.width))
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
        return hashes[first], np.diff(np.append(first, len(hashes)))

    def __call__(self, text: str | None) -> np.ndarray:
        """The draws; a text without words has none."""
        terms, weights = self.terms(text)
        if not len(terms):
            return np.zeros(0, np.uint16)
        best = np.full(self.samples, np.inf, np.float32)
        kept = np.zeros(self.samples, np.uint64)
        for at in range(0, len(terms), _ROWS):
            h, w = terms[at : at + _ROWS], weights[at : at + _ROWS]
            z = (h >> np.uint64(32)).astype(np.uint32) ^ self._seeds
            z *= np.uint32(0x7FEB352D)
            z ^= z >> np.uint32(15)
            z *= np.uint32(0x846CA68B)
            z ^= z >> np.uint32(16)
            choice = (z >> np.uint32(16)).astype(np.intp)
            log_a = self._log_c.take((z & np.uint32(0xFFFF)).astype(np.intp))
            log_a += self._light.take(choice)
            heavy = np.flatnonzero(w > 1)
            if len(heavy):
                r, b = self._r[choice[:, heavy]], self._b[choice[:, heavy]]
                t = np.floor(np.log(w[heavy]).astype(np.float32) / r + b)
                log_a[:, heavy] -= r * t
            k = log_a.argmin(1)
            least = log_a[self._draw, k]
            less = least < best
            best = np.where(less, least, best)
            r, b = self._r[choice[self._draw, k]], self._b[choice[self._draw, k]]
            steps = np.floor(np.log(w[k]).astype(np.float32) / r + b).astype(np.int64).astype(np.uint64)
            kept = np.where(less, mix(h[k] + steps * np.uint64(0x9E3779B97F4A7C15)), kept)
        return (kept >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal draws: 1 for two texts without words, 0 if only one has none."""
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean()) if len(a) else 1.0


def fingerprints(docs: DataFrame, text: str = "text", samples: int = SAMPLES, out: str = "fingerprint") -> DataFrame:
    """Add ``out``: the fingerprint of a text in hex, four digits a draw; '' without words or text.

    Repeated rows are alike, an empty table gives an empty one; a column called ``out`` is replaced, others stay.
    """

    @F.pandas_udf(T.StringType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sampler = Sampler(samples)
        for texts in batches:
            yield texts.map(lambda t: sampler(t).astype(">u2").tobytes().hex())

    return small_batches(docs).withColumn(out, of(F.col(f"`{text}`")))


def edited(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by as much of the next text as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bounds(docs: DataFrame, parts: int) -> np.ndarray:
    """Ids that split the documents into about ``parts`` ranges; as many numbers as parts at most."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 20 * parts).alias("cuts")).head()["cuts"] if parts > 1 else None
    return np.unique(np.array(cuts if cuts else [], np.int64))


SUCCESSOR_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def successor_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text and of its text edited with the next document's, and their likeness.

    Next is by ascending doc_id, equal ids by text; the last is followed by the first, a single
    document by itself.  A null text counts as empty, a null doc_id as before all others.  Columns
    but doc_id and text are not looked at; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bounds = _bounds(docs, parts)

    @F.pandas_udf(T.IntegerType())
    def range_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(ids.isna(), 0, at).astype(np.int32))

    ranges = docs.select("doc_id").withColumn("range", range_of("doc_id"))
    firsts = [(r["range"], r["lowest"], r["holes"]) for r in ranges.groupBy("range").agg(F.min("doc_id").alias("lowest"), F.max(F.col("doc_id").isNull()).alias("holes")).collect()]
    firsts.sort()
    before = {(None if holes else lowest): firsts[i - 1][0] for i, (_, lowest, holes) in enumerate(firsts)}
    placed = docs.withColumn("range", range_of("doc_id")).withColumn("follows", F.lit(0))
    heads = [i for i in before if i is not None]
    first_of_range = F.col("doc_id").isin(heads) if heads else F.lit(False)
    if None in before:
        first_of_range = first_of_range | F.col("doc_id").isNull()

    @F.pandas_udf(T.IntegerType())
    def range_before(ids: pd.Series) -> pd.Series:
        return pd.Series([before[None if pd.isna(i) else int(i)] for i in ids], dtype="int32")

    followers = docs.where(first_of_range).select("doc_id", "text", range_before("doc_id").alias("range"), F.lit(1).alias("follows"))
    dealt = placed.unionByName(followers).repartition(parts, "range").sortWithinPartitions("range", "follows", F.asc_nulls_first("doc_id"), "text")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(samples)
        held = None
        for batch in batches:
            out = []
            for doc_id, text, part, follows in zip(batch["doc_id"], batch["text"], batch["range"], batch["follows"], strict=True):
                if held is not None and held[2] == part and not held[3]:
                    draws = sampler(text)
                    out.append(_row(held, text, draws, sampler))
                elif not follows:
                    draws = sampler(text)
                else:
                    draws = None
                held = (doc_id, text, part, follows, draws)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SUCCESSOR_SCHEMA.split(", ")]).astype({"doc_id": "Int64", "n_chars": "int64"})

    return small_batches(dealt).mapInPandas(walk, SUCCESSOR_SCHEMA)


def _row(held: tuple, following: str, next_draws: np.ndarray, sampler: Sampler) -> tuple:
    doc_id, text, _, _, draws = held
    changed = edited(text, following)
    changed_draws = sampler(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (None if pd.isna(doc_id) else int(doc_id), len(text), digest, draws.astype(">u2").tobytes().hex(), changed_draws.astype(">u2").tobytes().hex(), likeness(draws, changed_draws), likeness(draws, next_draws))
