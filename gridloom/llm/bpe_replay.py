"""Byte-level BPE by corpus-level merge replay.

The distinct words of a slice of the corpus (the pre-tokens of the rows that a task has in hand) are
laid out in one symbol array.  An inverted index goes from the rank of a mergeable pair to the
positions where that pair stands; merges are applied in rank order, each to all of its positions, and
only the two neighbours of a merged symbol are indexed anew.  Distinct words are few against the text,
so each is merged once and looked up after that.

The index holds ranks in blocks of ``BLOCK``.  Within a block every word takes its own lowest pending
pair at a time, which is rank order for each word (words do not touch each other), so one numpy step
serves all words.  Slices are tasks' own batches: nothing is shuffled, collected or broadcast but the
vocabulary file, which every Python worker reads by its path.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import small_batches, trim_memory

#: Words and cuts whose ids a task keeps before it forgets them all.
_WORDS_KEPT = 400_000
_SLICE_CHARS = 2_000_000
#: Bytes of distinct words that are laid out at once; a longer word is laid out by itself.
_BYTES_AT_ONCE = 1 << 20
_DECODED_AT_ONCE = 1 << 20
BLOCK = 256
_NEVER = np.int32(2**31 - 1)
_PLACE = (1 << 32) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class MergeReplay:
    """Replays ranked merges over many words at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        # rank of every pair of tokens that joins to a token
        pairs = {
            left << 32 | right: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        }
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        order = np.argsort(keys)
        self._keys, self._values = np.append(keys[order], np.iinfo(np.int64).max), np.append(values[order], _NEVER).astype(np.int32)
        self._single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._first = self._rank_of(np.repeat(self._single, 256), np.tile(self._single, 256)).reshape(256, 256)
        # a merge after which no lower rank can come up leaves the word's other places of its rank as they are
        top = max(ranks.values(), default=0) + 1
        self._blocks = top // BLOCK + 1
        self._steady = np.ones(top, bool)
        for part in (keys >> 32, keys & _PLACE):
            self._steady[part[values < part]] = False

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._values[at], _NEVER)

    def __call__(self, words: Sequence[bytes]) -> list[list[int]]:
        """Token ids of each word: the lowest-ranked pair of a word merges first, the leftmost on ties.

        A word that is itself a token is that token.
        """
        ids, counts = self.flat(words)
        return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] if len(words) else []

    def flat(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each word has."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        split = np.flatnonzero(whole < 0)
        ids, counts, at = [], [], 0
        length = np.cumsum([len(words[i]) for i in split]) if len(split) else np.zeros(0, np.int64)
        while at < len(split):
            done = length[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(length, done + _BYTES_AT_ONCE, "right")))
            part = self._merged([words[i] for i in split[at:stop]])
            ids.append(part[0])
            counts.append(part[1])
            at = stop
        n = np.ones(len(words), np.int64)
        if not len(split):
            return whole.astype(np.uint32), n
        n[split] = np.concatenate(counts)
        out = np.repeat(whole, n)
        out[out < 0] = np.concatenate(ids)
        return out.astype(np.uint32), n

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(words), np.uint8)
        length = np.fromiter(map(len, words), np.int64, len(words))
        n = len(raw)
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        symbol = np.append(self._single[raw], np.int32(-1))
        after = np.arange(1, n + 2, dtype=np.int32)  # n stands for none
        before = np.arange(-1, n, dtype=np.int32)  # -1 for none
        stops = np.cumsum(length)
        after[stops[length > 0] - 1] = n
        before[(stops - length)[length > 0]] = -1
        now = np.full(n + 1, _NEVER, np.int32)  # rank of the pair that a place begins
        inner = np.flatnonzero(after[:n] != n)
        now[inner] = self._first[raw[inner], raw[after[inner]]]
        index: list[list[np.ndarray]] = [[] for _ in range(self._blocks)]
        least = np.zeros(len(words), np.int32)
        marked = np.zeros(n + 1, bool)

        def file(entries: np.ndarray) -> None:
            entries = np.sort(entries)
            block = (entries >> 32) // BLOCK
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(entries)]):
                index[block[a]].append(entries[a:b])

        begin = np.flatnonzero(now != _NEVER)
        file(now[begin].astype(np.int64) << 32 | begin)
        for block in range(self._blocks):
            pending = np.concatenate(index[block]) if index[block] else np.zeros(0, np.int64)
            index[block] = []
            later: list[np.ndarray] = []
            while len(pending):
                pending = np.sort(pending)
                rank, place = (pending >> 32).astype(np.int32), pending & _PLACE
                holds = now[place] == rank
                pending, rank, place = pending[holds], rank[holds], place[holds]
                if not len(pending):
                    break
                owner = word[place]
                least[owner[::-1]] = rank[::-1]  # the last one written, the lowest, stays
                ready = np.flatnonzero(rank == least[owner])
                r, p, w = rank[ready], place[ready], owner[ready]
                q = after[p]
                # of places that overlap every second one merges; where a lower rank may come up, one a word
                goes_on = np.zeros(len(ready), bool)
                goes_on[1:] = q[:-1] == p[1:]
                row = np.arange(len(ready))
                take = (row - np.maximum.accumulate(np.where(goes_on, 0, row))) % 2 == 0
                take[1:] &= self._steady[r[1:]] | (w[1:] != w[:-1]) | (r[1:] != r[:-1])
                r, p, q = r[take], p[take], q[take]
                pending = np.delete(pending, ready[take])
                k = after[q]
                symbol[p], symbol[q], now[q] = r, -1, _NEVER
                after[p], before[k] = k, p
                left = before[p]
                marked[p] = True
                left = left[left >= 0]
                left = left[~marked[left]]
                marked[p] = False
                now[p] = _NEVER
                touched = np.concatenate([p[after[p] != n], left])
                new = self._rank_of(symbol[touched], symbol[after[touched]])
                now[touched] = new
                fits = new != _NEVER
                entries = new[fits].astype(np.int64) << 32 | touched[fits]
                soon = new[fits] < (block + 1) * BLOCK
                pending = np.concatenate([pending, entries[soon]])
                later.append(entries[~soon])
            if later:
                file(np.concatenate(later))
        kept = symbol[:n] >= 0
        return symbol[:n][kept], np.bincount(word[kept], minlength=len(words))


_LATE_SPACE = regex.compile(r"\s ")


class _Known:
    """Ids of words and cuts that a task has met: string -> code -> run of ids."""

    def __init__(self, replay: MergeReplay, find) -> None:
        self.replay, self.find = replay, find
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.ids, self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._add([""], self.ids, np.zeros(1, np.int64))

    def _add(self, names: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        base = len(self.count)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(counts) - counts])
        self.count, self.ids = np.concatenate([self.count, counts]), np.concatenate([self.ids, ids])
        self.code.update(zip(names, range(base, base + len(names)), strict=True))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of codes, and how many each has."""
        counts = self.count[codes]
        ends = np.cumsum(counts)
        at = np.repeat(self.start[codes] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], counts

    def _split(self, cuts: list[str]) -> tuple[list[str], np.ndarray]:
        """Matches in all cuts, and their number in each."""
        matches = self.find("".join(cuts))
        ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        wanted = np.cumsum(np.fromiter(map(len, cuts), np.int64, len(cuts)))
        at = np.searchsorted(ends, wanted)
        if len(at) and (at[-1] >= len(ends) or (ends[at] != wanted).any()):  # the pattern leaves characters out
            found = [self.find(s) for s in cuts]
            return [m for f in found for m in f], np.fromiter(map(len, found), np.int64, len(found))
        return matches, np.diff(at + 1, prepend=0)

    def learn(self, names: list[str]) -> None:
        """Make codes for distinct strings: matches of the pattern, or cuts that hold several of them."""
        fresh = [s for s in names if s not in self.code]
        if not fresh:
            return
        # one search over all cuts that begin at a space and end in none, each of the others by itself
        joined = [s for s in fresh if s[0] == " " and not s[-1].isspace()]
        matches, counts = self._split(joined)
        other = [s for s in fresh if s[0] != " " or s[-1].isspace()]
        found = [self.find(s) for s in other]
        matches += [m for f in found for m in f]
        counts = np.concatenate([counts, np.fromiter(map(len, found), np.int64, len(found))])
        words = list(set(matches).difference(self.code))
        self._add(words, *self.replay.flat([w.encode("utf-8", "replace") for w in words]))
        several = np.flatnonzero(counts != 1)
        if len(several):
            cuts = joined + other
            stops = np.cumsum(counts)
            parts = [matches[stops[i] - counts[i] : stops[i]] for i in several]
            code = self.code
            ids, each = self.gather(np.fromiter((code[m] for part in parts for m in part), np.int64, int(counts[several].sum())))
            sums = np.concatenate(([0], np.cumsum(each)))
            edge = np.concatenate(([0], np.cumsum(counts[several])))
            self._add([cuts[i] for i in several], ids, np.diff(sums[edge]))


def _encoder(path: str, pattern: str, cut_at_spaces: bool):
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trim_memory()
        find = regex.compile(pattern).findall
        known = _Known(MergeReplay(load_ranks(path)), find)

        def plain_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Codes of the cuts of texts, and their number in each text."""
            cuts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
            offsets = cuts.offsets.to_numpy()
            table = cuts.flatten().dictionary_encode()
            names, at = table.dictionary.to_numpy(zero_copy_only=False).tolist(), table.indices.to_numpy()
            first = np.zeros(len(at), bool)
            first[offsets[:-1]] = True
            spaced = np.flatnonzero(np.bincount(at[~first], minlength=len(names)))
            after_space = [" " + names[i] for i in spaced]
            heads = [names[i] for i in at[first]]
            known.learn(after_space)
            known.learn(list(dict.fromkeys(heads)))
            code = np.zeros(len(names), np.int64)
            code[spaced] = [known.code[s] for s in after_space]
            codes = code[at]
            codes[first] = [known.code[s] for s in heads]
            return codes, np.diff(offsets)

        def other_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [find(t) for t in texts]
            known.learn(list({m for f in found for m in f}))
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((known.code[m] for f in found for m in f), np.int64, int(counts.sum())), counts

        def slice_ids(texts: list[str | None]) -> list[bytes]:
            collects = gc.isenabled()
            gc.disable()  # many strings are made, and no cycles
            try:
                return ids_of(texts)
            finally:
                if collects:
                    gc.enable()

        def ids_of(texts: list[str | None]) -> list[bytes]:
            out = [b""] * len(texts)
            if len(known.code) > _WORDS_KEPT:
                known.forget()
            plain = [bool(cut_at_spaces and t and not _LATE_SPACE.search(t)) for t in texts]
            for codes_of, wanted in ((plain_codes, True), (other_codes, False)):
                rows = [i for i, t in enumerate(texts) if t and plain[i] == wanted]
                if rows:
                    codes, cuts = codes_of([texts[i] for i in rows])
                    ids, counts = known.gather(codes)
                    sums = np.concatenate(([0], np.cumsum(counts)))
                    stops = (4 * sums[np.concatenate(([0], np.cumsum(cuts)))]).tolist()
                    packed = ids.astype("<u4").tobytes()
                    for i, a, b in zip(rows, stops, stops[1:]):
                        out[i] = packed[a:b]
            return out

        for texts in batches:
            out: list[bytes] = []
            held: list[str | None] = []
            size = 0
            for text in texts:
                held.append(text)
                size += len(text or "")
                if size >= _SLICE_CHARS:
                    out += slice_ids(held)
                    held, size = [], 0
            yield pd.Series(out + slice_ids(held), dtype=object)

    return encode


def _text_of(path: str):
    """A function from packed ids to the bytes they stand for."""
    tokens = load_ranks(path)
    ids = np.fromiter(tokens.values(), np.int64, len(tokens))
    size = np.zeros(ids.max() + 1, np.int64)
    size[ids] = np.fromiter(map(len, tokens), np.int64, len(tokens))
    start = np.zeros(len(size), np.int64)
    start[ids] = np.cumsum(size[ids]) - size[ids]
    letters = np.frombuffer(b"".join(tokens), np.uint8)

    def text_of(packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", "<u4")
        out = []
        for at in range(0, len(ids), _DECODED_AT_ONCE):
            part = ids[at : at + _DECODED_AT_ONCE]
            length = size[part]
            stop = np.cumsum(length)
            shift = np.repeat(start[part] - stop + length, length)
            out.append(letters[np.arange(len(shift)) + shift].tobytes())
        return b"".join(out)

    return text_of


def _decoder(path: str):
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        text_of = _text_of(path)
        for packed in batches:
            yield pd.Series([text_of(b) for b in packed], dtype=object)

    return decode


def _round_tripper(path: str, pattern: str, cut_at_spaces: bool):
    encode = _encoder(path, pattern, cut_at_spaces)

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        text_of = _text_of(path)
        for ids in encode(batches):
            yield pd.DataFrame({"ids": ids, "text": pd.Series([text_of(b) for b in ids], dtype=object)})

    return both


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids", cut_at_spaces: bool = False) -> DataFrame:
    """Add ``out``: the ids of the whole text as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded by itself, without special tokens.  A null or empty text
    has no ids (an empty buffer); all other columns and repeated rows stay as they are; an empty
    table gives an empty table.  A column that is already called ``out`` is replaced.

    With ``cut_at_spaces`` texts are first cut before each space that follows a non-space, and equal
    cuts are matched once, which is faster.  It is right only for patterns whose matches have white
    space in front or throughout and that look at nothing before a match, as the published ones do.
    """
    return small_batches(docs).withColumn(out, F.pandas_udf(_encoder(path, pattern, cut_at_spaces), T.BinaryType())(F.col(f"`{text}`")))


def decode(encoded: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes that the ids of :func:`encode` stand for; null ids give none.

    Repeated rows are alike, an empty table gives an empty one; a column called ``out`` is replaced, others stay.
    """
    return small_batches(encoded).withColumn(out, F.pandas_udf(_decoder(path), T.BinaryType())(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids", back: str = "decoded", cut_at_spaces: bool = False) -> DataFrame:
    """:func:`encode` and :func:`decode` of what it gives, in one pass and one Python worker a task: adds ``out``
    and ``back``, with the same rules for nulls, repeats, clashing names and empty tables."""
    udf = F.pandas_udf(_round_tripper(path, pattern, cut_at_spaces), "ids binary, text binary")
    coded = small_batches(docs).withColumn("_both", udf(F.col(f"`{text}`")))
    return coded.withColumns({out: F.col("_both.ids"), back: F.col("_both.text")}).drop("_both")
