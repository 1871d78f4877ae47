"""Each operator against a brute-force version, a library or a round trip, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import textwrap
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
from gridloom.llm import bpe_replay, components, cube_mixing, cws, license_rules, lsh_forest, pu_quality, storage, threshold_topk, url_templates, warc, words, zstd_toxicity
from gridloom.llm import queries as q
from pyspark.sql import functions as F
from tests.oracle import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, node long"
AWKWARD = [None, "", " \n\t ", "a", "The the THE", "x " * 3000, "é　ü  z", "one two three four five six"]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "clash", 1) for i, t in enumerate(AWKWARD)]
    rows += [rows[-1], (None, "one two three four five six", None, None, None, None, None), (90, None, None, None, None, None, None), (91, "w" * 200_000 + " end", "en", None, 1, "", 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    compare(spark, sf, q.queries()[name], q.oracle_sql()[name])


# ---------------------------------------------------------------- words


@pytest.mark.parametrize("text", [t for t in AWKWARD if t] + ["a\x0bb\x0cc\x1cd e", "Zz ÀÀ àà"])
def test_word_hashes_tell_words_apart(text):
    expected = text.encode().lower().split()
    got = words.word_hashes(text)
    assert len(got) == len(expected)
    assert [i == j for i in got for j in got] == [i == j for i in expected for j in expected] if len(got) < 50 else len(set(got.tolist())) == len(set(expected))


def test_word_hashes_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(str(i * 7919) for i in range(4000))
    whole = words.word_hashes(text)
    monkeypatch.setattr(words, "_BLOCK", 100)
    assert (words.word_hashes(text) == whole).all()
    assert len(words.word_hashes("x" * 1000)) == 1


# ---------------------------------------------------------------- 1 near duplicates


def exact_components(rows: list[tuple[int, str | None]], width: int) -> dict[int, int]:
    sets: dict[int, set] = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_are_those_of_all_pairs(spark, docs, width):
    made = random.Random(4)
    base = [str(made.random()) for _ in range(120)]
    copies = []
    for i in range(60):
        w = list(base)
        for _ in range(made.randrange(7)):
            w[made.randrange(len(w))] = str(made.random())
        copies.append((10_000 + i, " ".join(w)))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + copies
    out = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == exact_components(rows, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_of_awkward_rows(awkward):
    out = lsh_forest.near_duplicates(awkward, 2).collect()
    assert len(out) == awkward.count()
    got = {r["doc_id"]: r for r in out}
    assert got[0]["n_shingles"] == 0 and got[0]["component_id"] == 0 and got[0]["kept"]
    assert got[2]["n_shingles"] == 0 and got[3]["n_shingles"] == 1
    assert got[7]["component_id"] == 7 and got[None]["component_id"] is None and got[None]["kept"]
    assert lsh_forest.near_duplicates(awkward.limit(0), 2).count() == 0


def test_links_inside_crowded_regions_are_all_found(spark):
    made = random.Random(9)
    fresh = lambda n: [str(made.random()) for _ in range(n)]
    template, rows, wanted = fresh(150), [], {}
    for i in range(0, 1600, 2):  # pairs at 156 / 188, 0.83; all others at 150 / 194, 0.77
        shared = fresh(6)
        for d in (i, i + 1):
            own = shared + fresh(16) if i < 600 else fresh(22)
            rows.append((d, " ".join(template + own)))
            wanted[d] = i if i < 600 else d
    out = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == wanted


def test_connected_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9), (7, 7), (None, 1), (3, 1), (20, 30), (30, 40), (40, 50), (50, 60)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 20: 20, 30: 20, 40: 20, 50: 20, 60: 20}
    assert components.connected_components(edges.limit(0)).count() == 0


# ---------------------------------------------------------------- 2 and 7 classifiers


def accuracy(scored, labels, column, label, fold, threshold):
    labels = labels.select("doc_id", F.col(label).alias("_label"))
    rows = scored.join(labels, "doc_id").where(fold).select(column, "_label").collect()
    return sum((r[column] >= threshold) == (r["_label"] == 1) for r in rows) / max(1, len(rows))


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = pu_quality.classify(docs, labels, q._fold(4, 2))
    assert accuracy(scored, labels, "quality_score", "quality", q._fold(4, 2), 0.7) > 0.88


def test_quality_looks_at_no_negative_label(docs, labels):
    flipped = labels.withColumn("quality", F.when(F.col("quality") == 0, None).otherwise(F.col("quality")))
    a = {tuple(r) for r in pu_quality.classify(docs, labels).collect()}
    assert a == {tuple(r) for r in pu_quality.classify(docs, flipped).collect()}


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = zstd_toxicity.classify(docs, labels, q._fold(5, 0)).join(labels.select("doc_id", F.col("toxic").alias("label")), "doc_id").where(q._fold(5, 0)).collect()
    caught = sum(r["toxic"] for r in scored if r["label"] == 1)
    alarms = sum(r["toxic"] for r in scored if r["label"] == 0)
    assert caught > 0.75 * sum(r["label"] for r in scored) and caught > 0.9 * (caught + alarms)


def test_toxicity_dictionaries_are_trained_ones(spark):
    made = random.Random(2)
    ordinary = lambda: " ".join("".join(made.choice("aeilnorst") for _ in range(made.randrange(3, 9))) for _ in range(80))
    toxic = lambda: ordinary() + " " + " ".join(made.choice(["wretched", "vilify", "despicable"]) for _ in range(6))
    lists = [toxic() for _ in range(300)], [ordinary() for _ in range(300)]
    model = zstd_toxicity.fit(*lists)
    magic = (0xEC30A437).to_bytes(4, "little")
    assert model.ordinary[:4] == magic and model.toxic[:4] == magic and model.toxic == zstd_toxicity.fit(*lists).toxic


@pytest.mark.parametrize("late", ["\u6bd2\u5bb3\u8a00\u8bed", "/mischief", "_mischief"])
def test_toxicity_late_in_a_text_without_spaces(late):
    made = random.Random(3)
    ordinary = lambda: "".join(chr(0x4E00 + made.randrange(60)) for _ in range(120))
    toxic = lambda: (t := ordinary())[:100] + late + t[100:]
    model = zstd_toxicity.fit([toxic() for _ in range(150)], [ordinary() for _ in range(150)])
    distance = zstd_toxicity.Distance(model.toxic, model.ordinary)
    scores = []
    for text in [*(toxic() for _ in range(40)), *(ordinary() for _ in range(40))]:
        counts = zstd_toxicity._beyond(distance(zstd_toxicity.words_of(text)))[None]
        x = (zstd_toxicity._features(counts, model.rates) - model.means) / model.spreads
        scores.append(float(np.r_[x[0], 1] @ model.weights))
    assert np.mean([s > 0 for s in scores[:40]]) > 0.9 and np.mean([s > 0 for s in scores[40:]]) < 0.1


@pytest.mark.parametrize("classify,score", [(pu_quality.classify, "quality_score"), (zstd_toxicity.classify, "toxicity")])
def test_classifiers_on_awkward_rows(spark, awkward, docs, labels, classify, score):
    both = docs.unionByName(awkward, allowMissingColumns=True)
    some = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int"))
    rows = classify(both, some).collect()
    assert len(rows) == both.count() and all(0 <= r[score] <= 1 for r in rows)
    assert classify(awkward, labels.limit(0)).count() == awkward.count()
    assert classify(awkward.limit(0), labels).count() == 0


# ---------------------------------------------------------------- 3 fingerprints


def test_collision_rate_is_the_generalised_jaccard_similarity():
    made = random.Random(1)
    a = " ".join(made.choice("abcdefgh") for _ in range(400))
    b = " ".join(made.choice("abcdefxy") for _ in range(300))
    s = cws.Sampler(samples=4000)
    x, y = (dict(zip(*map(np.ndarray.tolist, s.terms(t)))) for t in (a, b))
    true = sum(min(x.get(k, 0), y.get(k, 0)) for k in x | y) / sum(max(x.get(k, 0), y.get(k, 0)) for k in x | y)
    assert abs(cws.likeness(s(a), s(b)) - true) < 0.04


def test_successor_fingerprints(docs, awkward):
    out = sorted(cws.successor_fingerprints(docs).collect(), key=lambda r: r["doc_id"])
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").collect()]
    assert len(out) == len(texts)
    s = cws.Sampler()
    for i, r in enumerate(out):
        following = texts[(i + 1) % len(texts)]
        changed = cws.edited(texts[i], following)
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == s(texts[i]).astype(">u2").tobytes().hex()
        assert r["near_edited"] == cws.likeness(s(texts[i]), s(changed)) and r["near_next"] == cws.likeness(s(texts[i]), s(following))
    rows = cws.successor_fingerprints(awkward).collect()
    assert len(rows) == awkward.count()
    assert cws.successor_fingerprints(awkward.limit(0)).count() == 0
    one = cws.successor_fingerprints(awkward.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


# ---------------------------------------------------------------- 4 top-k


def test_top_k_with_ties_and_broken_vectors(spark):
    made = random.Random(2)
    rows = [(i, [made.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (None, [1.0] * 6), (350, [0.0] * 6), (7, rows[7][1])]
    vectors = threshold_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = threshold_topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, 5, shard_rows=64, query_rows=2).collect()
    kept = [(i, np.floor(256 * np.array(v or [0.0] * 6, float)).astype(int)) for i, v in rows if i is not None and i not in (300, 301, 302, 303)]
    for own, v in kept:
        if own % 50 == 0:
            best = sorted(((-int(v @ w), i) for i, w in kept if i != own))[:5]
            assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == own] == best
    assert len(got) == 5 * len({i for i, _ in kept if i % 50 == 0})
    assert threshold_topk.top_k(vectors.limit(0), vectors).count() == 0
    assert threshold_topk.top_k(vectors, vectors.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e4, 1e7, 1e9])
def test_top_k_is_exact_for_large_components(spark, size):
    made = random.Random(8)
    rows = [(i, [made.uniform(-size, size) for _ in range(5)], "clash") for i in range(120)] + [(50, [0.0] * 5, "clash")]
    vectors = threshold_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"))
    got = threshold_topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, 4, shard_rows=30).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows]
    for own in (0, 50, 100):
        scores = {(sum(a * b for a, b in zip(v, w)), i) for o, v in whole if o == own for i, w in whole if i != own}
        best = [(s, i) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:4]]
        ours = [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == own]
        limit = 2**63 - 1
        assert ours == [(min(s, limit), i) for s, i in best] or own == 50 or best[0][0] > limit


# ---------------------------------------------------------------- 5 licences


def plain_scan(text, sentences, rules):
    """Sentence by sentence over the words of a text, without regular expressions over the whole."""
    flat = lambda t: regex.sub(r"[^\p{L}\p{N}.]+", " ", regex.sub(r"(?<![0-9])\.|\.(?![0-9])", " ", t.lower().replace("licenc", "licens"))).split()
    known = sorted(((flat(s), i) for s, i in sentences.items()), key=lambda x: -len(" ".join(x[0])))
    ends, words_ = {0}, []
    for part in regex.split(r"(?<=[.!?;:])\s+|\n\s*\n|\n(?=\s*[\p{Lu}0-9*-])", text or ""):
        words_ += flat(part)
        ends.add(len(words_))
    ids, at = [], 0
    while at < len(words_):
        hit = next(((s, i) for s, i in known if at in ends and words_[at : at + len(s)] == s and at + len(s) in ends), None)
        ids += [hit[1]] if hit else []
        at += len(hit[0]) if hit else 1
    names, at = set(), 0
    while at < len(ids):
        hit = next(((n, q) for n, q in sorted(rules, key=lambda r: -len(r[1])) if tuple(ids[at : at + len(q)]) == q), None)
        if hit:
            names |= {n for n, q in rules if q == hit[1]}
        at += len(hit[1]) if hit else 1
    return ids, sorted(names)


def test_licences_are_those_of_a_plain_scan(spark, docs):
    made = random.Random(12)
    said = list(license_rules.SENTENCES)
    rows = [(i, " ".join(made.choice([". ".join(made.sample(said, 2)), made.choice(said) + ".", "and", "Some words.", "\n\n"]) for _ in range(made.randrange(12)))) for i in range(300)]
    rows += [(1000 + r["doc_id"], r["text"]) for r in docs.collect()]
    out = license_rules.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in out.collect():
        assert (r["sentence_ids"], r["licenses"]) == plain_scan(r["text"], license_rules.SENTENCES, license_rules.RULES), r["text"]


def test_two_forms_in_one_text_and_a_callers_own_sentences(spark):
    bsd = [next(s for s, i in license_rules.SENTENCES.items() if i == name) + ".\n\n" for name in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    rows = [("".join(bsd) + "Words.\n\n" + "".join(bsd[:3]), "clash", ["x"]), ("Mach, was du möchtest!", None, None), ("Do what you want.", None, None)]
    table = spark.createDataFrame(rows, "text string, licenses string, sentence_ids array<string>")
    assert license_rules.scan(table).collect()[0]["licenses"] == ["BSD-2-Clause", "BSD-3-Clause"]
    own = license_rules.scan(table, sentences={"Mach was Du möchtest": "free", "Do what you want": "free"}, rules=(("Free", ("free",)), ("Also", ("free",))))
    assert [r["licenses"] for r in own.collect()] == [[], ["Also", "Free"], ["Also", "Free"]]



def test_licence_rules(spark, awkward):
    mit = [s for s, i in license_rules.SENTENCES.items() if i in ("mit-grant", "mit-notice", "mit-warranty")]
    rows = [
        (1, "Words here.\nReleased under the MIT License.\nMore words.", ["MIT"]),
        (2, "\n\n".join(mit) + ".", ["MIT"]),
        (3, "\n\n".join(reversed(mit)), []),
        (4, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
        (5, "Licenced under the  APACHE licence version 2.0", ["Apache-2.0"]),
        (6, "We like the MIT License very much.", []),
        (7, "/* SPDX-License-Identifier: GPL-2.0-or-later */\n", ["GPL-2.0-or-later"]),
        (8, "// SPDX-License-Identifier: MPL-2.0\nfn main() {}\n", []),
        (9, "# SPDX-License-Identifier: MPL-2.0\n\nimport os\n", ["MPL-2.0"]),
        (10, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", ["0BSD"]),
    ]
    out = license_rules.scan(spark.createDataFrame(rows, "doc_id long, text string, wanted array<string>")).collect()
    assert [(r["doc_id"], r["licenses"]) for r in out] == [(r[0], r[2]) for r in rows]
    assert all(r["licenses"] == [] for r in license_rules.scan(awkward).collect())


@pytest.mark.parametrize("leader", ["", " * ", "-- ", "# ", "// "])
def test_every_licence_rule_fires_on_wrapped_and_commented_text(spark, leader):
    rows = []
    for name, sequence in license_rules.RULES:
        said = [next(s for s, i in license_rules.SENTENCES.items() if i == wanted) + "." for wanted in sequence]
        for width in (30, 72, 10_000):
            lines = [line for s in said for line in [*textwrap.wrap(s, width, break_on_hyphens=False), ""]]
            rows.append((name, "\n".join(leader + line for line in ["Some words.", "", *lines, "More words."])))
    out = license_rules.scan(spark.createDataFrame(rows, "name string, text string")).collect()
    assert [r["licenses"] for r in out] == [[r["name"]] for r in out]


def test_licence_query_finds_every_planted_line(spark, sf):
    found = {r["doc_id"]: r["licenses"] for r in q.op5_license_rules(spark, sf).collect()}
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert found[r["doc_id"]] == ",".join(sorted(k for k, line in lines.items() if line in (r["text"] or "")))


# ---------------------------------------------------------------- 6 tokens


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_replay.load_ranks(path), special_tokens={})


def test_tokens_are_those_of_the_library(spark, docs, awkward, tiktoken_encoding):
    path, pattern = q.byte_bpe()
    odd = ["  two  spaces ", "a \n b", "tab\t x", "don't I'll", "aaaaaaaaaaaaaaaaaaaaaa", "日本語 テスト 🎉🎉", "x  y", "<|endoftext|>", "\x1c \x1d", " " * 50, "né́e", "123 4567.89"]
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd).unionByName(awkward.select("doc_id", "text"))
    rows = bpe_replay.decode(bpe_replay.encode(both, path, pattern), path).collect()
    assert len(rows) == both.count()
    for r in rows:
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == tiktoken_encoding.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe_replay.encode(both.limit(0), path, pattern).count() == 0


@pytest.mark.parametrize("cut", [True, False])
def test_made_up_texts_have_the_ids_of_the_library(tiktoken_encoding, cut):
    made = random.Random(1)
    texts = ["".join(made.choice("aeinorst   \n.'d,0123é") for _ in range(made.randrange(400))) for _ in range(1500)]
    texts += ["".join(made.choice("ab") for _ in range(made.randrange(60))) for _ in range(1500)] + ["=" * 20_000, "ab" * 9_999, None, " "]
    path, pattern = q.byte_bpe()
    (got,) = bpe_replay._encoder(path, pattern, cut)(iter([pd.Series(texts, dtype=object)]))
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [tiktoken_encoding.encode_ordinary(t or "") for t in texts]


def test_replay_of_ranks_that_come_up_late():
    # "abc" ranks below "ab", so merging a and b can bring up a lower rank
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"cc", b"ab", b"ca", b"abab", b"bb"]
    replay = bpe_replay.MergeReplay({t: i for i, t in enumerate(tokens)})
    made = random.Random(6)
    words_ = [bytes(made.choice(b"abc") for _ in range(made.randrange(1, 40))) for _ in range(2000)]

    def plain(word: bytes) -> list[int]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((tokens.index(a + b) if a + b in tokens else 1 << 30, i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [tokens.index(p) for p in parts]

    assert replay(words_) == [plain(w) for w in words_]
    assert replay([]) == []


def test_patterns_that_leave_characters_out_or_hold_spaces(docs):
    path, _ = q.byte_bpe()
    ranks = bpe_replay.load_ranks(path)
    replay = bpe_replay.MergeReplay(ranks)
    texts = [r["text"] for r in docs.limit(5).collect()]
    for pattern in (r"[a-z]+ [a-z]+|[a-z]+", r"\p{L}+"):
        (got,) = bpe_replay._encoder(path, pattern, False)(iter([pd.Series(texts, dtype=object)]))
        for text, ids in zip(texts, got):
            wanted = [i for w in replay([m.encode() for m in regex.findall(pattern, text)]) for i in w]
            assert np.frombuffer(ids, "<u4").tolist() == wanted


def test_cuts_at_spaces_change_nothing(spark, docs):
    path, pattern = q.byte_bpe()
    a, b = (bpe_replay.encode(docs.limit(40), path, pattern, cut_at_spaces=c).select("doc_id", F.sha2("token_ids", 256)).collect() for c in (True, False))
    assert sorted(a) == sorted(b)


# ---------------------------------------------------------------- 8 archives


def test_archives_give_every_page_back(spark, tmp_path):
    made = random.Random(3)
    long = "".join(made.choice("abcé<\r\n>") for _ in range(30_000))
    rows = [(1, "http://a/x", "same " * 300), (2, "http://b/\r\ny", "same " * 300), (3, None, long), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "WARC/1.1\r\n\r\n" * 200), (None, "n", "same " * 300), (8, "u", "WARC/1.1\r\n\r\n" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.write_archives(warc.plan_records(pages), path, segment_bytes=1000, records_per_file=3)
    assert warc.read_records(spark, path).where("number > 1").count() > 30
    got = sorted(warc.read_archives(spark, path).collect(), key=lambda r: (r["page_id"] or 0))
    assert [r["page_id"] for r in got] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 8] and all(r["complete"] for r in got)
    by = {r["page_id"]: r for r in got}
    assert by[1]["kind"] == "revisit" and by[1]["refers_to"] == 2 and by[None]["refers_to"] == 2 and by[2]["kind"] == "response"
    assert by[1]["stated_bytes"] == 1500 and by[1]["digest"] == hashlib.sha1(b"same " * 300).hexdigest()
    for page, _, html in rows:
        if by[page]["kind"] == "response":
            assert bytes(by[page]["payload"]).decode() == (html or "")
    empty = f"file://{tmp_path}/e"
    warc.write_archives(warc.plan_records(pages.limit(0)), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_a_missing_segment_is_noticed(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    warc.write_archives(warc.plan_records(spark.createDataFrame([(1, "u", "x" * 5000)], "page_id long, url string, html string")), path, segment_bytes=1000)
    records = warc.read_records(spark, path).where("number <> 3")
    assert [(r["complete"], r["block"]) for r in warc.reassemble(records).collect()] == [(False, None)]


def test_chunked_framing():
    for body in (b"", b"x", b"y" * 40_000):
        assert warc.unchunked(warc.chunked(body, 777)) == body
    with pytest.raises(ValueError):
        warc.unchunked(warc.chunked(b"z" * 100)[:50])


# ---------------------------------------------------------------- 9 urls


def test_rules_hosts_and_paths(spark):
    rows = [
        (1, "HTTP://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        (3, "https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        (4, "https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        (5, "http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
        (6, "http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
        (7, "http://x.com?de/1", "x.com", "", None, None),
        (8, None, "", "", None, None),
        (9, "no scheme", "", "", None, None),
        (10, "http://x.com/de", "x.com", "/de", None, None),
        (10, "http://x.com/de", "x.com", "/de", None, None),
    ]
    pages = spark.createDataFrame([(r[0], r[1], "clash") for r in rows], "page_id long, url string, verdict string")
    got = sorted(url_templates.judge(pages).collect(), key=lambda r: r["page_id"])
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [r[2:5] for r in rows]
    assert all(g["verdict"] in ("allow", "block") and r[5] in (None, g["verdict"]) for g, r in zip(got, rows))
    assert url_templates.judge(pages.limit(0)).count() == 0


def test_templates_split_by_purity(spark):
    rows = [("h", f"/good/{i}", "allow") for i in range(40)] + [("h", f"/bad/{i}", "block") for i in range(40)] + [("h", f"/bad/{i}", None) for i in range(50, 60)] + [("h", f"/good/{i}", None) for i in range(50, 60)]
    urls = spark.createDataFrame(rows, "host string, path string, verdict string")
    got = {r["path"]: r["template"] for r in url_templates.templates(urls).collect()}
    assert got["/good/55"] == "/good/*" and got["/bad/55"] == "/bad/*" and len(got) == len({(h, p) for h, p, _ in rows})


def plain_templates(urls, siblings=16, rare=4.0, z=2.0):
    """Level by level in dictionaries: {(host, path): template}."""
    counts = {}
    for host, path, verdict in urls:
        c = counts.setdefault((host, path), [0, 0, 0])
        counts[host, path] = [c[0] + 1, c[1] + (verdict == "block"), c[2] + (verdict is not None)]
    cut = {k: [s for s in k[1].split("/") if s] for k in counts}
    out, level = dict.fromkeys(counts, ""), 0
    while going := [k for k in counts if len(cut[k]) > level]:
        child, node = defaultdict(lambda: np.zeros(3)), defaultdict(set)
        for k in going:
            child[k[0], out[k], cut[k][level]] += counts[k]
            node[k[0], out[k]].add(cut[k][level])
        named = {}
        for (host, template), names in node.items():
            n, blocked, labelled = sum(child[host, template, s] for s in names)
            for s in names:
                c = child[host, template, s]
                differs = c[2] > 0 and labelled > 0 and abs(c[1] / c[2] - blocked / labelled) > z * np.sqrt(blocked / labelled * (1 - blocked / labelled) / c[2])
                crowded = len(names) > siblings and c[0] < rare and n < rare * len(names)
                named[host, template, s] = s if differs and not crowded and not regex.search(url_templates._IDENTIFIER, s) else "*"
        for k in going:
            out[k] += "/" + named[k[0], out[k], cut[k][level]]
        level += 1
    return out


def plain_verdicts(rows, templates):
    """block_rate of each (host, path), smoothed towards its host's and the whole table's."""
    seen, hosts, kinds = np.zeros(2), defaultdict(lambda: np.zeros(2)), defaultdict(lambda: np.zeros(2))
    for host, path, verdict in rows:
        c = np.array([verdict == "block", verdict is not None], float)
        seen, hosts[host], kinds[host, templates[host, path]] = seen + c, hosts[host] + c, kinds[host, templates[host, path]] + c
    over = (seen[0] + 0.5) / (seen[1] + 2)
    smooth = lambda c, prior: (c[0] + 4 * prior) / (c[1] + 4)
    return {k: smooth(kinds[k[0], t], smooth(hosts[k[0]], over)) for k, t in templates.items()}


def test_templates_and_verdicts_are_those_of_a_plain_tree(spark, sf):
    made = random.Random(7)
    urls = [r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    urls += [f"http://h{made.randrange(4)}.com/{made.choice(['fr', 'de', 'x'])}/{made.choice('abc')}/{made.randrange(40)}/{made.choice('pq')}" for _ in range(600)]
    urls += ["http://deep.com/de/" + "/".join(str(i) + "z" for i in range(30)), "http://deep.com/de/" + "/".join(str(i) + "z" for i in range(11)) + "/other", None, "http://a.org", "http://a.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_templates.judge(pages).collect()
    rule = {"block": "block", "allow": "allow"}
    rows = [(r["host"], r["path"], rule.get(r["verdict"]) if r["rule"] else None) for r in got]
    templates = plain_templates(rows)
    rates = plain_verdicts(rows, templates)
    assert len(got) == len(urls)
    for r in got:
        assert r["template"] == templates[r["host"], r["path"]]
        assert r["block_rate"] == pytest.approx(rates[r["host"], r["path"]], abs=1e-12)
        assert r["rule"] or r["verdict"] == ("block" if r["block_rate"] >= 0.5 else "allow")


# ---------------------------------------------------------------- 10 mixing


def test_targets_by_hand(spark):
    sized = spark.createDataFrame([(1, "a", 100), (2, "b", 10), (3, None, 50), (4, "c", 1000)], "doc_id long, source string, size long")
    got = {r["source"]: r["target"] for r in cube_mixing.source_targets(sized).collect()}
    # weights a 5, b 2, c 1, null 5; 1740 words; a, b and null stop at twice their size
    assert got == {"a": 200.0, "b": 20.0, None: 100.0, "c": pytest.approx(1740 - 320)}


def test_flight_keeps_both_totals():
    made = np.random.default_rng(5)
    p, x = made.random(500), made.integers(1, 2000, 500)
    out = cube_mixing.fly(p, x, made.random(500))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * x).sum() == pytest.approx((p * x).sum(), rel=1e-9)


def test_mix_meets_its_targets(docs, awkward):
    a = cube_mixing.mix(docs, chunk=16).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, cube_mixing.mix(docs.repartition(7), chunk=16).collect()))
    taken, target = defaultdict(int), {}
    for r in a:
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.05 * t + 20
    rows = cube_mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert cube_mixing.mix(awkward.limit(0)).count() == 0
    marked = awkward.coalesce(1).withColumn("at", F.monotonically_increasing_id())
    assert cube_mixing.repeat(marked, cube_mixing.mix(marked, row="at"), "at").count() == sum(r["copies"] for r in rows)


def test_copies_of_one_row_fly_in_chunks_of_bounded_size(spark):
    rows = spark.range(600).select(F.lit(7).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    other = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c d").alias("text"), F.lit("t").alias("source"))
    out = cube_mixing.mix(rows.unionByName(other), chunk=32)
    taken = {r["source"]: (r["t"], r["w"]) for r in out.groupBy("source", "target").agg(F.sum("taken").alias("t"), F.first("target").alias("w")).collect()}
    assert out.count() == 900 and all(abs(t - w) <= 4 for t, w in taken.values())
    numbers = cube_mixing.numbered(cube_mixing.sizes(rows), "source", "doc_id", "size", "row").select(F.pmod(F.xxhash64("number", F.lit(0)), F.lit(19)).alias("chunk")).groupBy("chunk").count().collect()
    assert max(r["count"] for r in numbers) < 70


def test_tables_are_dropped_and_a_cluster_needs_a_shared_folder(spark, docs):
    class Cluster:
        """A session on another machine's cluster without a shared folder."""

        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://elsewhere:7077"

            class _jsc:
                sc = staticmethod(lambda: type("", (), {"getCheckpointDir": lambda self: type("", (), {"isDefined": lambda self: False})()})())

    with pytest.raises(RuntimeError):
        storage.shared_dir(Cluster())
    began = storage.mark()
    out = lsh_forest.near_duplicates(docs.select("doc_id", "text"), 5)
    assert 0 < len(storage._written()[began:]) <= 3 and out.count() == docs.count()


def test_folds_are_those_of_zlib(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", q._fold(4, 2).alias("f")).collect()
    assert all(r["f"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_round_trip_equals_encoding_and_decoding(spark, awkward):
    path, pattern = q.byte_bpe()
    plain = bpe_replay.decode(bpe_replay.encode(awkward, path, pattern), path)
    both = bpe_replay.round_trip(awkward.withColumn("decoded", F.lit(1)), path, pattern)
    assert sorted(map(str, plain.collect())) == sorted(map(str, both.select(plain.columns).collect()))
    assert bpe_replay.round_trip(awkward.limit(0), path, pattern).count() == 0


def linked_components(rows: list[tuple[int, str | None]], width: int) -> dict[int, int]:
    """As :func:`exact_components`, by an index of the rarest shingles that two linked sets must share."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    count = defaultdict(int)
    for s in sets.values():
        for x in s:
            count[x] += 1
    index, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in sets.items():
        rare = sorted(s, key=lambda x: (count[x], x))[: len(s) - -(-4 * len(s) // 5) + 1]
        for j in {j for x in rare for j in index[x]}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for x in rare:
            index[x].append(i)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("size, slack", [("sf0.01", 1.0), ("sf0.1", lsh_forest.SLACK)])
def test_no_link_is_lost_in_the_given_documents(spark, size, slack):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    want = linked_components([tuple(r) for r in docs.collect()], 2)
    got = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(docs, 2, slack=slack).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_tiles_give_one_link_for_two_components():
    rng = np.random.default_rng(1)
    base = np.sort(rng.integers(0, 2**63, 200).astype(np.uint64))
    near = lambda i: np.sort(np.concatenate([base[i % 5 :], rng.integers(0, 2**63, 2).astype(np.uint64)]))
    table = lambda nodes, component: pd.DataFrame({"node": nodes, "component": component, "set": [near(i).tobytes() for i in nodes]})
    asked = pd.concat([table(range(100, 110), 100), table([200], 200)])
    held = pd.concat([table(range(50), 0), asked])
    out = lsh_forest._tile(80, 100)(asked, held)
    assert sorted(map(tuple, out.to_numpy().tolist())) == [(0, 100), (0, 200), (100, 200)]
    assert len(lsh_forest._tile(80, 100)(asked[:0], held)) == 0
