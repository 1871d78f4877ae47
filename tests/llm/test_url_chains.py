"""Chains of only children in the tree of path templates."""

import random

import pytest

from gridloom.llm import url_templates

from .test_operators import plain_templates

TRAP = [("h", "/next" * depth, "allow" if depth % 2 else None) for depth in range(1, 120)]


def rounds_of(spark, urls, monkeypatch):
    written = []
    keep = url_templates.materialise
    monkeypatch.setattr(url_templates, "materialise", lambda df, name: (written.append(name), keep(df, name))[1])
    table = spark.createDataFrame(urls, "host string, path string, verdict string")
    got = {(r["host"], r["path"]): r["template"] for r in url_templates.templates(table).collect()}
    return got, written.count("nodes")


@pytest.mark.parametrize(
    "urls,most",
    [
        ([("h", "/a" * 40 + "/b", "allow"), ("h", "/a" * 40 + "/c/d", "block"), ("h", "/x/y", None)], 5),
        (TRAP, 2),
        ([*TRAP, ("h", "/next" * 60 + "/other/1", "block"), ("h", "/next" * 60 + "/other/2", "block"), ("g", "", None), ("g", "/", None), ("g", "/a//b/", None)], 6),
    ],
)
def test_chains_take_one_round(spark, monkeypatch, urls, most):
    got, rounds = rounds_of(spark, urls, monkeypatch)
    assert got == plain_templates(urls) and rounds <= most


def test_random_trees_are_those_of_a_plain_one(spark, monkeypatch):
    made = random.Random(9)
    urls = []
    for _ in range(500):
        path = "".join("/" + made.choice(["a", "a", "a", "b", "7"]) for _ in range(made.randrange(9)))
        urls.append((made.choice("xyz"), path, made.choice(["allow", "block", "block", None]) if "/b" in path else made.choice(["allow", "allow", None])))
    got, _ = rounds_of(spark, urls, monkeypatch)
    assert got == plain_templates(urls)
