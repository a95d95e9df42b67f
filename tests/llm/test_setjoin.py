"""The n-gram join against all pairs."""

import random

import numpy as np
import pytest

from logloom.llm import setjoin

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def grams(text, width=4):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else (
        {tuple(words)} if words else set())


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id) per row; rows of one id are one node."""
    sets = [grams(t) for _, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    live = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for n, i in enumerate(live):
        for j in live[:n]:
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(rows[i][0]), find(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), find(d) if d is not None and s else d) for (d, _), s in zip(rows, sets)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_awkward_rows(spark, docs, no_docs):
    assert found(setjoin.linked_sets(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert setjoin.linked_sets(no_docs).count() == 0


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + 1] = rng.choice(([], [f"n{rng.randrange(10 ** 9)}"], [words[at], f"m{rng.randrange(99)}"]))
    return " ".join(words)


def corpus(seed):
    """Families of sets of all sizes around the boundary and far above it, a passage that many share, equal texts."""
    rng = random.Random(seed)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for size in (3, 4, 5, 8, 9, 10, 11, 13, 16, 18, 20, 24, 30, 60, 200):
        for _ in range(3):
            base = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
            rows += [edited(rng, base, rng.choice((0, 0, 1, 1, 2, size // 20))) for _ in range(6)]
            # Whole ends cut off: one gram less for each word.
            rows += [" ".join(base[:size - cut]) for cut in (1, 2, 3) if cut < size]
    rows += [" ".join(passage + [f"q{i}_{j}" for j in range(rng.choice((6, 9, 12, 40)))]) for i in range(40)]
    rng.shuffle(rows)
    return [(i + 5, t) for i, t in enumerate(rows)] + [(7, "a text of its own for an id that is there"), (8, rows[0])]


@pytest.mark.parametrize("limit", [None, 0, 14, 21])
def test_any_boundary(spark, limit):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(setjoin.linked_sets(df, limit=limit)) == brute(rows)


def test_dense_group_in_blocks(spark, monkeypatch):
    """Near copies of one text that are mostly too far from each other, in blocks and chunks of a few rows."""
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    monkeypatch.setattr(setjoin, "CHUNK", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i + 1, edited(rng, base, 3)) for i in range(120)] + [(1000, " ".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(setjoin.linked_sets(df)) == brute(rows)


def test_repeated_id_with_many_rows(spark):
    rows = [(1, "one text with some more words in it than the width asks for")] * 50 + [
        (1, "a second text under the same id"), (2, "a second text under the same id"), (0, rows_text := "x " * 30), (3, rows_text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(setjoin.linked_sets(df)) == brute(rows)


def test_bounds():
    for s in range(1, 80):
        for t in range(1, 80):
            need = setjoin.least_common(s, t)
            assert all((100 * c >= 85 * (s + t - c)) == (c >= need) for c in range(min(s, t) + 1))
            if need <= min(s, t):
                assert s - need < setjoin.first_grams(np.array([s]))[0]
    values = setjoin.gram_values(np.arange(6, dtype=np.uint64))
    keys = setjoin.subset_keys(values, 6, 4)
    assert keys.shape == (2, 15) and len(set(keys[0].tolist())) == 15


def test_texts_that_meet_nobody_are_not_shuffled(spark):
    docs = spark.range(-10_000, 10_000).selectExpr("id", "'t' || id AS text").union(
        spark.createDataFrame([(None, "no id")], "id long, text string"))
    asked = [*range(-10_000, 10_000, 50), 2 ** 62, None]
    near = setjoin.marked(docs, spark.createDataFrame([(i,) for i in asked * 2], "id long"))
    found = [r.id for r in near.collect()]
    assert len(found) == len(set(found)) < 450 and set(found) >= {*asked} - {2 ** 62}
    assert "hashpartitioning(id" not in near._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("marks", [8, 1 << 16])
def test_marks_go_before_the_shuffle_of_texts(spark, monkeypatch, marks):
    """With tables too large to broadcast; ids that share a bit change nothing."""
    plans, staged = [], setjoin.staged

    def recorded(df, purpose):
        if purpose == "setjoin-texts":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, purpose)

    monkeypatch.setattr(setjoin, "staged", recorded)
    monkeypatch.setattr(setjoin, "MARKS", marks)
    rows = corpus(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert found(setjoin.linked_sets(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans and all("bitmap_construct_agg" in p for p in plans)
