import random

import numpy as np
import pytest
from conftest_llm import brute_classes  # noqa: F401

from logloom.llm import minhash
from logloom.llm.components import components


def classes(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_awkward_rows(spark, docs, no_docs):
    got = classes(minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept"))
    table = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == sorted(brute_classes(table), key=repr)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_dense_group_whose_centre_is_not_the_pivot(spark):
    """Near copies of one text that are mostly too far from each other, and strangers that share a passage."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(120)] = f"n{rng.randrange(10 ** 9)}"
        rows.append((i + 1, " ".join(words)))
    rows.append((1000, " ".join(base)))
    rows += [(2000 + i, " ".join(base[:80] + [f"s{i}_{j}" for j in range(40)])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(minhash.near_duplicates(df)) == sorted(brute_classes(rows), key=repr)


def test_rest_links_alone_find_all(spark):
    """Without any link from the pivots, blocks and chunks of small size find every link between bands' members."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(100)] = f"n{rng.randrange(10 ** 9)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = minhash.signatures(df).selectExpr("doc_id as id", "n_shingles", "sketch", "1L as band", "60L as n",
                                               "doc_id as component", "1L as size")
    texts = df.selectExpr("doc_id as id", "text")
    before = minhash.BLOCK, minhash.CHUNK
    minhash.BLOCK, minhash.CHUNK = 16, 8
    try:
        links = minhash.rest_links(signed, texts)
        found = {frozenset((r.a, r.b)) for r in links.collect()}
    finally:
        minhash.BLOCK, minhash.CHUNK = before
    want = brute_classes(rows)
    got = dict(components(links).collect())
    assert {i: got.get(i, i) for i, *_ in want} == {i: c for i, _, c, _ in want}
    assert found


def test_similarity_of_sketches():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 1 << 63, 80, dtype=np.uint64)])
    both = minhash.sketches(np.concatenate([a, b, a[:1]]), np.repeat([0, 1, 3], [400, 400, 1]), 4)
    assert abs((both[0] == both[1]).mean() - 320 / 480) < 0.15
    assert (both[2] == both.max()).all() and not (both[3] == both.max()).any()


@pytest.mark.parametrize("shape", ["chain", "star", "pairs"])
def test_components(spark, shape):
    links = {"chain": [(i, i + 1) for i in range(40)], "star": [(50, i) for i in range(50)],
             "pairs": [(2 * i, 2 * i + 1) for i in range(20)] + [(7, 7), (3, 2)]}[shape]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: find(x) for x in parent}
