"""Phrase collocations against plain counting."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logloom.llm import phrases

UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, longest=3, least=10, top=2000, cover=50):
    """rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    kept = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    made = {}
    for (lang, w), a in kept.items():
        if any(lang == other and len(v) > len(w) and 100 * b >= cover * a
               and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)) for (other, v), b in kept.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        made.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in made.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_awkward_rows(spark, docs, no_docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found(phrases.collocations(docs, least=2)) == brute(rows, least=2)
    assert phrases.collocations(no_docs).count() == 0


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r.lang, r.text) for r in docs.collect()])
    assert want and found(phrases.collocations(docs)) == want


@pytest.mark.parametrize("shards,cells,longest", [(1, 1 << 10, 3), (3, 1 << 16, 4), (4, 4, 3)])
def test_shards_and_shared_cells(spark, sf_dir, shards, cells, longest):
    """Whatever the shards, and however many parts share a cell, counts are whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = phrases.collocations(docs, longest=longest, least=4, top=50, cover_percent=80, shards=shards, n_cells=cells,
                               block=1 << 14)
    assert found(got) == brute(rows, longest=longest, least=4, top=50, cover=80)


def test_pieces_and_blanks(spark):
    text = "A b,a  b\ta b. a b\na\u000bb a-b !a b"
    df = spark.createDataFrame([(1, "en", text)] * 3 + [(None, None, "A B")] * 4 + [(2, "und", "a b")],
                               "doc_id long, lang string, text string")
    rows = [(r.lang, r.text) for r in df.collect()]
    assert found(phrases.collocations(df, least=3)) == brute(rows, least=3)


def test_wide_products(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10 ** 13, 10 ** 13 + 1, 10 ** 13 + 7)], "a long, l long, r long")
    got = df.select(phrases.wide_product(F.col("a"), F.col("a"), 1_000_000).alias("big"),
                    phrases.wide_product(F.col("l"), F.col("r")).alias("small")).select(F.expr("big div small")).first()[0]
    assert got == 1000000 * 10 ** 26 // ((10 ** 13 + 1) * (10 ** 13 + 7))


def test_phrases_travel_as_arrays(spark, sf_dir, monkeypatch):
    """A step leaves a row for each length, start and range of keys, however many phrases it counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made, staged = [], phrases.staged

    def kept(df, purpose):
        made.append((purpose, staged(df, purpose)))
        if purpose == "phrase-step":
            sizes.append(made[-1][1].groupBy("k", "start").count().collect())
        return made[-1][1]

    sizes = []
    monkeypatch.setattr(phrases, "staged", kept)
    frequent, _ = phrases.counts(docs, least=2)
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert frequent.count() > 100 * most and sizes and all(r["count"] <= most for step in sizes for r in step)


@pytest.mark.parametrize("cells", [1, 1 << 10])
def test_tables_grow_with_frequent_parts(spark, sf_dir, cells, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    asked, real = [], phrases.frequent_cells
    monkeypatch.setattr(phrases, "CELLS", cells)
    monkeypatch.setattr(phrases, "frequent_cells", lambda total, least, n: asked.append(n) or real(total, least, n))
    want = brute([(r.lang, r.text) for r in docs.collect()], least=3)
    assert found(phrases.collocations(docs, least=3)) == want and max(asked) > 1 << 10


def test_words_that_share_a_hash(spark, monkeypatch):
    """Seen where they meet, and all is counted anew with other hashes."""
    def tally(word, n=1):
        return phrases.Tally(np.array([[7, 9]], np.uint64), np.array([n, 1]), pa.table({"lang": ["en", "en"], "word": [word, "b"]}))

    one, two = phrases.Tally.summed([tally("a"), tally("a", 4)]), phrases.Tally.summed([tally("a"), tally("c")])
    assert not one.clash and two.clash and one.n.tolist() == [5, 2] and one.texts["word"].to_pylist() == ["a", "b"]

    calls, real = [], phrases.joining

    def joining(least):
        calls.append(least)
        join = real(least)
        if len(calls) > 1:
            return join

        def marked(batches):
            for b in join(batches):
                yield b.set_column(5, "clash", pa.array([True] * b.num_rows))

        return marked

    monkeypatch.setattr(phrases, "joining", joining)
    rows = [("en", "a b c a b")] * 4 + [(None, "A B")] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert found(phrases.collocations(df, least=3)) == brute(rows, least=3)


def test_phrases_that_share_a_key(monkeypatch):
    monkeypatch.setattr(phrases, "longer", lambda keys, words: (keys ^ words) & np.uint64(1))
    words = np.random.default_rng(0).integers(0, 3, (2, 500)).astype(np.uint64)
    total = phrases.Tally.summed([phrases.Tally(words[:, at:at + 100], np.ones(100, np.int64)) for at in range(0, 500, 100)])
    assert dict(zip(map(tuple, total.words.T.tolist()), total.n.tolist())) == Counter(map(tuple, words.T.tolist()))
