import re
from collections import Counter

import numpy as np

from logloom.llm import quality


def counts_of(text):
    """The five counts by plain Python."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_and_base_rules(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = quality.judged(docs, labels)
    assert "lang" in made.columns and made.columns.count("kept") == 1
    for r in made.collect():
        want = counts_of(r.text)
        assert tuple(r[c] for c in quality.COUNTS) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert (r.base_failed, r.kept, r.anomaly) == (failed, not failed, 0.0)
    assert quality.judged(no_docs, labels).count() == 0


def test_held_out_accuracy(spark):
    """Fitted on the labels of even ids, judged on those of odd ids."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    made = quality.judged(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = made.where("not base_failed").select("quality", "kept").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.995 and np.mean(bad) < 0.15


def test_labels_with_nulls_ties_and_one_class(spark, docs):
    rows = [(1, 1, 0), (1, 0, 0), (None, 1, 1), (3, None, None), (4, 1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert quality.judged(docs, labels).count() == docs.count()
    counts, good = quality.labelled_counts(docs, labels)
    assert sorted(good.tolist()) == [False, True] and counts.shape == (2, 8)
    assert quality.fit(counts, np.array([True, True])) is None


def test_rows_that_repeat_a_labelled_id_are_fitted_once(spark):
    texts = [(5, "some words of a text " * (2 + i % 7)) for i in range(300)] + [(6, "bad ### text"), (7, "not labelled")]
    labels = spark.createDataFrame([(5, 1), (6, 0)], "doc_id long, quality int")
    for parts in (1, 5):
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(parts)
        counts, good = quality.labelled_counts(docs, labels)
        assert good.tolist() == [True, False]
        assert [tuple(c[:5]) for c in counts.tolist()] == [counts_of(texts[0][1]), counts_of("bad ### text")]


def test_path_lengths():
    rng = np.random.default_rng(1)
    good = np.zeros((400, 8), np.int64)
    good[:, 0], good[:, 1] = 100, rng.integers(450, 550, 400)
    bad = good[:30].copy()
    bad[:, 2] = rng.integers(20, 90, 30)
    forest = quality.fit(np.concatenate([good, bad]), np.repeat([True, False], [400, 30]))
    assert (forest.score(quality.features(bad)) > forest.threshold).mean() > 0.9
    assert (forest.score(quality.features(good)) > forest.threshold).mean() < 0.01
    one = np.array([[0.0], [0.0], [0.0], [9.0]])
    feature, value, left, length = quality.grow(one, rng, 8)
    leaves = sorted(x for f, x in zip(feature, length) if f < 0)
    assert feature[0] == 0 and leaves == [1.0, 1 + float(quality.average_path(3))]
