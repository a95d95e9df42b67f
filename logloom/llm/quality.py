"""Quality rules: an isolation forest over rule statistics.

Every whole text is measured by counting rules. Each measure becomes an excess
over the range that labelled good rows span, so ordinary texts lie at one point
and odd ones apart. An isolation forest splits random subsamples at random
features (by their span) and values; rows that few splits isolate are anomalous. The threshold
is the score that rejects most labelled bad rows while it loses no more than
``MAX_GOOD_LOSS`` of the labelled good ones.

The forest and the threshold are fitted on the driver from at most
``SAMPLE_ROWS`` labelled rows, those of the smallest hash of their id; all
documents are measured and judged in one pass. Of the rows that repeat a labelled
id, the one with the smallest counts is fitted.

Results: a null text counts as empty and fails the base rules. Without
labelled rows of both classes the base rules alone decide. Labels with null id
or quality are ignored; of repeated labels of an id the lower one counts.
Repeated rows are judged alike, each for itself. Extra columns stay aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import SPACE, Texts, blocks, mix, windows

SAMPLE_ROWS = 20_000
TREES = 128
TREE_ROWS = 256
MAX_GOOD_LOSS = 0.001
WINDOW = 5
#: Least width of a measure's good range, so that ratios that good rows lack stay finite.
MIN_WIDTH = 0.02
#: How many times as often bad rows must leave a good range for it to be used.
TELLING = 5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
SHOUT = np.zeros(256, bool)
SHOUT[list(b"!?")] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_capitals", "n_shouts")


def doubles(keys: np.ndarray) -> np.ndarray:
    """Marks every key that occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    marks = np.zeros(len(keys), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    return marks


def later(keys: np.ndarray) -> np.ndarray:
    """Marks every key that occurred before."""
    order = np.argsort(keys, kind="stable")
    marks = np.zeros(len(keys), bool)
    marks[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return marks


def measure(texts: Texts) -> np.ndarray:
    """Rule counts, one column per name of COUNTS and MORE."""
    starts, ends, docs = texts.spans(SPACE)
    inside, first_byte = ~SPACE[texts.data], (texts.data & 0xC0) != 0x80
    n_words = np.bincount(docs, minlength=texts.n)
    seen, first = windows(texts.hashes(starts, ends), docs, WINDOW)
    again = first[doubles(seen ^ mix(docs[first]))]
    cover = np.zeros(len(docs) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.subtract.at(cover, again + WINDOW, 1)
    repeated = np.bincount(docs[np.cumsum(cover[:-1]) > 0], minlength=texts.n)
    from_, to, of = texts.spans(NEWLINE)
    filled = np.concatenate(([0], np.cumsum(inside)))
    wordy = filled[to] > filled[from_]
    from_, to, of = from_[wordy], to[wordy], of[wordy]
    lines = np.bincount(of, minlength=texts.n)
    dup = np.bincount(of[later(texts.hashes(from_, to) ^ mix(of))], minlength=texts.n)
    per = texts.per_text
    return np.stack([n_words, per(inside & first_byte), per(SYMBOL[texts.data]), dup, repeated,
                     lines, per(CAPITAL[texts.data]), per(SHOUT[texts.data])], axis=1).astype(np.int64)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


def features(counts: np.ndarray) -> np.ndarray:
    words, chars, symbols, dup, repeated, lines, capitals, shouts = counts.T.astype(float)
    per_word, per_char = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack([symbols / per_word, dup / np.maximum(lines, 1), repeated / per_word, chars / per_word,
                     capitals / per_char, shouts / per_word], axis=1)


@dataclass
class Forest:
    """Trees as arrays: node -> feature (-1: leaf), value, left child; the right child follows the left."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    length: np.ndarray
    norm: float
    low: np.ndarray
    high: np.ndarray
    used: np.ndarray
    threshold: float = field(default=np.inf)

    def excess(self, x: np.ndarray) -> np.ndarray:
        """Distance outside the good rows' range, in widths of that range."""
        width = np.maximum(self.high - self.low, MIN_WIDTH)
        out = np.concatenate([np.maximum(0, x - self.high) / width, np.maximum(0, self.low - x) / width], axis=1)
        return np.log1p(out[:, self.used])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1, higher where paths are short."""
        x, total = self.excess(x), np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, length in zip(self.feature, self.value, self.left, self.length):
            node = np.zeros(len(x), np.int64)
            while (split := feature[node] >= 0).any():
                right = x[rows, np.maximum(feature[node], 0)] >= value[node]
                node = np.where(split, left[node] + right, node)
            total += length[node]
        return np.exp2(-total / len(self.feature) / self.norm)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), n > 1)


def grow(x: np.ndarray, rng: np.random.Generator, depth: int) -> tuple[list, list, list, list]:
    feature, value, left, length = [-1], [0.0], [0], [0.0]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, at = todo.pop()
        span = x[rows].max(axis=0) - x[rows].min(axis=0)
        if at >= depth or not span.any():
            length[node] = at + float(average_path(len(rows)))
            continue
        # A measure is drawn by its span, so that specks of excess split rarely.
        f = rng.choice(len(span), p=span / span.sum())
        cut = x[rows, f].min() + (1 - rng.random()) * span[f]
        feature[node], value[node], left[node] = f, cut, len(feature)
        right = x[rows, f] >= cut
        for part in (rows[~right], rows[right]):
            todo.append((len(feature), part, at + 1))
            feature.append(-1), value.append(0.0), left.append(0), length.append(0.0)
    return feature, value, left, length


def fit(counts: np.ndarray, good: np.ndarray, seed: int = 0) -> Forest | None:
    """Forest and threshold from the counts of labelled rows; None if a class is absent or no measure tells them apart."""
    open_ = ~base_failed(counts)
    x, good = features(counts)[open_], good[open_]
    if good.all() or not good.any():
        return None
    rng = np.random.default_rng(seed)
    low, high = np.quantile(x[good], [MAX_GOOD_LOSS, 1 - MAX_GOOD_LOSS], axis=0)
    rows = min(TREE_ROWS, len(x))
    forest = Forest(*[np.zeros(0)] * 4, float(average_path(rows)) or 1.0, low, high, np.ones(2 * x.shape[1], bool))
    # A measure that good rows leave as often as bad ones says nothing; its outliers would only raise the threshold.
    y = forest.excess(x) > 0
    forest.used = y[~good].mean(axis=0) > TELLING * y[good].mean(axis=0)
    if not forest.used.any():
        return None
    y = forest.excess(x)
    trees = [grow(y[rng.choice(len(y), rows, replace=False)], rng, int(np.ceil(np.log2(max(rows, 2)))))
             for _ in range(TREES)]
    most = max(len(t[0]) for t in trees)
    for k, name in enumerate(("feature", "value", "left", "length")):
        setattr(forest, name, np.array([t[k] + [-1 if k == 0 else 0] * (most - len(t[k])) for t in trees]))
    score = forest.score(x)
    cuts = np.unique(np.concatenate((score, [np.inf])))
    good_lost = 1 - np.searchsorted(np.sort(score[good]), cuts) / good.sum()
    bad_lost = 1 - np.searchsorted(np.sort(score[~good]), cuts) / (~good).sum()
    allowed = good_lost <= MAX_GOOD_LOSS
    best = np.argmax(np.where(allowed, bad_lost - good_lost, -1))
    below = score[score < cuts[best]]
    forest.threshold = float((cuts[best] + below.max()) / 2 if len(below) and np.isfinite(cuts[best]) else cuts[best])
    return forest


def labelled_counts(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Counts and classes of a bounded sample of labelled rows, collected for fitting."""
    sample = (labels.where("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in blocks(batch.column(0)):
                made = measure(texts).T
                rows = batch.slice(first, end - first)
                yield pa.record_batch([rows.column(1), rows.column(2), *map(pa.array, made)],
                                      names=["doc_id", "quality", *COUNTS, *MORE])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The sample's size is bounded by its limit, so that it may be broadcast. Rows that repeat an id are one row of it.
    rows_ = (texts.join(F.broadcast(sample), "doc_id").select("text", "doc_id", F.col("quality").cast("long"))
             .mapInArrow(count, ", ".join(f"{c} long" for c in ("doc_id", "quality", *COUNTS, *MORE)))
             .groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS, *MORE)).alias("counts"))
             .select("doc_id", "quality", "counts.*").toPandas().sort_values("doc_id"))
    return rows_[[*COUNTS, *MORE]].to_numpy(np.int64).reshape(-1, 8), rows_["quality"].to_numpy() > 0


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of documents, then COUNTS, base_failed, anomaly and kept.

    Columns of the input that carry one of these names are not passed on.
    """
    forest = fit(*labelled_counts(documents, labels))
    added = [*COUNTS, "base_failed", "anomaly", "kept"]
    columns = [c for c in documents.columns if c not in added]
    at = columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in blocks(batch.column(at)):
                counts = measure(texts)
                failed = base_failed(counts)
                score = forest.score(features(counts)) if forest else np.zeros(texts.n)
                kept = ~failed & (score <= forest.threshold) if forest else ~failed
                rows = batch.slice(first, end - first)
                yield pa.record_batch([*rows.columns, *map(pa.array, counts.T[:5]), pa.array(failed), pa.array(score),
                                       pa.array(kept)], names=[*columns, *added])

    schema = documents.select(*columns).schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return documents.select(*columns).mapInArrow(
        judge, schema.add("base_failed", "boolean").add("anomaly", "double").add("kept", "boolean"))
