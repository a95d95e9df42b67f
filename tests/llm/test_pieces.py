"""Sampled encodings: exact probabilities on small words, round trips, independence of batches."""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa

from logloom.llm import pieces
from logloom.llm.flat import blocks
from pyspark.sql import functions as F

MODEL = pieces.read_model(pieces.MODEL)


def segmentations(v, raw: bytes):
    """All segmentations of one word with their probabilities."""
    known = {v.bytes_of[i]: i for i in range(len(v.bytes_of)) if v.bytes_of[i] and v.logp[i] > v.logp[v.unknown]}
    found = {}
    for cuts in itertools.product([0, 1], repeat=len(raw) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(raw)]
        parts = [raw[a:b] for a, b in zip(at, at[1:])]
        if all(p in known for p in parts):
            found[tuple(known[p] for p in parts)] = sum(v.logp[known[p]] for p in parts)
    top = np.logaddexp.reduce(list(found.values()))
    return {k: np.exp(x - top) for k, x in found.items()}


def draws(v, text, n, k):
    texts = next(blocks(pa.array([text] * n)))[2]
    out = []
    for some, counts, piece, at, step, data, logp, inclusion in pieces.sampled(texts, np.arange(n), v, k, 3):
        per, ids = pieces.ids_of(counts, piece, at, step, data, v)
        cut = np.concatenate(([0], np.cumsum(per)))
        out.append([(tuple(ids[cut[i]:cut[i + 1]].tolist()) if some[i] else None, logp[i], inclusion[i]) for i in range(n)])
    return out


def test_samples_without_replacement():
    v = pieces.vocabulary(MODEL)
    exact, n = segmentations(v, b" thing"), 20_000
    first, second = draws(v, "thing", n, 2)
    seen = Counter(s for s, _, _ in first)
    for s, p in exact.items():
        assert abs(seen[s] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4
    assert all(abs(np.log(exact[s]) - lp) < 1e-5 for s, lp, _ in first[:200])
    assert all(a[0] != b[0] for a, b in zip(first, second))
    # The second draw has the probability of drawing without replacement.
    want = Counter()
    for a, p in exact.items():
        for b, q in exact.items():
            if a != b:
                want[b] += p * q / (1 - p)
    got = Counter(s for s, _, _ in second)
    for s, p in want.items():
        assert abs(got[s] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4
    # Horvitz-Thompson: indicator over inclusion has mean one.
    s = max(exact, key=exact.get)
    total = sum(1 / inc for a, b in zip(first, second) for x, _, inc in (a, b) if x == s)
    assert abs(total / n - 1) < 0.05


def test_all_segmentations_then_none():
    v = pieces.vocabulary(MODEL)
    exact = segmentations(v, b" ab")
    got = draws(v, "ab", 5, len(exact) + 3)
    assert len([g for g in got if g[0][0] is not None]) == len(exact)
    assert {g[0][0] for g in got} - {None} == set(exact)
    assert all(abs(g[0][2] - 1) < 1e-9 for g in got if g[0][0] is not None)


def test_awkward_rows(spark, docs, no_docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    made = pieces.decoded(pieces.encoded(docs, k=3)).collect()
    by_first = Counter((r.doc_id, r.text) for r in made if r["sample"] == 1)
    assert by_first == Counter((d, t or "") for d, t in texts)
    assert all(r.ids == [] and r.inclusion == 1 for r in made if r.text == "")
    for key in {(r.doc_id, r.text) for r in made if r.doc_id is not None}:
        ids = {tuple(r.ids) for r in made if (r.doc_id, r.text) == key}
        assert len(ids) == len({r["sample"] for r in made if (r.doc_id, r.text) == key})
    digest = pieces.encoded_digest(docs.repartition(1), k=3)
    assert digest.where(~F.col("round_trip")).count() == 0
    again = {(r.doc_id, r["sample"], round(r.log_prob, 6)) for r in digest.collect()}
    assert again == {(r.doc_id, r["sample"], round(r.log_prob, 6)) for r in made}
    assert pieces.encoded(no_docs).count() == 0
