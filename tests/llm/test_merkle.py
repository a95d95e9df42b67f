"""The manifest against plain hashlib trees."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from logloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        yield level, at
        at >>= 1


def brute(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in order:
        by_lang[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = tree([leaf(r) for r in by_lang[k]])
    top = tree([trees[k][-1][0] for k in order])
    root, made = top[-1][0], []
    for rank, k in enumerate(order):
        for at, r in enumerate(by_lang[k]):
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now, proof = leaf((*r[:3], r[3] + 1, r[4]) if bad else r), ""
            for levels, i in ((trees[k], at), (top, rank)):
                for level, j in siblings(levels, i):
                    run = level[j // 2 * 2:j // 2 * 2 + 2]
                    proof += "".join(x for x in run[:j % 2] + run[j % 2 + 1:])
                    run[j % 2] = now
                    now = h(*run)
            made.append((r[0], leaf(r), trees[k][-1][0], root, h(proof), now, now == root))
    return sorted(made, key=repr)


def test_sha_states():
    texts = [hashlib.sha256(bytes([i])).hexdigest() for i in range(5)]
    words = merkle.unpacked(b"".join(map(bytes.fromhex, texts)))
    one = merkle.ended(merkle.absorb(merkle.START, merkle.hex_block(words)), 1)
    assert [merkle.packed(one[:, i:i + 1]).hex() for i in range(5)] == [h(t) for t in texts]
    state = merkle.absorb(merkle.START, merkle.hex_block(words[:, :4]))
    two = merkle.ended(merkle.absorb(state, merkle.hex_block(words[:, 1:])), 2)
    assert [merkle.packed(two[:, i:i + 1]).hex() for i in range(4)] == [h(*texts[i:i + 2]) for i in range(4)]
    assert merkle.packed(merkle.ended(merkle.START, np.array([0]))).hex() == h("")


def test_awkward_rows(spark, docs, no_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=repr) == brute(rows)
    assert merkle.manifest(no_docs).count() == 0


@pytest.mark.parametrize("depth", [1, 3])
def test_several_tiers(spark, depth):
    rng = random.Random(depth)
    langs = [None, "", "en", "en", "en", "zz", "Ünd", *(f"l{i}" for i in range(9))]
    rows = [(i, f"s{i % 3}", rng.choice(langs), i if i % 9 else None, f"text {i}") for i in range(150)]
    rows += [(200, "s", "only", 1, "t"), (7, "s", "en", 5, "again"), (7, "s", "en", 5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(5)
    assert sorted(map(tuple, merkle.manifest(df, depth).collect()), key=repr) == brute(rows)
    single = df.where("doc_id = 200")
    assert sorted(map(tuple, merkle.manifest(single, depth).collect()), key=repr) == brute([rows[150]])
