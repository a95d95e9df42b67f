import math
import random

import pytest

from logloom.llm import topk


def brute(queries, rows, k, scale):
    def usable(r):
        return r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    def whole(v):
        return [math.floor(scale * x) for x in v]

    out = []
    for q, v in filter(usable, queries):
        found = [(-sum(a * b for a, b in zip(whole(v), whole(w))), c)
                 for c, w in filter(usable, rows) if c != q and len(w) == len(v)]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, queries, rows, k, scale=64, parts=3):
    schema = "vec_id long, embedding array<float>, label int"
    a, b = (spark.createDataFrame([(i, v, 1) for i, v in x], schema).repartition(parts) for x in (queries, rows))
    return sorted(tuple(r) for r in topk.top_k(a, b, k, scale).collect())


@pytest.mark.parametrize("case", ["plain", "ties", "few", "odd", "empty"])
def test_against_brute_force(spark, case, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    if case == "ties":
        rows = [(i, [0.5, 0.25, 0.0, -0.5] if i % 2 else [0.5, 0.25, 0.0, 1.0]) for i in range(60)]
    if case == "few":
        rows = rows[:4]
    if case == "odd":
        rows += [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [1.0, math.nan, 0.0, 0.0]), (103, [math.inf] * 4),
                 (104, [1.0, 2.0]), (40, [0.1] * 4), (40, [0.1] * 4), (None, [0.1] * 4), (105, []), (106, [3e6] * 4)]
    if case == "empty":
        rows = []
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    queries = [r for r in rows if r[0] is None or r[0] % 5 == 0]
    assert run(spark, queries, rows, 7) == brute(queries, rows, 7, 64)


@pytest.mark.parametrize("distinct", [9, 400])
def test_many_cells(spark, distinct, monkeypatch):
    """Whatever the cut into blocks, tasks and slices of queries, and however many scores tie."""
    rng = random.Random(distinct)
    kinds = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(distinct)]
    rows = [(i, kinds[rng.randrange(distinct)]) for i in range(400)]
    for name, value in (("CANDIDATE_BLOCK", 96), ("QUERY_BLOCK", 24), ("SCORED", 5), ("BIN_BITS", 5), ("HELD_BYTES", 5000)):
        monkeypatch.setattr(topk, name, value)
    queries = [r for r in rows if r[0] % 5 == 0]
    assert run(spark, queries, rows, 3) == brute(queries, rows, 3, 64)


def test_grid_is_not_broadcast(spark, monkeypatch):
    """Each query block meets each candidate block without passing through the driver, however small their files seem."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    plans, staged = [], topk.staged

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(topk, "staged", lambda df, purpose: plans.append(plan(df)) or staged(df, purpose))
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    plans.append(plan(topk.top_k(docs.where("vec_id % 5 = 0"), docs, 7)))
    assert any("MapInArrow" in p for p in plans) and not [p for p in plans if "Broadcast" in p]
