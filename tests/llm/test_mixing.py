from collections import defaultdict

import pytest

from logloom.llm import mixing

DIMS = ("source", "lang", "topic")


def brute(cells, targets, rounds=200):
    """Raked weights of cells {(source, lang, topic): tokens} by plain loops."""
    total = sum(cells.values())
    weight = {c: t / total for c, t in cells.items()}
    for _ in range(rounds):
        for k in range(3):
            now = defaultdict(float)
            for c, w in weight.items():
                now[c[k]] += w
            weight = {c: w * targets[DIMS[k]][c[k]] / now[c[k]] for c, w in weight.items()}
    return weight


def shares(cells, k, target):
    tokens = defaultdict(int)
    for c, t in cells.items():
        tokens[c[k]] += t
    given = {v: s for v, s in target.shares.items() if v in tokens}
    others = {v: t ** target.power for v, t in tokens.items() if v not in given}
    left = max(0, 1 - sum(given.values())) if others else 0
    raw = given | {v: p / sum(others.values()) * left for v, p in others.items()}
    return {v: s / sum(raw.values()) for v, s in raw.items()}


def test_weights_and_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixed(docs).collect()
    cells = defaultdict(int)
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
        assert r.tokens == -(-len(r.text.encode()) // 4)
    targets = {d: shares(cells, k, mixing.TARGETS[d]) for k, d in enumerate(DIMS)}
    want, total = brute(cells, targets), sum(cells.values())
    assert max(abs(r.weight - want[r.source, r.lang, r.topic]) for r in rows) < 1e-6
    spent = sum(r.tokens * r.probability for r in rows) / total
    assert abs(spent - mixing.BUDGET) < 1e-3
    # Every marginal has supply enough here, so the sample is expected to meet each target.
    for k, d in enumerate(DIMS):
        for v, share in targets[d].items():
            have = sum(r.tokens for r in rows if r[d] == v) / total
            assert have >= share * mixing.BUDGET
            expected = sum(r.tokens * r.probability for r in rows if r[d] == v) / total
            assert abs(expected / (share * mixing.BUDGET) - 1) < 1e-3, (d, v)
    assert any(r.probability == 1 for r in rows)
    taken = sum(r.tokens for r in rows if r.sampled) / total
    assert abs(taken - mixing.BUDGET) < 0.08


def test_awkward_rows(spark, docs, no_docs):
    made = mixing.mixed(docs)
    assert made.columns.count("topic") == 1 and made.count() == docs.count()
    rows = made.collect()
    assert all((r.text or "") or r.tokens == 0 for r in rows)
    same = defaultdict(set)
    for r in rows:
        same[r.doc_id, r.text].add((r.probability, r.sampled))
    assert all(len(v) == 1 for v in same.values())
    assert mixing.mixed(no_docs).count() == 0
    again = {(r.doc_id, r.text, r.sampled) for r in mixing.mixed(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.text, r.sampled) for r in rows}


def test_plan_is_native(docs):
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("budget", [0.0, 1.0])
def test_budget_ends(spark, docs, budget):
    rows = mixing.mixed(docs, budget=budget).where("tokens > 0").collect()
    assert all(r.sampled == (budget == 1.0) for r in rows)


def table_of(spark, tokens, topics=(("prose", 700), ("table", 300))):
    cells = {(f"s{i}", lang, topic): int(t * n) for i, row in enumerate(tokens)
             for lang, t in zip(("en", "de", "fr", "es"), row) if t for topic, n in topics}
    return cells, spark.createDataFrame([(*c, t) for c, t in cells.items()],
                                        "source string, lang string, topic string, tokens long")


SLOW = [[[1000, .5, .5, .5], [.15, 300, .15, .15], [.1, .1, 200, .1], [.05, .05, .05, 100]],
        [[999, 1, 0, 0], [1, 500, 250, 250]]]


@pytest.mark.parametrize("tokens", SLOW)
def test_slow_but_feasible_targets_are_met(spark, tokens):
    cells, table = table_of(spark, tokens)
    made, outcome = mixing.rake(table, mixing.TARGETS)
    assert outcome.error <= 2e-5 and not outcome.contradictory and outcome.rounds > 40
    rows = {(r.source, r.lang, r.topic): r for r in made.collect()}
    assert set(rows) == set(cells) and all(rows[c].tokens == t for c, t in cells.items())
    targets = {d: shares(cells, k, mixing.TARGETS[d]) for k, d in enumerate(DIMS)}
    want = brute(cells, targets, 3000)
    assert max(abs(rows[c].weight - want[c]) for c in cells) < 1e-4
    for k, d in enumerate(DIMS):
        for v, share in targets[d].items():
            assert abs(sum(r.weight for c, r in rows.items() if c[k] == v) - share) < 2e-5


def test_contradictory_targets_are_reported(spark):
    cells, table = table_of(spark, [[1, 0, 0, 0], [0, 2, 0, 0], [0, 0, 1, 1]])
    made, outcome = mixing.rake(table, mixing.TARGETS)
    assert outcome.contradictory and outcome.rounds < 100
    rows = {(r.source, r.lang, r.topic): r.weight for r in made.collect()}
    targets = {d: shares(cells, k, mixing.TARGETS[d]) for k, d in enumerate(DIMS)}
    for k, d in enumerate(DIMS):
        off = max(abs(sum(w for c, w in rows.items() if c[k] == v) / share - 1) for v, share in targets[d].items())
        assert abs(outcome.errors[d] - off) < 1e-9
    assert outcome.error > 0.1
    docs = [(i, "word " * 40, lang, source) for i, (source, lang, _) in enumerate(cells)]
    with pytest.warns(UserWarning, match="contradict each other.*source by up to 0"):
        mixing.mixed(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"))


@pytest.mark.parametrize("tokens", [[[3, 1, 0, 0], [1, 2, 1, 1]], [[1, 0, 0, 0], [0, 2, 0, 0]]])
def test_table_and_driver_rake_alike(spark, tokens, monkeypatch):
    _, table = table_of(spark, tokens)
    made, outcome = mixing.rake(table, mixing.TARGETS, 6)
    monkeypatch.setattr(mixing, "LOCAL_CELLS", 0)
    again, outcome_again = mixing.rake(table, mixing.TARGETS, 6)
    assert (outcome.rounds, outcome.contradictory) == (outcome_again.rounds, outcome_again.contradictory)
    assert outcome_again.errors == pytest.approx(outcome.errors, abs=1e-9)
    a, b = ({r[:3]: r.weight for r in t.select(*DIMS, "weight").collect()} for t in (made, again))
    assert b == pytest.approx(a, abs=1e-12)


def brute_capped(cells, weight, targets, budget, rounds=2000):
    """Expected shares by plain loops: full cells fixed, the rest scaled."""
    total = sum(cells.values())
    has = {c: t / total for c, t in cells.items()}
    goals = {}
    for k, d in enumerate(DIMS):
        supply = defaultdict(float)
        for c, h in has.items():
            supply[c[k]] += h
        low, high = 0.0, max(supply[v] / t for v, t in targets[d].items())
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(supply[v], mid * t) for v, t in targets[d].items()) < budget else (low, mid)
        goals[d] = {v: min(supply[v], high * t) for v, t in targets[d].items()}
    kept = {c: min(has[c], budget * weight[c]) for c in cells}
    for _ in range(rounds):
        for k, d in enumerate(DIMS):
            for v, goal in goals[d].items():
                mine = [c for c in cells if c[k] == v]
                full = [c for c in mine if kept[c] >= has[c]]
                held, now = sum(kept[c] for c in full), sum(kept[c] for c in mine)
                for c in mine:
                    if goal < now:
                        kept[c] *= goal / now
                    elif c not in full and now > held:
                        kept[c] = min(has[c], kept[c] * (goal - held) / (now - held))
    return kept, goals


@pytest.mark.parametrize("budget", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("local", [True, False])
def test_capped_cells_against_plain_loops(spark, monkeypatch, budget, local):
    if not local and budget != 0.6:
        pytest.skip("one budget is enough for the table")
    cells, table = table_of(spark, [[50, 9, 9, 9], [6, 10, 3, 5], [8, 4, 12, 1]])
    targets = {d: shares(cells, k, mixing.TARGETS[d]) for k, d in enumerate(DIMS)}
    raked, _ = mixing.rake(table, mixing.TARGETS)
    monkeypatch.setattr(mixing, "LOCAL_CELLS", 10 ** 6 if local else 0)
    made, outcome = mixing.capped(raked, mixing.TARGETS, budget, mixing.MAX_ROUNDS if local else 12)
    want, goals = brute_capped(cells, brute(cells, targets, 500), targets, budget, 400 if local else 12)
    got = {r[:3]: r.kept for r in made.select(*DIMS, "kept").collect()}
    assert got == pytest.approx(want, abs=1e-4)
    for k, d in enumerate(DIMS):
        off = max(abs(sum(x for c, x in got.items() if c[k] == v) / g - 1) for v, g in goals[d].items())
        assert abs(outcome.errors[d] - off) < 1e-4
