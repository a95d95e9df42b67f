"""Queries over the register and the migration work the old form of an event out once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.functions.rules import RULES_V2
from logloom.operators import migrate as mig
from logloom.plans import fixtures as fx
from logloom.plans.queries import QUERIES
from logloom.plans import queries_incidents  # noqa: F401  (registers its queries)

KINDS = ("view", "error", "click", "purchase", "signup", None)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("events"))
    rows = [(None if i % 41 == 40 else i // 2, None if i % 37 == 36 else datetime(2024, 1, 1) + timedelta(hours=7 * i),
             None if i % 29 == 28 else i % 50, KINDS[i % 6], float(i)) for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(
        f"{at}/events.parquet")
    return at


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["incident_type_list", "rule_config", "active_rules", "config_types"])
def test_forms_of_a_type(spark, folder, name):
    got = QUERIES[name](spark, folder)
    # The null filter of the join once went down to the events and repeated all rules there.
    assert "regexp_replace" not in got._jdf.queryExecution().optimizedPlan().toString()
    forms = dict(fx.register(spark, folder).groupBy("incident_typ").agg(F.count("*")).collect())
    key = "code" if name == "incident_type_list" else "incident_type"
    assert any(r.forms for r in got.collect()) and all(r.forms == forms.get(r[key], 0) for r in got.collect())


@pytest.mark.parametrize("name", ["migrate_outcome", "migrate_summary", "migrate_register", "migrate_conflicts", "migrate_splits"])
def test_migration(spark, folder, name, monkeypatch):
    events = fx.monitoring_events(spark, folder)
    moves = mig.moves_of(mig.moved_events(fx.bridge(spark, folder), events, RULES_V2, (1, 1)), events)
    register = fx.register(spark, folder)
    outcome = mig.migrate_outcome(moves, register)
    want = {"migrate_outcome": lambda: outcome, "migrate_summary": lambda: mig.migrate_summary(outcome),
            "migrate_register": lambda: mig.migrate_register(moves, register, RULES_V2),
            "migrate_conflicts": lambda: mig.migrate_listing(outcome, moves, "conflict"),
            "migrate_splits": lambda: mig.migrate_listing(outcome, moves, "split_needs_review")}[name]()
    made, formed = [], fx.fingerprinted
    monkeypatch.setattr(fx, "fingerprinted", lambda *given: made.append(given) or formed(*given))
    got = QUERIES[name](spark, folder)
    assert len(made) == 1 and got.columns == want.columns
    # Of repeated ids any row's texts may be the example.
    rest = [c for c in want.columns if c not in ("host", "program", "beispiel_roh")]
    assert _rows(got.select(rest)) == _rows(want.select(rest))
