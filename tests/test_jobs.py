"""Store, jobs, replay safety, and migrations with hand-made histories."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logloom.functions.rules import RULES_V1, RULES_V2, RuleSet, TokenRule
from logloom.operators import migrate as mig
from logloom.operators import quality as dq
from logloom.operators import register as reg
from logloom.plans import fixtures as fx
from logloom.plans import jobs
from logloom.streaming import streams
from logloom.streaming.store import Store

T = datetime(2024, 1, 1)
NOW = datetime(2024, 2, 1, 12)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return fx.monitoring_events(spark, sf_dir)


@pytest.fixture(scope="module")
def whole(spark, sf_dir):
    return rows_of(reg.register_delta(fx.fingerprinted(spark, sf_dir)), *reg.DELTA_COLUMNS)


def test_random_splits_give_the_register_of_one_batch(spark, events, whole, tmp_path):
    store, rng = Store(spark, str(tmp_path)), random.Random(5)
    cuts = [0] + sorted(rng.sample(range(1, 1000), 3)) + [1000]
    done = 0
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = events.where((F.col("id") >= a) & (F.col("id") < b))
        done += jobs.process_batch(store, part, "t", batch)
        assert jobs.process_batch(store, part, "t", batch) == 0          # same batch again
    assert done == 1000
    assert jobs.process_batch(store, events, "other", 0) == 0            # everything again, other run
    assert rows_of(store.register(), *reg.DELTA_COLUMNS) == whole
    assert store.bridge().count() == 1000
    assert dq.count_mismatch(store.register(), store.bridge()).count() == 0
    assert dq.orphan_forms(store.bridge(), store.register()).count() == 0


def test_instants_are_accepted_as_event_times(spark, events, whole, tmp_path):
    store = Store(spark, str(tmp_path))
    instants = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert jobs.process_batch(store, instants, "t", 0) == 1000
    assert rows_of(store.register(), *reg.DELTA_COLUMNS) == whole


def test_late_and_resent_ids(spark, events, tmp_path):
    store = Store(spark, str(tmp_path))
    assert jobs.process_batch(store, events.where("id % 2 = 0"), "t", 0) == 500
    again = events.unionByName(events.where("id < 50"))
    assert jobs.process_batch(store, again, "t", 1, unique_ids=False) == 500
    assert dq.duplicate_keys(store.bridge(), "event_id").count() == 0


def test_interrupted_batch_leaves_nothing(spark, events, whole, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))

    def fail(self, state):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", fail)
        with pytest.raises(OSError):
            jobs.process_batch(store, events, "t", 0)
    assert store.bridge().count() == 0 and store.register().count() == 0
    assert jobs.process_batch(store, events, "t", 0) == 1000
    assert rows_of(store.register(), *reg.DELTA_COLUMNS) == whole


def test_second_writer_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    state = store.state()
    store.commit(state)
    with pytest.raises(RuntimeError):
        store.commit(state)


def test_interleaved_writers_lose_nothing(spark, events, whole, tmp_path, monkeypatch):
    """Another writer commits its batch while the first one holds its draft."""
    store, commit = Store(spark, str(tmp_path)), Store._draft
    other, busy = events.where("id < 400"), []

    def draft(self, state):
        made = commit(self, state)
        if not busy:
            busy.append(True)
            assert jobs.process_batch(Store(spark, str(tmp_path)), other, "backfill", 0) == 400
        return made
    monkeypatch.setattr(Store, "_draft", draft)
    assert jobs.process_batch(store, events.where("id >= 400"), "follow", 0) == 600
    assert store.state()["version"] == 2 and store.state()["batches"] == {"backfill": 0, "follow": 0}
    columns = [c for c in reg.DELTA_COLUMNS if c not in ("beispiel_roh", "host", "program")]
    assert rows_of(store.register(), *columns) == sorted(
        (tuple(v for c, v in zip(reg.DELTA_COLUMNS, r) if c in columns) for r in whole), key=repr)


def test_backfill_in_pieces_pauses_and_goes_on(spark, events, tmp_path):
    store = Store(spark, str(tmp_path))
    day = datetime(2024, 2, 1, 12)
    assert jobs.backfill(store, events, None, now=datetime(2024, 2, 1, 23, 30), pieces=4, forced=False)[0] in ("pause", "process")
    first = store.bridge().count()
    assert 0 < first < 1000 and store.state()["version"] == 1
    assert jobs.backfill(store, events, None, now=day, pieces=4) == ("process", 1000 - first)
    assert store.bridge().count() == 1000


def test_backfill_admission_and_window(spark, events, tmp_path):
    store = Store(spark, str(tmp_path))
    night = datetime(2024, 2, 1, 23, 30)
    many = events.crossJoin(spark.range(3).withColumnRenamed("id", "k")).withColumn("id", F.col("id") * 3 + F.col("k")).drop("k")
    assert jobs.backfill(store, many, None, now=night) == ("refuse", 0)
    last = events.agg(F.max("timestamp")).first()[0]
    decision, n = jobs.backfill(store, events, 5, now=last)
    assert decision == "process" and n == events.where(F.col("timestamp") >= F.lit(last) - F.expr("INTERVAL 5 DAYS")).count()
    assert jobs.backfill(store, events, None, now=NOW)[0] == "idle"      # skipped ids lie below the mark


def test_stream_of_many_files_equals_batch(spark, events, whole, tmp_path):
    events.repartitionByRange(4, "id").write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), "parquet", events.schema, files_per_trigger=1)
    query = streams.run_fingerprints(stream, store, "follow", str(tmp_path / "cp"), streams.CATCH_UP)
    query.awaitTermination()
    # The text example is that of the batch a form first came in; files do
    # not arrive in id order.
    at = reg.DELTA_COLUMNS.index("beispiel_roh")
    columns = [c for c in reg.DELTA_COLUMNS if c != "beispiel_roh"]
    assert rows_of(store.register(), *columns) == sorted((r[:at] + r[at + 1:] for r in whole), key=repr)
    assert store.ticks().count() == 4
    beat = reg.heartbeat(store.ticks()).first()
    assert beat.mode == "follow" and beat.last_batch_size > 0


def test_bucketed_tables_join_without_shuffle(spark, sf_dir, events):
    from logloom.sources.collect import write_bucketed
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df, key in (("t_events", events, "id"), ("t_bridge", fx.bridge(spark, sf_dir), "event_id")):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            write_bucketed(df, name, key, 4)
        moved = mig.moved_events(spark.table("t_bridge"), spark.table("t_events"), RULES_V2, (1, 1))
        plan = moved._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert moved.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("t_events", "t_bridge"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- migration -------------------------------------------------------------

OLD = RuleSet(1, 1, (TokenRule("keep", "<K>", r"\bKK\b"),))
NEW = RuleSet(1, 2, (TokenRule("num", "<N>", r"\b\d+\b"), TokenRule("keep", "<K>", r"\bKK\b"),
                     TokenRule("split", "<Z>", r"^zz.*")))


def history(spark, messages, classes):
    """Bridge, events and register under OLD with classes per message."""
    ev = spark.createDataFrame([(i, T + timedelta(minutes=i), "h", "p", m) for i, m in enumerate(messages)],
                               "id long, timestamp timestamp_ntz, host string, program string, message string")
    from logloom.functions.text import with_fingerprint
    fp = with_fingerprint(ev, OLD)
    table = spark.createDataFrame([(f"h|p|{m}", k, t, T, "axel", v) for m, (k, t, v) in classes.items()],
                                  "fingerprint string, klasse string, incident_typ string, bewertet_am timestamp_ntz, "
                                  "bewertet_von string, llm_vorschlag string")
    return reg.bridge_rows(fp, OLD), ev, reg.register_delta(fp, OLD).join(table, "fingerprint", "left")


@pytest.fixture(scope="module")
def migrated(spark):
    messages = ["rename 1", "agree 1", "agree 2", "fight 1", "fight 2", "three 1", "three 2", "three 3", "same", "open 1",
                "same open", "null 1", "null 2", "same"]
    classes = {
        "rename 1": ("relevant", "I-01", '{"a":1}'), "agree 1": ("betrieb", None, None), "agree 2": ("betrieb", None, None),
        "fight 1": ("betrieb", None, None), "fight 2": ("kritisch", None, None),
        "three 1": ("betrieb", None, None), "three 2": ("kritisch", None, None), "three 3": ("betrieb", None, None),
        "same": ("rauschen", None, None), "null 1": (None, "I-02", None), "null 2": (None, "I-02", None)}
    bridge, ev, register = history(spark, messages, classes)
    moved = mig.moved_events(bridge, ev, NEW, (1, 1))
    moves = mig.moves_of(moved, ev)
    return {"outcome": {r.old_fingerprint[4:]: r.outcome for r in mig.migrate_outcome(moves, register).collect()},
            "register": {r.fingerprint[4:]: r for r in mig.migrate_register(moves, register, NEW).collect()},
            "frames": (mig.migrate_bridge(bridge, moved, NEW), mig.migrate_register(moves, register, NEW))}


def test_rows_of_other_versions_pass_by_the_migration(spark):
    columns = "event_id long, fingerprint string, cleaner_ver int, normalizer_ver int, bom_missing boolean"
    bridge = spark.createDataFrame([(1, "a", 1, 1, True), (2, "b", 1, 1, False), (3, "c", 1, 0, False), (4, "d", None, None, None)], columns)
    moved = spark.createDataFrame([(1, "x"), (None, "y")], "event_id long, new_fingerprint string")
    got = mig.migrate_bridge(bridge, moved, NEW, (1, 1))
    want = [(1, "x", NEW.cleaner_ver, NEW.normalizer_ver, True), *map(tuple, bridge.where("event_id > 1").collect())]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sorted(map(tuple, mig.migrate_bridge(bridge, moved, NEW).collect())) == sorted(want)


def test_outcomes(migrated):
    assert migrated["outcome"] == {
        "rename 1": "carried_over", "agree 1": "carried_over", "agree 2": "already_consistent", "fight 1": "carried_over",
        "fight 2": "conflict", "three 1": "carried_over", "three 2": "conflict", "three 3": "already_consistent",
        "same": "already_consistent", "open 1": "unclassified_no_action", "same open": "unclassified_no_action",
        "null 1": "carried_over", "null 2": "already_consistent"}


def test_register_after(migrated):
    r = migrated["register"]
    assert set(r) == {"rename <N>", "agree <N>", "fight <N>", "three <N>", "same", "open <N>", "same open", "null <N>"}
    assert (r["rename <N>"].klasse, r["rename <N>"].incident_typ, r["rename <N>"].llm_vorschlag) == ("relevant", "I-01", '{"a":1}')
    assert r["agree <N>"].klasse == "betrieb" and r["agree <N>"].vorkommen == 2
    assert r["fight <N>"].klasse is None and r["fight <N>"].bewertet_von is None
    assert r["three <N>"].bewertet_am is None and r["three <N>"].vorkommen == 3
    assert r["same"].klasse == "rauschen" and r["same"].vorkommen == 2 and r["same"].normalizer_ver == 2
    assert r["null <N>"].incident_typ == "I-02"


def test_keys_hold_after(migrated):
    bridge, register = migrated["frames"]
    assert dq.orphan_forms(bridge, register).count() == 0
    assert dq.count_mismatch(register, bridge).count() == 0
    assert bridge.where("normalizer_ver <> 2").count() == 0


def test_split_leaves_targets_unclassified(spark):
    back = RuleSet(1, 3, RULES_V1.rules[:-1])
    ev = spark.createDataFrame([(i, T, "h", "p", f"item {i}") for i in range(3)],
                               "id long, timestamp timestamp_ntz, host string, program string, message string")
    from logloom.functions.text import with_fingerprint
    fp = with_fingerprint(ev, RULES_V1)
    register = reg.register_delta(fp).withColumns({
        "klasse": F.lit("betrieb"), "incident_typ": F.lit(None).cast("string"), "bewertet_am": F.lit(T).cast("timestamp_ntz"),
        "bewertet_von": F.lit("axel"), "llm_vorschlag": F.lit(None).cast("string")})
    moves = mig.moves_of(mig.moved_events(reg.bridge_rows(fp), ev, back, (1, 1)), ev)
    assert [r.outcome for r in mig.migrate_outcome(moves, register).collect()] == ["split_needs_review"]
    after = mig.migrate_register(moves, register, back)
    assert after.count() == 3 and after.where("klasse IS NOT NULL").count() == 0
    assert mig.migrate_listing(mig.migrate_outcome(moves, register), moves, "split_needs_review").count() == 3


def test_version_detection(spark):
    def bridge(*versions):
        return spark.createDataFrame(list(versions), "cleaner_ver int, normalizer_ver int")
    assert mig.old_version(bridge((1, 2)), RULES_V2) is None
    assert mig.old_version(bridge((1, 1), (1, 2)), RULES_V2) == (1, 1)
    assert mig.old_version(bridge((1, 1), (2, 1)), RULES_V2, (2, 1)) == (2, 1)
    assert mig.old_version(bridge((1, 1)), RULES_V2, (1, 2)) is None
    with pytest.raises(mig.AmbiguousVersion):
        mig.old_version(bridge((1, 1), (2, 1)), RULES_V2)


def test_migrate_job(spark, sf_dir, events, tmp_path):
    store = Store(spark, str(tmp_path))
    jobs.process_batch(store, events, "t", 0)
    assert jobs.migrate(store, events, RULES_V1) is None
    before = store.state()
    plan = jobs.migrate(store, events, RULES_V2, dry_run=True)
    assert plan.where("outcome <> 'dry-run'").count() == 0 and store.state() == before
    outcome = jobs.migrate(store, events, RULES_V2)
    assert outcome.where("outcome <> 'unclassified_no_action'").count() == 0
    fresh = reg.register_delta(fx.fingerprinted(spark, sf_dir, RULES_V2), RULES_V2)
    columns = [c for c in reg.DELTA_COLUMNS if c != "beispiel_roh"]
    assert rows_of(store.register(), *columns) == rows_of(fresh, *columns)
    assert store.bridge().where("normalizer_ver = 2").count() == 1000
    assert jobs.migrate(store, events, RULES_V2) is None
    assert jobs.process_batch(store, events, "t", 1, RULES_V2) == 0      # still known after the move


# --- delivery mark ---------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_delivery_watermark(spark, seed):
    rng, rows = random.Random(seed), []
    for source in "abcd":
        for i in range(60):
            at = T + timedelta(minutes=rng.randint(0, 400) // 20 * 20)
            rows.append((source, at, i, source == "d" or rng.random() > (0.9 if source == "c" else 0.03)))
    old = [("a", T - timedelta(days=1)), ("c", T - timedelta(days=1)), ("x", T)]
    want = {}
    for source in "abcd":
        mark = dict(old).get(source)
        for _, at, _, ok in sorted(r for r in rows if r[0] == source):
            if not ok:
                break
            mark = at
        want[source] = mark
    df = spark.createDataFrame(rows, "source string, ts timestamp_ntz, id int, ok boolean")
    marks = spark.createDataFrame(old, "source string, mark timestamp_ntz")
    assert {r.source: r.mark for r in reg.delivery_watermark(df, "source", marks).collect()} == want


@pytest.mark.parametrize("bounds", [None, [], [7, 50, 600], list(range(0, 1000, 7))])
def test_batch_ranges(spark, bounds):
    ids = sorted(random.Random(2).sample(range(1000), 333))
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    want = {(n, b[0], b[-1], len(b)) for n, b in enumerate(ids[k:k + 40] for k in range(0, 333, 40))}
    assert {tuple(r) for r in reg.batch_ranges(df, 40, bounds).collect()} == want


def test_batch_ranges_with_an_outlier_id(spark):
    ids = [10 ** 15, *range(20_000)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    bounds = reg.id_bounds(df, 64)
    per = [sum(1 for i in ids if lo < i <= hi) for lo, hi in zip([-1, *bounds], [*bounds, 10 ** 16])]
    assert max(per) < 3 * len(ids) / 64
    got = sorted(tuple(r) for r in reg.batch_ranges(df, 500).collect())
    order = sorted(ids)
    assert got == [(k, order[500 * k], order[min(500 * k + 499, 20_000)], min(500, 20_001 - 500 * k)) for k in range(41)]


def test_no_conf_is_set_for_the_work_folder(spark):
    from logloom.session import shared_dir
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_follow_waits_for_the_blackout_and_ticks_when_idle(spark, events, tmp_path):
    import time
    events.where("id < 50").write.parquet(str(tmp_path / "in"))
    store, clock, waited = Store(spark, str(tmp_path / "store")), [datetime(2024, 2, 1, 23, 30), datetime(2024, 2, 1, 12)], []
    stream = streams.file_stream(spark, str(tmp_path / "in"), "parquet", events.schema)
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "500")
    query = streams.follow(stream, store, str(tmp_path / "cp"), {"processingTime": "1 second"}, limit=10,
                           now=lambda: clock.pop(0), wait=waited.append)
    try:
        idle, end = [], time.time() + 60
        while not idle and time.time() < end:
            time.sleep(1)
            idle = [r for r in store.ticks().where("pending = 0").collect()] if store.bridge().count() == 50 else []
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    assert waited == [60.0] and idle
    now = max(r.tick_at for r in store.ticks().collect())
    beat = reg.heartbeat(store.ticks())
    assert reg.heartbeat_state(beat, F.lit(now + timedelta(hours=7)).cast("timestamp_ntz"), 8 * 3600).first().state == "idle"


def test_a_backlog_in_small_files_defers(spark, events, tmp_path):
    """Batches of one file each never reach the limit; what waits in all files does."""
    for k in range(10):
        events.where(f"id % 10 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    store, clock, waited = Store(spark, str(tmp_path / "store")), [datetime(2024, 2, 1, 23, 50)] * 2, []

    def now():
        return clock.pop() if clock else datetime(2024, 2, 1, 12)
    stream = streams.file_stream(spark, str(tmp_path / "in"), "parquet", events.schema, files_per_trigger=1)
    query = streams.follow(stream, store, str(tmp_path / "cp"), {"availableNow": True}, limit=900, now=now, wait=waited.append,
                           source=lambda: spark.read.schema(events.schema).parquet(str(tmp_path / "in")))
    assert query.awaitTermination(300)
    assert waited == [60.0, 60.0] and store.bridge().count() == 1000
    ticks = sorted(store.ticks().collect())
    assert [(r.pending, r.processed) for r in ticks[:3]] == [(1000, 0), (1000, 0), (1000, 100)]
    assert sum(r.processed for r in ticks) == 1000


def test_ticks_are_read_while_they_are_written(spark, tmp_path):
    import threading
    store, failed = Store(spark, str(tmp_path)), []

    def write():
        try:
            for k in range(200):
                jobs.record_tick(store, "follow", k, k % 2)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    writer = threading.Thread(target=write)
    writer.start()
    reads = 0
    while writer.is_alive() or not reads:
        store.ticks().count()
        reads += 1
    writer.join()
    assert not failed and reads and store.ticks().count() == 200


def test_old_ticks_go_once_superseded():
    from logloom.streaming.store import recent_ticks, stale_ticks
    names = [f"{at:020d}~{mode}~{kind}~x.json" for at, mode, kind in
             [(1, "a", "work"), (2, "a", "idle"), (3, "b", "work"), (4, "a", "work"), (5, "a", "idle"), (9, "a", "idle")]]
    assert stale_ticks(names, 6) == [names[0], names[1]]       # superseded before 6
    assert stale_ticks(names, 5) == [names[0], names[1]]
    assert stale_ticks(names, 4) == []
    assert recent_ticks(names, 6) == [names[2], names[3], names[5]]
    assert not set(recent_ticks(names, 6)) & set(stale_ticks(names, 6))


def test_a_batch_rewrites_only_the_partitions_it_touches(spark, events, tmp_path):
    store = Store(spark, str(tmp_path))
    jobs.process_batch(store, events.where("id < 990"), "t", 0)
    before = store.state()["register"]
    jobs.process_batch(store, events.where("id >= 990"), "t", 1)
    after = store.state()["register"]
    moved = [p for p in after if after[p] != before.get(p)]
    forms = store.bridge().where("event_id >= 990").select(store.part_of("fingerprint")).distinct().count()
    assert len(moved) == forms < len(after)
    written = spark.read.parquet(str(tmp_path / after[moved[0]])).count()
    assert written < store.register().count() / 2
    assert dq.count_mismatch(store.register(), store.bridge()).count() == 0
