"""Where a job keeps bridge, register and progress between batches.

Plain Parquet folders plus one small commit record per batch.  A batch
becomes visible when its record is created under a name that must not exist;
the writer then reads the record back and checks that it is its own.  What an
interrupted or refused batch left behind is never read.  The check holds on
file systems whose rename without overwriting is atomic; an object store
needs a committer of its own.
"""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BRIDGE_SCHEMA = ("event_id long, fingerprint string, cleaner_ver int, normalizer_ver int, "
                 "computed_at timestamp_ntz, bom_missing boolean, bom_missing_unverified boolean, "
                 "event_ts timestamp_ntz")
REGISTER_SCHEMA = ("fingerprint string, host string, program string, beispiel_roh string, "
                   "erstmals timestamp_ntz, zuletzt timestamp_ntz, vorkommen long, cleaner_ver int, "
                   "normalizer_ver int, klasse string, incident_typ string, bewertet_am timestamp_ntz, "
                   "bewertet_von string, llm_vorschlag string")
TICK_SCHEMA = "tick_at timestamp_ntz, mode string, pending long, processed long"
#: Partitions of the register, by a hash of the form.  Many next to the forms
#: of a batch, so that a batch rewrites little more than it changes.
REGISTER_PARTS = 256
#: Age in seconds after which a tick may go.
KEEP_TICKS = 2 * 86400


class Conflict(RuntimeError):
    """Another writer has committed this version."""


class Store:
    """State of one fingerprint pipeline below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- commits ---

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop.Path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def state(self) -> dict:
        """Latest commit: folder of each register partition, bridge folder, the bridge's highest
        event id, and the last committed batch of each run."""
        names = [n for n in self._names("commits") if n.endswith(".json")]
        if not names:
            return {"version": 0, "register": {}, "bridge": "bridge-0", "batches": {}, "top": None}
        return self._record(names[-1])

    def _record(self, name: str) -> dict:
        stream = self._fs.open(self._hadoop.Path(f"{self.path}/commits/{name}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _draft(self, state: dict) -> str:
        """Write a record under a name of its own; no other writer touches it."""
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}.json"
        out = self._fs.create(self._hadoop.Path(draft), False)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        return draft

    def commit(self, state: dict) -> None:
        """Create the next record, or raise Conflict if another writer has."""
        state = state | {"version": state["version"] + 1, "owner": uuid.uuid4().hex}
        draft = self._draft(state)
        name = f"{state['version']:012d}.json"
        final = self._hadoop.Path(f"{self.path}/commits/{name}")
        self._fs.mkdirs(final.getParent())
        gateway, jvm = self.spark.sparkContext._gateway, self.spark._jvm
        context = self._hadoop.FileContext.getFileContext(
            final.toUri() if final.toUri().getScheme() else self._fs.getUri(),
            self.spark.sparkContext._jsc.hadoopConfiguration())
        keep = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._hadoop.Path(draft), final, keep)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            raise Conflict(f"another writer committed version {state['version']}") from None
        if self._record(name).get("owner") != state["owner"]:
            raise Conflict(f"another writer committed version {state['version']}")

    def committed(self, run: str) -> int:
        return self.state()["batches"].get(run, -1)

    # --- tables ---

    def _read(self, folder: str | None, schema: str) -> DataFrame:
        at = f"{self.path}/{folder}"
        if folder is None or not self._fs.exists(self._hadoop.Path(at)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(at)

    def part_of(self, fingerprint: Column | str) -> Column:
        return F.pmod(F.xxhash64(fingerprint), F.lit(REGISTER_PARTS)).cast("int")

    def register(self, parts: list[int] | None = None) -> DataFrame:
        """The register, or only the given partitions of it."""
        held = self.state()["register"]
        paths = [f"{self.path}/{folder}/part={part}" for part, folder in held.items()
                 if parts is None or int(part) in parts]
        if not paths:
            return self.spark.createDataFrame([], REGISTER_SCHEMA)
        return self.spark.read.schema(REGISTER_SCHEMA).parquet(*paths)

    def write_register(self, rows: DataFrame, folder: str) -> dict[str, str]:
        """Write rows to a new folder, one file per partition; returns where
        each partition that has rows now lies."""
        rows.withColumn("part", self.part_of("fingerprint")).repartition("part").write.mode("overwrite").partitionBy(
            "part").parquet(f"{self.path}/{folder}")
        return {name.removeprefix("part="): folder for name in self._names(folder) if name.startswith("part=")}

    def bridge(self) -> DataFrame:
        """Rows of committed batches; others are pruned as partitions."""
        state = self.state()
        rows = self._read(state["bridge"], BRIDGE_SCHEMA + ", run string, batch long")
        visible = F.lit(False)
        for run, last in state["batches"].items():
            visible = visible | ((F.col("run") == run) & (F.col("batch") <= last))
        return rows.where(visible).drop("run", "batch")

    # --- ticks: one small file each, never overwritten ---

    def record_tick(self, tick_at: datetime, mode: str, pending: int, processed: int) -> None:
        """Append a tick; no Spark job, so that a listener may call it."""
        row = {"tick_at": tick_at.isoformat(sep=" "), "mode": mode, "pending": int(pending), "processed": int(processed)}
        name = f"{time.time_ns():020d}~{mode}~{'work' if processed else 'idle'}~{uuid.uuid4().hex}.json"
        folder = f"{self.path}/ticks"
        draft = self._hadoop.Path(f"{folder}/_{name}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(row), "utf-8"))
        out.close()
        self._fs.rename(draft, self._hadoop.Path(f"{folder}/{name}"))
        for old in stale_ticks(self._tick_names(), time.time_ns() - KEEP_TICKS * 10 ** 9):
            self._fs.delete(self._hadoop.Path(f"{folder}/{old}"), False)

    def _tick_names(self) -> list[str]:
        return [n for n in self._names("ticks") if n.endswith(".json") and n[0].isdigit()]

    def ticks(self) -> DataFrame:
        """Recent ticks, and the last ones of each job.  The files are named
        one by one: nobody changes them, and none that is read here is due to
        go while it is read."""
        names = recent_ticks(self._tick_names(), time.time_ns() - KEEP_TICKS * 10 ** 9 // 2)
        if not names:
            return self.spark.createDataFrame([], TICK_SCHEMA)
        rows = self.spark.read.schema(TICK_SCHEMA.replace("timestamp_ntz", "string")).json(
            [f"{self.path}/ticks/{n}" for n in names])
        return rows.withColumn("tick_at", F.col("tick_at").cast("timestamp_ntz"))

    def bridge_folder(self, state: dict, run: str, batch: int) -> str:
        return f"{self.path}/{state['bridge']}/run={run}/batch={batch}"


def _last_of(names: list[str]) -> dict[tuple[str, str], str]:
    """Latest tick of each job, and its latest one with work."""
    last = {}
    for name in sorted(names):
        _, mode, kind, _ = name.split("~")
        last[mode, "any"] = name
        if kind == "work":
            last[mode, kind] = name
    return last


def recent_ticks(names: list[str], since_ns: int) -> list[str]:
    return sorted({n for n in names if int(n.split("~")[0]) >= since_ns} | set(_last_of(names).values()))


def stale_ticks(names: list[str], before_ns: int) -> list[str]:
    """Ticks that are old and were already superseded that long ago, so that
    no reader who listed the folder since then waits for them."""
    old = [n for n in names if int(n.split("~")[0]) < before_ns]
    return sorted(set(old) - set(_last_of(old).values()))
