"""Ordered operations per key that survive a key holding most of the rows.

A plain window per key puts all rows of a key into one task.  Here each key's
timeline is cut into slices of ``width`` seconds.  Windows run inside
(key, slice); what has to cross a slice border is a summary of one row per
(key, slice), over which a second, small window runs.  Results equal those of
a window over the whole key, for any width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = "_slice"
HOUR = 3600


def minutes(n: int | Column) -> Column:
    return F.make_dt_interval(mins=F.lit(n) if isinstance(n, int) else n)


def slice_of(ts: Column | str, width: int = HOUR) -> Column:
    """Slice number; never null, so that a join on it adds no filter that
    would keep Spark from seeing its two sides as the same shuffle."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.floor(F.unix_seconds(ts.cast("timestamp")) / width), F.lit(0).cast("bigint"))


def sliced(df: DataFrame, ts: str = "ts", width: int = HOUR) -> DataFrame:
    return df.withColumn(SLICE, slice_of(ts, width))


def points(events: DataFrame, keys: list[str], ts: str = "ts", width: int = HOUR) -> DataFrame:
    """Events per (key, instant), counted before the shuffle.  An event
    without the key, or without a time, belongs to no timeline."""
    return sliced(on_timeline(events, keys, ts).groupBy(*keys, ts).agg(F.count("*").alias("n")), ts, width)


def on_timeline(events: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    return events.dropna(subset=[*keys, ts])


def stretches(events: DataFrame, keys: list[str], length: Column, ts: str = "ts") -> DataFrame:
    """First event (``ts``) and ``last`` event of each key's stretches of
    ``length`` minutes, a column of one value per key that is kept; without
    a positive length each instant is one.  Events of a stretch lie less than
    its length apart."""
    at, span = F.unix_micros(F.col(ts).cast("timestamp")), F.greatest(length, F.lit(0)).cast("bigint") * 60_000_000
    begins = at - F.pmod(at, F.greatest(span, F.lit(1)))
    return events.withColumn("_begins", begins).groupBy(*keys, length, "_begins").agg(
        F.min(ts).alias("ts"), F.max(ts).alias("last")).drop("_begins")


def _neighbour(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, ahead: bool) -> DataFrame:
    """Value of the previous (or next) row of the same key."""
    by = [*keys, SLICE]
    inner = W.partitionBy(*by).orderBy(*order)
    step, pick = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    border = df.groupBy(*by).agg(pick(F.struct(value.alias("v")), F.struct(*order)).alias("_b"))
    carry = border.withColumn("_carry", step("_b").over(W.partitionBy(*keys).orderBy(SLICE))).drop("_b")
    marked = df.withColumn("_in", step(F.struct(value.alias("v"))).over(inner))
    return marked.join(carry, by).withColumn(out, F.coalesce("_in", "_carry")["v"]).drop("_in", "_carry")


def previous(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    return _neighbour(df, keys, order, value, out, ahead=False)


def following(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    return _neighbour(df, keys, order, value, out, ahead=True)


def _running(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, agg, merge) -> DataFrame:
    by = [*keys, SLICE]
    upto = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carry = df.groupBy(*by).agg(agg(value).alias("_s")).withColumn("_carry", agg("_s").over(before)).drop("_s")
    return (df.withColumn("_in", agg(value).over(upto)).join(carry, by)
            .withColumn(out, merge(F.col("_in"), F.col("_carry"))).drop("_in", "_carry"))


def running_max(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Largest non-null value up to and including the row."""
    return _running(df, keys, order, value, out, F.max, F.greatest)


def running_min(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Smallest non-null value up to and including the row."""
    return _running(df, keys, order, value, out, F.min, F.least)


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    def add(a: Column, b: Column) -> Column:
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return _running(df, keys, order, value, out, F.sum, add)


def over_interval(call: str, keys: list[str], ts: str, start: str, end: str) -> Column:
    """Window expression with interval bounds, which only SQL text can name."""
    by = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"{call} OVER (PARTITION BY {by} ORDER BY `{ts}` RANGE BETWEEN {start} AND {end})")


def rolling_counts(df: DataFrame, keys: list[str], windows: dict[str, int], width: int = HOUR) -> DataFrame:
    """Per name in ``windows``, the sum of ``n`` over that many minutes up to
    the row, both bounds included.  Rows are unique per (keys, ts)."""
    short = {name: m for name, m in windows.items() if m * 60 <= width}
    if short:
        df = _rolling_by_copies(df, keys, short, width)
    for name, window_minutes in windows.items():
        if name not in short:
            df = _rolling_by_sums(df, keys, window_minutes, name, width)
    return df


def rolling_by_column(df: DataFrame, keys: list[str], windows: dict[str, str], width: int = HOUR) -> DataFrame:
    """As ``rolling_counts``, but ``windows`` names a column of minutes for
    each count, so rows may differ in their windows: one sweep over rows and
    probes, whatever the number of lengths.  No window counts all rows of the
    key up to the row."""
    rows = df.select(*keys, F.col("ts").alias("_row"), F.col("ts").alias("_t"), "n", F.lit("").alias("_kind"))
    reach = F.array(*[F.struct(F.lit(name).alias("kind"), F.col(m).alias("m")) for name, m in windows.items()])
    probes = df.select(*keys, F.col("ts").alias("_row"), F.explode(reach).alias("_p")).where("_p.m IS NOT NULL").select(
        *keys, "_row", (F.col("_row") - minutes(F.col("_p.m"))).alias("_t"), F.lit(0).cast("bigint").alias("n"), "_p.kind")
    both = sliced(rows.union(probes), "_t", width).withColumn("_late", F.col("_kind") == "")
    summed = running_sum(both, keys, ["_t", "_late"], F.col("n"), "_sum")

    def read_at(kind: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col("_sum")))
    counts = summed.groupBy(*keys, F.col("_row").alias("ts")).agg(
        *[(read_at("") - F.coalesce(read_at(name), F.lit(0))).alias(name) for name in windows])
    return df.join(counts, [*keys, "ts"])


def _rolling_by_copies(df: DataFrame, keys: list[str], windows: dict[str, int], width: int) -> DataFrame:
    """Short windows reach at most into the next slice: a row is copied there,
    feeds the frames, and its copy is dropped again."""
    last = slice_of(F.col("ts") + minutes(max(windows.values())), width)
    copies = (df.withColumn("_own", slice_of("ts", width))
              .withColumn("_at", F.explode(F.sequence("_own", last))))
    frames = {name: over_interval("sum(n)", [*keys, "_at"], "ts", f"INTERVAL {m} MINUTES PRECEDING", "CURRENT ROW")
              for name, m in windows.items()}
    return copies.withColumns(frames).where(F.col("_at") == F.col("_own")).drop("_at", "_own")


def _rolling_by_sums(df: DataFrame, keys: list[str], window_minutes: int, out: str, width: int) -> DataFrame:
    """Long windows: the count up to the row less the count before the window
    began.  The latter is read off by probe rows placed at that instant, so
    slices stay as short as they are."""
    rows = df.select(*keys, F.col("ts").alias("_row"), F.col("ts").alias("_t"), "n", F.lit(1).alias("_kind"))
    probes = rows.select(*keys, "_row", (F.col("_t") - minutes(window_minutes)).alias("_t"),
                         F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("_kind"))
    both = sliced(rows.unionByName(probes), "_t", width)
    summed = running_sum(both, keys, ["_t", "_kind"], F.col("n"), "_sum")
    signed = F.when(F.col("_kind") == 1, F.col("_sum")).otherwise(-F.col("_sum"))
    counts = summed.groupBy(*keys, F.col("_row").alias("ts")).agg(F.sum(signed).alias(out))
    return df.join(counts, [*keys, "ts"])


def with_carry(df: DataFrame, keys: list[str], border: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """Join what other slices say onto each row.

    ``border`` are aggregates per (key, slice); ``carry`` are expressions
    over those, windowed per key in slice order.  ``df`` is read twice with
    the same columns, so Spark runs and shuffles it once and reuses it.
    """
    by = [*keys, SLICE]
    slices = df.groupBy(*by).agg(*[c.alias(n) for n, c in border.items()])
    for name, column in carry.items():
        slices = slices.withColumn(name, column)
    return df.join(slices.select(*by, *carry), by)


def local(keys: list[str], *order: str):
    return W.partitionBy(*keys, SLICE).orderBy(*order)


def slices_of(keys: list[str]):
    return W.partitionBy(*keys).orderBy(SLICE)


def earlier_slices(keys: list[str]):
    return slices_of(keys).rowsBetween(W.unboundedPreceding, -1)


def later_slices(keys: list[str]):
    return slices_of(keys).rowsBetween(1, W.unboundedFollowing)


def with_episodes(pts: DataFrame, keys: list[str], silence_minutes: int | Column | None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Add to points ``(keys, ts, n)``: ``episode``, the first instant of the
    stretch without a silence above the limit (no limit: one per key), and
    ``so_far``, the events of the episode up to the row.  A limit given as a
    column has one value per key."""
    here = local(keys, "ts")
    upto = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    silence = silence_minutes if isinstance(silence_minutes, Column) else F.lit(silence_minutes).cast("int")

    def opens(at: Column, before: Column, limit: Column) -> Column:
        return before.isNull() | F.coalesce(at > before + minutes(limit), F.lit(False))

    rows = pts.withColumns({"_silence": silence, "_before": F.lag("ts").over(here), "_sum": F.sum("n").over(upto)})
    limit = F.col("_silence")
    # Starts that are certain without looking outside the slice.
    inner = F.when(F.col("_before").isNotNull() & opens(F.col("ts"), F.col("_before"), limit), F.col("ts"))
    inner_base = F.when(inner.isNotNull(), F.col("_sum") - F.col("n"))
    first_opens = opens(F.col("_first"), F.col("_last_before"), F.col("_limit"))
    past = earlier_slices(keys)
    rows = with_carry(
        rows, keys,
        border={"_first": F.min("ts"), "_last": F.max("ts"), "_n": F.sum("n"), "_limit": F.max(limit),
                "_start": F.max(inner), "_base": F.max(inner_base)},
        carry={
            "_last_before": F.lag("_last").over(slices_of(keys)),
            "_total": F.coalesce(F.sum("_n").over(past), F.lit(0)),
            "_slice_start": F.coalesce("_start", F.when(first_opens, F.col("_first"))),
            "_slice_base": F.col("_total") + F.coalesce("_base", F.when(first_opens, F.lit(0))),
            "_episode_before": F.max("_slice_start").over(past),
            "_base_before": F.max("_slice_base").over(past),
        })
    start = opens(F.col("ts"), F.coalesce("_before", "_last_before"), limit)
    count = F.col("_total") + F.col("_sum")
    began = F.max(F.when(start, F.col("ts"))).over(upto)
    base = F.max(F.when(start, count - F.col("n"))).over(upto)
    return rows.select(
        *keys, "ts", "n", *keep, SLICE, F.coalesce(began, "_episode_before").alias("episode"),
        (count - F.coalesce(base, "_base_before")).alias("so_far"))
