"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Each cell's token
weight starts at its share of all tokens and is raked: one marginal after the
other is scaled to its target, until all agree. The raked weights, times the
token budget, are then raked once more as what the sample is expected to hold:
no cell can give more than it has, so full cells stay fixed and the others make
up for them, and a marginal's value whose whole supply is below its target gives
all. A document's probability is what its cell gives over what it has. A hash of
the id decides, so that reruns and lost executors change nothing.

Only DataFrame functions run on the executors. What is raked is the table of
cells, made by partial aggregation. Up to ``LOCAL_CELLS`` cells are raked on the
driver, more of them as a table, by the same rounds. The raked cells are a table
again, and the planner joins it to the documents by broadcast or by a shuffle
with split hot cells, as its size says.

Raking goes on until all marginals agree with their targets. Where cells are
missing, targets can contradict each other; then it goes on until no cell grows
any more, which is the limit of the rounds. What a marginal is off by at the end
is returned by ``rake`` and ``capped``, and ``mixed`` warns of it.

Results: null source or language is a value of its own, ``(none)``. Null or
empty text has no tokens; its cell's probability still applies, and documents
of cells without any token are never sampled. A null id is replaced by the
text's hash. Repeated rows are decided alike, each for itself. Input columns
named as the added ones are not passed on.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import discard, staged

NONE = "(none)"
ADDED = ("topic", "tokens", "weight", "probability", "sampled")
MAX_ROUNDS = 20_000
TOLERANCE = 1e-5
#: Growth of a cell in one round below which the cells are at the limit of the rounds.
SETTLED = 1e-9
#: Error of the sample's expected marginals that is not worth a warning.
SAMPLE_TOLERANCE = 1e-3
#: Cells that the driver rakes, about 100 bytes each.
LOCAL_CELLS = 200_000
BUDGET = 0.5
STEPS = 64


@dataclass(frozen=True)
class Target:
    """Target shares of one marginal.

    ``shares`` are given shares; the values that it does not name divide what
    is left as the given power of their tokens. Shares are scaled to 1 over the
    values that are present.
    """

    power: float = 1.0
    shares: dict[str, float] = field(default_factory=dict)


#: Large sources, languages and topics are damped. Where a cell has fewer tokens than its target asks for, its
#: probability stops at 1 and the others of its source, language and topic give more.
TARGETS = {
    "source": Target(0.5),
    "lang": Target(0.7, {"en": 0.4, "de": 0.19, "fr": 0.19, "es": 0.19}),
    "topic": Target(0.85),
}


def topic_of(text: Column) -> Column:
    """Coarse topic by the marks that a text holds."""
    return (F.when(text.contains("License") | text.contains("LICENSE"), "licence").when(text.contains(" | "), "table")
            .when(text.contains("@"), "contact").otherwise("prose"))


def token_count(text: Column, bytes_per_token: int = 4) -> Column:
    return F.coalesce(F.ceil(F.octet_length(text) / bytes_per_token), F.lit(0)).cast("long")


def marginal_targets(cells: DataFrame, by: str, target: Target) -> DataFrame:
    """Rows (by, target) whose targets add up to 1."""
    given = F.lit(None).cast("double")
    for value, share in target.shares.items():
        given = F.when(F.col(by) == value, F.lit(float(share))).otherwise(given)
    marginal = cells.groupBy(by).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0").withColumn("given", given)
    rest = F.when(F.col("given").isNull(), F.pow("t", F.lit(target.power)))
    named, others = marginal.agg(F.sum("given"), F.sum(rest)).first()
    left = max(0.0, 1 - (named or 0.0)) if others else 0.0
    total = (named or 0.0) + left or 1.0
    raw = F.coalesce("given", F.pow("t", F.lit(target.power)) * (left / (others or 1.0)))
    return marginal.select(by, (raw / total).alias("target"))


@dataclass(frozen=True)
class Outcome:
    """How raking ended: rounds, each marginal's largest relative error, and whether the targets contradict each other."""

    rounds: int
    errors: dict[str, float]
    contradictory: bool

    @property
    def error(self) -> float:
        return max(self.errors.values(), default=0.0)


@dataclass
class Rounds:
    """When rounds of raking end.

    A table that meets all targets weighs the logarithms of a round's factors to the sum of the marginals' divergences
    from their targets, which therefore cannot exceed the largest growth of a cell: if it does, there is no such table.
    """

    most: int
    tolerance: float
    done: int = 0
    contradictory: bool = False

    def end(self, off: float, growth: float, divergence: float) -> bool:
        """``off``: largest error of a factor; ``growth``: largest logarithm of a cell's factor."""
        self.done += 1
        self.contradictory |= off > self.tolerance and divergence > max(growth, 0.0) + SETTLED
        return off <= self.tolerance or growth <= SETTLED or self.done >= self.most


def rake_local(cells: DataFrame, wanted: dict[str, DataFrame], total: int, rounds: Rounds) -> tuple[DataFrame, dict[str, float]]:
    table = cells.select(*wanted, F.col("tokens").cast("long")).toArrow()
    values, codes, targets = {}, {}, {}
    for by, target in wanted.items():
        values[by], codes[by] = np.unique(np.array(table.column(by).to_pylist(), object), return_inverse=True)
        found = {r[0]: r[1] for r in target.collect()}
        targets[by] = np.array([found.get(v, 0.0) for v in values[by]])
    # In the order of their values, so that sums do not depend on the order in which cells arrive.
    order = np.lexsort(list(codes.values()))
    codes = {by: code[order] for by, code in codes.items()}
    share = table.column("tokens").to_numpy()[order] / float(total)
    weight = share
    while rounds.most > 0:
        off, divergence, grown = 0.0, 0.0, np.zeros(len(weight))
        for by, code in codes.items():
            now = np.bincount(code, weight, len(targets[by]))
            factor = np.divide(targets[by], now, out=np.zeros(len(now)), where=now > 0)
            off = max(off, float(np.abs(factor[now > 0] - 1).max(initial=0.0)))
            log = np.log(factor, out=np.zeros(len(now)), where=factor > 0)
            divergence += float(targets[by] @ log)
            grown += log[code]
            weight = weight * factor[code]
        if rounds.end(off, float(grown[weight > 0].max(initial=-math.inf)), divergence):
            break
    errors = {}
    for by, code in codes.items():
        target = targets[by]
        now = np.bincount(code, weight, len(target))
        errors[by] = float(np.abs(now[target > 0] / target[target > 0] - 1).max(initial=0.0))
    made = pa.table({**{by: pa.array(values[by][code].tolist(), pa.string()) for by, code in codes.items()},
                     "tokens": table.column("tokens").to_numpy()[order], "share": share, "weight": weight})
    return staged(cells.sparkSession.createDataFrame(made), "mix-cells"), errors


def rake_table(cells: DataFrame, wanted: dict[str, DataFrame], total: int, rounds: Rounds) -> tuple[DataFrame, dict[str, float]]:
    share = F.col("tokens") / F.lit(float(total)) if total else F.lit(0.0)
    weighted = staged(cells.withColumn("share", share).withColumn("weight", F.col("share")), "mix-cells")
    while rounds.most > 0:
        step = weighted.withColumns({"off": F.lit(0.0), "grown": F.lit(0.0), "divergence": F.lit(0.0)})
        for by, target in wanted.items():
            now = step.groupBy(by).agg(F.sum("weight").alias("now")).join(target, by, "left")
            factor = now.select(by, F.when(F.col("now") > 0, F.coalesce("target", F.lit(0.0)) / F.col("now"))
                                .otherwise(0.0).alias("factor"))
            log = F.when(F.col("factor") > 0, F.log("factor")).otherwise(0.0)
            step = step.join(factor, by).withColumns({
                "off": F.greatest("off", F.when(F.col("weight") > 0, F.abs(F.col("factor") - 1)).otherwise(0.0)),
                "grown": F.col("grown") + log, "divergence": F.col("divergence") + F.col("weight") * F.col("factor") * log,
                "weight": F.col("weight") * F.col("factor")}).drop("factor")
        step = staged(step, "mix-cells")
        off, growth, divergence = step.agg(F.max("off"), F.max(F.when(F.col("weight") > 0, F.col("grown"))),
                                           F.sum("divergence")).first()
        discard(weighted)
        weighted = step.drop("off", "grown", "divergence")
        if off is None or rounds.end(off, -math.inf if growth is None else growth, divergence):
            break
    errors = {}
    for by, target in wanted.items():
        now = weighted.groupBy(by).agg(F.sum("weight").alias("now")).join(target.where("target > 0"), by)
        errors[by] = now.agg(F.max(F.abs(F.col("now") / F.col("target") - 1))).first()[0] or 0.0
    return weighted, errors


def rake(cells: DataFrame, targets: dict[str, Target], max_rounds: int = MAX_ROUNDS,
         tolerance: float = TOLERANCE) -> tuple[DataFrame, Outcome]:
    """Adds ``share`` and ``weight``, shares of all tokens before and after raking, to cells (marginals, tokens)."""
    n, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    wanted = {by: staged(marginal_targets(cells, by, target), "mix-targets") for by, target in targets.items()}
    rounds = Rounds(max_rounds, tolerance)
    made, errors = (rake_local if total and n <= LOCAL_CELLS else rake_table)(cells, wanted, total or 0, rounds)
    return made, Outcome(rounds.done, errors, rounds.contradictory)


def supplied(marginal: DataFrame, by: str, budget: float) -> DataFrame:
    """Rows (by, wanted): what each value is to give, shares of all tokens that add up to the budget.

    A value gives all it has where that is less than its target, and the others
    share the rest in proportion, so that ``wanted = min(supply, c * target)``.
    The c is found among the values' own limits: counted from the shortest
    supply on, what the full ones give and what the others ask for at that c.
    """
    limit = F.when(F.col("target") > 0, F.col("supply") / F.col("target"))
    rows = staged(marginal.where("target > 0").select(by, "supply", "target", limit.alias("limit")), "mix-supply")
    low, high = 0.0, rows.agg(F.max("limit")).first()[0] or 0.0
    for _ in range(3):
        at = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        given = rows.agg(*(F.sum(F.least(F.col("supply"), F.col("target") * c)) for c in at)).first()
        above = [i for i, g in enumerate(given) if g is not None and g >= budget]
        if not above:
            low = high
            break
        low, high = at[max(above[0] - 1, 0)], at[above[0]]
    # Between the two last limits the sum is a straight line, but for values that get full there.
    ends = rows.agg(*(F.sum(F.least(F.col("supply"), F.col("target") * c)) for c in (low, high))).first()
    a, b = (x or 0.0 for x in ends)
    c = low if b <= a else low + (high - low) * min(max((budget - a) / (b - a), 0.0), 1.0)
    return rows.select(by, F.least(F.col("supply"), F.col("target") * c).alias("wanted"))


def capped_local(raked: DataFrame, wanted: dict[str, DataFrame], budget: float, most: int) -> tuple[DataFrame, Outcome]:
    table = raked.toArrow()
    codes, goals = {}, {}
    for by, rows in wanted.items():
        values, codes[by] = np.unique(np.array(table.column(by).to_pylist(), object), return_inverse=True)
        found = {r[0]: r[1] for r in rows.collect()}
        goals[by] = np.array([found.get(v, 0.0) for v in values])
    share, weight = (table.column(c).to_numpy() for c in ("share", "weight"))
    kept, done = np.minimum(share, weight * budget), 0
    for done in range(1, most + 1):
        before = kept
        for by, code in codes.items():
            full = kept >= share
            held, free = (np.bincount(code, np.where(m, kept, 0.0), len(goals[by])) for m in (full, ~full))
            goal = goals[by]
            down = goal < held + free
            grow = np.divide(goal - held, free, out=np.ones(len(goal)), where=free > 0)
            shrink = np.divide(goal, held + free, out=np.zeros(len(goal)), where=held + free > 0)
            factor = np.where(down[code], shrink[code], np.where(full, 1.0, grow[code]))
            kept = np.minimum(share, kept * factor)
        if np.abs(kept - before).max(initial=0.0) <= SETTLED * budget:
            break
    errors = {}
    for by, code in codes.items():
        now, goal = np.bincount(code, kept, len(goals[by])), goals[by]
        errors[by] = float(np.abs(now[goal > 0] / goal[goal > 0] - 1).max(initial=0.0))
    made = pa.table({c: table.column(c) for c in raked.columns} | {"kept": kept})
    return staged(raked.sparkSession.createDataFrame(made), "mix-kept"), Outcome(done, errors, False)


def capped_table(raked: DataFrame, wanted: dict[str, DataFrame], budget: float, most: int) -> tuple[DataFrame, Outcome]:
    now = staged(raked.withColumn("kept", F.least(F.col("share"), F.col("weight") * budget)), "mix-kept")
    full, done = F.col("kept") >= F.col("share"), 0
    for done in range(1, most + 1):
        step = now.withColumn("before", F.col("kept"))
        for by, rows in wanted.items():
            sums = step.groupBy(by).agg(F.sum(F.when(full, F.col("kept")).otherwise(0.0)).alias("held"),
                                        F.sum(F.when(full, 0.0).otherwise(F.col("kept"))).alias("free"))
            sums = sums.join(rows, by, "left").withColumn("goal", F.coalesce("wanted", F.lit(0.0)))
            had = F.col("held") + F.col("free")
            sums = sums.select(by, F.when(F.col("goal") < had, F.when(had > 0, F.col("goal") / had).otherwise(0.0)).alias("down"),
                               F.when(F.col("free") > 0, (F.col("goal") - F.col("held")) / F.col("free")).otherwise(1.0).alias("up"))
            factor = F.coalesce("down", F.when(full, 1.0).otherwise(F.col("up")))
            step = step.join(sums, by).withColumn("kept", F.least(F.col("share"), F.col("kept") * factor)).drop("down", "up")
        step = staged(step, "mix-kept")
        moved = step.agg(F.max(F.abs(F.col("kept") - F.col("before")))).first()[0]
        discard(now)
        now = step.drop("before")
        if moved is None or moved <= SETTLED * budget:
            break
    errors = {}
    for by, rows in wanted.items():
        both = now.groupBy(by).agg(F.sum("kept").alias("now")).join(rows.where("wanted > 0"), by)
        errors[by] = both.agg(F.max(F.abs(F.col("now") / F.col("wanted") - 1))).first()[0] or 0.0
    return now, Outcome(done, errors, False)


def capped(raked: DataFrame, targets: dict[str, Target], budget: float,
           max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, Outcome]:
    """Adds ``kept``, the share of all tokens that a cell is expected to give, to raked cells.

    No cell gives more than it has. Cells that are full stay fixed and the
    others of a marginal's value are scaled to what is left, marginal after
    marginal, until nothing moves. The outcome holds the errors that remain.
    """
    wanted = {by: staged(supplied(marginal_targets(raked, by, target).join(
        raked.groupBy(by).agg(F.sum("share").alias("supply")), by), by, budget), "mix-wanted") for by, target in targets.items()}
    return (capped_local if raked.count() <= LOCAL_CELLS else capped_table)(raked, wanted, budget, max_rounds)


def mixed(documents: DataFrame, targets: dict[str, Target] | None = None, budget: float = BUDGET, seed: int = 42,
          topic: Column | None = None, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Every document with its cell's topic, tokens, raked weight, probability and whether it is sampled.

    Warns with the errors that remain where marginals miss their targets.
    """
    targets = targets or TARGETS
    kept = [c for c in documents.columns if c not in ADDED]
    text = F.col("text")
    own = documents.select(
        *kept, F.coalesce(topic_of(text) if topic is None else topic, F.lit("prose")).alias("topic"),
        token_count(text).alias("tokens"))
    names = {by: f"__{by}" for by in targets}
    keyed = own.withColumns({names[by]: F.coalesce(F.col(by).cast("string"), F.lit(NONE)) for by in targets})
    cells = (keyed.groupBy(*names.values()).agg(F.sum("tokens").alias("tokens"))
             .withColumnsRenamed({v: k for k, v in names.items()}))
    cells = staged(cells, "mix-tokens")
    raked, outcome = rake(cells, targets, max_rounds)
    if outcome.error > TOLERANCE:
        why = "they contradict each other" if outcome.contradictory else "they may be out of reach"
        off = ", ".join(f"{by} by up to {error:.3g}" for by, error in outcome.errors.items())
        warnings.warn(f"marginals miss their targets after {outcome.rounds} rounds ({why}): {off}", stacklevel=2)
    raked, sample = capped(raked, targets, budget, max_rounds)
    if sample.error > SAMPLE_TOLERANCE:
        off = ", ".join(f"{by} by up to {error:.3g}" for by, error in sample.errors.items())
        warnings.warn(f"the sample's expected marginals miss what supply and targets ask for: {off}", stacklevel=2)
    share = F.col("share")
    table = staged(raked.select(
        *(F.col(by).alias(name) for by, name in names.items()), F.col("weight"),
        F.when(share > 0, F.least(F.lit(1.0), F.col("kept") / share)).otherwise(0.0).alias("probability")),
        "mix-probabilities")
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))),
                   F.lit(1 << 53)) / float(1 << 53)
    return (keyed.join(table, list(names.values())).withColumn("sampled", drawn < F.col("probability"))
            .select(*kept, *ADDED))
