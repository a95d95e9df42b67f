"""Exact top-k search by distributed histogram selection.

Queries and candidates are cut into blocks. A task holds a share of the
candidate blocks, the query blocks pass by, and every cell of this grid scores
its queries against its candidates, a few queries at a time. The k-th best
score of each query is located by histograms: a round counts scores per query
and bin over all cells, finds the bin that holds the k-th value and refines
inside it, until a bin is one score wide. A last round keeps what lies above
the k-th value and, of the ties at it, the rows of the smallest ids that are
still needed.

Scores are integers (components are floored after scaling), so bins and ties
are exact. A task counts a query's k best scores among its own candidates: the
global k-th score cannot fall below the least of them, so neither the bin that
holds it nor what lies above is missed. The grid is a Cartesian product of
partitions and what is known of the queries is merged to them: nothing that
grows with the input passes through the driver.

Results: vectors that are null or hold a null or non-finite component take no
part, nor do null ids; vectors of different lengths do not meet. Scores outside
64 bits raise an error. Rows that repeat an id are candidates each; a query excludes all rows of its
own id. Queries of repeated rows are answered each. Fewer candidates than k
give all of them. Extra columns stay aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import discard, staged

K = 20
SCALE = 64
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
#: Queries of a block that are scored at once.
SCORED = 512
#: Bytes of candidate vectors that a task holds, and the tasks per core where there are fewer.
HELD_BYTES, TASKS = 32 << 20, 4
#: Most bits of a score that a round settles.
BIN_BITS = 10
EXACT, EXACT_SINGLE = float(1 << 53), float(1 << 24)
LEAST, MOST = (int(x) for x in (np.iinfo(np.int64).min, np.iinfo(np.int64).max))

BLOCK = "block long, size int, dim int, ids binary, rows binary, vectors binary, reach double"


def kind_of(reach: float) -> type:
    """The type in which whole numbers up to ``reach`` are exact."""
    return np.float32 if reach < EXACT_SINGLE else np.float64


def packed(vectors: DataFrame, rows: int, scale: int) -> DataFrame:
    """Blocks of about ``rows`` scaled vectors of one length (row, id, vector)."""
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        made = []
        for dim, part in group.groupby(group["vector"].map(len)):
            for at in np.array_split(np.arange(len(part)), max(1, round(len(part) / rows))):
                piece = part.iloc[at]
                x = np.floor(scale * np.stack(piece["vector"].to_numpy()).astype(float).reshape(len(piece), dim))
                reach = float(np.sqrt((x * x).sum(axis=1)).max())
                made.append((int(piece["block"].iat[0]), len(piece), int(dim), piece["id"].to_numpy(np.int64).tobytes(),
                             piece["row"].to_numpy(np.int64).tobytes(), x.astype(kind_of(reach)).tobytes(), reach))
        return pd.DataFrame(made, columns=["block", "size", "dim", "ids", "rows", "vectors", "reach"])

    count = max(1, -(-vectors.count() // rows))
    # A row's block is drawn by its number: repeated ids and vectors spread like all others.
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)))
    return dealt.groupBy("block").applyInPandas(pack, BLOCK)


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    odd = F.exists(vector_column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (table.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & ~odd)
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                    F.col(vector_column).cast("array<double>").alias("vector")))


class Block:
    """A block of one side of a cell."""

    def __init__(self, cell: dict, side: str):
        size, dim, self.reach = (cell[f"{side}_{c}"].as_py() for c in ("size", "dim", "reach"))
        self.ids = np.frombuffer(cell[f"{side}_ids"].as_buffer(), np.int64)
        self.vectors = np.frombuffer(cell[f"{side}_vectors"].as_buffer(), kind_of(self.reach)).reshape(size, dim)


class Queries(Block):
    """A block of queries with what is known of them: the bin of the k-th score (``LEAST`` if there is none) and the count above."""

    def __init__(self, cell: dict):
        super().__init__(cell, "q")
        self.number, self.rows = cell["q_block"].as_py(), np.frombuffer(cell["q_rows"].as_buffer(), np.int64)
        self.bins, self.above = np.full(len(self.rows), LEAST), np.zeros(len(self.rows), np.int64)
        self.shift = 0
        if "q_known" in cell and cell["q_known"].is_valid:
            known = cell["q_known"].values
            row, found, above, shift = (known.field(c).to_numpy() for c in ("q_row", "bin", "above", "shift"))
            order = np.argsort(row)
            place = np.minimum(np.searchsorted(row, self.rows, sorter=order), len(row) - 1)
            there = row[order[place]] == self.rows
            self.bins[there], self.above[there] = found[order[place]][there], above[order[place]][there]
            self.shift = int(shift[0])


def over_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Queries, Iterator[Block]]]:
    """Query blocks, each with the candidate blocks that follow one another beside it."""
    cells = ({name: column[i] for name, column in zip(batch.schema.names, batch.columns)}
             for batch in batches for i in range(batch.num_rows))
    for _, run in groupby(cells, lambda cell: cell["q_rows"].as_buffer()):
        first = next(run)
        yield Queries(first), (Block(cell, "c") for cell in [first, *run])


def scores(q: Queries, c: Block) -> Iterator[tuple[slice, np.ndarray]]:
    """Scores of a few queries at a time; a query's own rows lie below all others."""
    most = q.reach * c.reach
    order = np.argsort(c.ids, kind="stable")
    low, high = (np.searchsorted(c.ids, q.ids, side, order) for side in ("left", "right"))
    for at in range(0, len(q.ids), SCORED):
        some = slice(at, at + SCORED)
        if most < EXACT:
            # No partial sum of a product leaves the range in which the type counts exactly.
            kind, none = kind_of(most), -np.inf
            s = q.vectors[some].astype(kind, copy=False) @ c.vectors.astype(kind, copy=False).T
        else:
            left, right = (np.array([[int(x) for x in r] for r in v], object).reshape(v.shape) for v in (q.vectors[some], c.vectors))
            s, none = (left @ right.T).astype(np.int64), LEAST
        for i in np.flatnonzero(high[some] > low[some]):
            s[i, order[low[at + i]:high[at + i]]] = none
        yield some, s


def hits(s: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the scores that reach their row's ``least``, by rows."""
    # A bound outside the range of the type rounds to one that no score is beyond.
    rows, columns = np.divmod(np.flatnonzero(s >= least.astype(s.dtype)[:, None]), max(1, s.shape[1]))
    return rows, columns, s[rows, columns].astype(np.int64)


def absorb(best: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Take values, by rows, into the highest of each row; the first column holds the least."""
    if not len(rows):
        return
    hit, at, n = np.unique(rows, return_index=True, return_counts=True)
    more, k = int(n.max()), best.shape[1]
    wide = np.full((len(hit), more + k), LEAST)
    wide[:, :k] = best[hit]
    wide[np.repeat(np.arange(len(hit)), n), k + np.arange(len(rows)) - np.repeat(at, n)] = values
    best[hit] = np.partition(wide, more, axis=1)[:, more:]


def highest(q: Queries, blocks: Iterator[Block], k: int, refine: bool) -> np.ndarray:
    """The k highest scores of each query, ``LEAST`` where there are fewer; when refining, only from the known bin on."""
    best = np.full((len(q.ids), k), LEAST)
    edge = np.full(len(q.ids), LEAST + 1)
    if refine:
        edge = np.where(q.bins == LEAST, MOST, q.bins << q.shift)
    for c in blocks:
        for some, s in scores(q, c):
            # The first scores of a query set a bound that spares most of the others.
            lead = 16 * k if (best[some, 0] == LEAST).any() else 0
            for part in (s[:, :lead], s[:, lead:]):
                # What equals the least of k scores changes nothing.
                rows, _, values = hits(part, np.maximum(edge[some], best[some, 0] + 1))
                absorb(best[some], rows, values)
    return best


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, scale: int = SCALE, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores, ties to smaller ids."""
    q_blocks = staged(packed(usable(queries, id_column, vector_column), QUERY_BLOCK, scale), "topk-queries")
    c_blocks = staged(packed(usable(candidates, id_column, vector_column), CANDIDATE_BLOCK, scale), "topk-candidates")
    (q_reach, q_count, _), (c_reach, c_count, c_bytes) = (
        [x or 0 for x in b.agg(F.max("reach"), F.count("*"), F.sum(F.octet_length("vectors"))).first()]
        for b in (q_blocks, c_blocks))
    most = float(np.fmin(float(q_reach) * c_reach, 2.0 ** 61))
    bits = int(np.ceil(np.log2(most + 2))) + 1
    tasks = TASKS * queries.sparkSession.sparkContext.defaultParallelism
    c_parts = max(1, -(-c_bytes // HELD_BYTES), min(c_count, tasks))
    q_parts = max(1, min(q_count, -(-tasks // c_parts)))
    c_side = c_blocks.select(*(F.col(c).alias(f"c_{c}") for c in c_blocks.columns if c not in ("block", "rows")))
    c_side = c_side.repartition(c_parts)

    def cells(q_side: DataFrame) -> DataFrame:
        """Each query block beside each candidate block of its length: partitions of both sides meet, no block is sent twice."""
        q_side = q_side.select(*(F.col(c).alias(f"q_{c}") for c in q_side.columns)).coalesce(q_parts)
        return q_side.join(c_side.hint("shuffle_replicate_nl"), F.col("q_dim") == F.col("c_dim"))

    rounds = -(-bits // BIN_BITS)
    step = -(-bits // rounds)
    known, q_side = None, q_blocks
    for shift in range(step * (rounds - 1), -1, -step):
        bins = histogram(cells(q_side), shift, known is not None, k)
        per = bins.groupBy("q_block", "q_row", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q_block", "q_row").orderBy(F.desc("bin"))
        counted = per.withColumn("through", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        if known is not None:
            counted = (counted.join(known.select("q_block", "q_row", "above").hint("merge"), ["q_block", "q_row"])
                       .withColumn("through", F.col("through") + F.col("above")))
        else:
            counted = counted.withColumn("above", F.lit(0).cast("long"))
        # The highest bin that the k-th value can be in; with fewer than k candidates, none: all are wanted.
        found = (counted.groupBy("q_block", "q_row")
                 .agg(F.max(F.when(F.col("through") >= k, F.struct("bin", (F.col("through") - F.col("n")).alias("above"))))
                      .alias("hit")))
        known_next = staged(found.select(
            "q_block", "q_row", F.coalesce("hit.bin", F.lit(LEAST)).alias("bin"),
            F.coalesce("hit.above", F.lit(0)).cast("long").alias("above"), F.lit(shift).alias("shift")), "topk-bins")
        q_next = staged(with_known(q_blocks, known_next), "topk-known")
        if known is not None:
            discard(known, q_side)
        known, q_side = known_next, q_next

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, blocks in over_cells(batches):
            need = np.where(q.bins == LEAST, 0, k - q.above)
            found = [np.zeros(0, np.int64)] * 3
            for c in blocks:
                parts = [found]
                for some, s in scores(q, c):
                    rows, columns, values = hits(s, np.maximum(q.bins[some], LEAST + 1))
                    parts.append([rows + some.start, c.ids[columns], values])
                found = fewest(*(np.concatenate(x) for x in zip(*parts)), q.bins, need)
            rows, ids, values = found
            yield pa.record_batch([pa.array(q.rows[rows]), pa.array(q.ids[rows]), pa.array(ids), pa.array(values)],
                                  names=["q_row", "query_id", "vec_id", "score"])

    chosen = cells(q_side).mapInArrow(select, "q_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    return (chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def fewest(rows: np.ndarray, ids: np.ndarray, values: np.ndarray, kth: np.ndarray, need: np.ndarray) -> list[np.ndarray]:
    """All above the k-th value of their row, and of the ties at it the smallest ids that are needed."""
    tied = values == kth[rows]
    order = np.lexsort((ids, rows, tied))
    rows, ids, values, tied = rows[order], ids[order], values[order], tied[order]
    first = len(rows) - np.count_nonzero(tied)
    place = np.arange(len(rows)) - first - np.searchsorted(rows[first:], rows)
    kept = ~tied | (place < need[rows])
    return [rows[kept], ids[kept], values[kept]]


def with_known(q_blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Query blocks with what is known of their queries; a block's list is as long as the block."""
    lists = known.groupBy(F.col("q_block").alias("block")).agg(F.collect_list(F.struct("q_row", "bin", "above", "shift")).alias("known"))
    # A block whose queries all have fewer than k candidates is no longer listed.
    return q_blocks.join(lists.hint("merge"), "block", "left")


def histogram(cells: DataFrame, shift: int, refine: bool, k: int) -> DataFrame:
    """Counts (q_block, q_row, bin, n) of scores >> shift; when refining, only inside the known bin."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, blocks in over_cells(batches):
            best = np.sort(highest(q, blocks, k, refine), axis=1)
            wanted = best > LEAST
            if refine:
                wanted &= (best >> q.shift) == q.bins[:, None]
            rows, columns = np.nonzero(wanted)
            found = best[rows, columns] >> shift
            first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (found[1:] != found[:-1]))[:len(rows)])
            n = np.diff(np.append(first, len(rows)))
            yield pa.record_batch([pa.array(np.full(len(n), q.number)), pa.array(q.rows[rows[first]]),
                                   pa.array(found[first]), pa.array(n)], names=["q_block", "q_row", "bin", "n"])

    return cells.mapInArrow(count, "q_block long, q_row long, bin long, n long")
