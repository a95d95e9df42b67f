"""Merkle manifest of a dataset over SHA-256 midstates.

Rows are leaves, ordered by id inside each language; every ``FAN`` nodes in
order become the SHA-256 of their hex digests until one is left, and the
languages' subroots become the root the same way. A hex digest fills exactly
one SHA-256 block, so the state a parent has before a child's slot is eight
words that can be copied into a table: every parent keeps it, and a changed
child resumes it and only takes in the siblings to its right.

Trees are cut into aligned blocks of ``1 << DEPTH`` nodes, each hashed in one
task; their tops are the nodes of the next tier. A language of any size spreads
over its blocks, and positions come from a range sort and the counts of its
parts, not from a window over a language.

Results: null fields enter a leaf as ``-``; null languages are a group of their
own and come first, as do null ids, which no tampering touches. Rows that
repeat an id are leaves of their own, ordered by their digests. An empty table
has no rows and no root. Extra columns stay aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import staged

FAN = 2
#: Levels hashed in one task.
DEPTH = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- SHA-256 over many messages at once: states are (8, n), blocks (16, n) words ---

def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _cube_root(x: int) -> int:
    r = round(x ** (1 / 3))
    while r ** 3 > x:
        r -= 1
    while (r + 1) ** 3 <= x:
        r += 1
    return r


#: Fractions of the square and cube roots of the first primes, as the standard has them.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)[:, None]
ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States after one more block each."""
    w = list(np.broadcast_to(block, (16, max(block.shape[1], state.shape[1]))))
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        w.append(w[i - 16] + w[i - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                 + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = np.broadcast_to(state, (8, len(w[0])))
    for k, word in zip(ROUND, w):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + word
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def ended(state: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """Digests of messages of so many whole blocks."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0], last[15] = 0x80000000, np.asarray(blocks) * 512
    return absorb(state, last)


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (8, n) as the block that their hex text fills."""
    raw = np.ascontiguousarray(digests.T).astype(">u4").view(np.uint8)
    text = np.stack([HEX[raw >> 4], HEX[raw & 15]], axis=-1).reshape(len(raw), 64)
    return np.ascontiguousarray(text).view(">u4").astype(np.uint32).T


def packed(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(-1, 8).T


def column_of(words: np.ndarray) -> pa.Array:
    """Digests as a binary column of 32 bytes each."""
    return pa.Array.from_buffers(pa.binary(32), words.shape[1], [None, pa.py_buffer(packed(words))]).cast(pa.binary())


def words_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return unpacked(b"".join(column.to_pylist()))


# --- one block of a tree ---

def grown(nodes: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests of each level, the nodes first, and for each level of parents their states before the second slot."""
    digests, states = [nodes], []
    for _ in range(levels):
        left, right = digests[-1][:, 0::2], digests[-1][:, 1::2]
        state = absorb(START, hex_block(left))
        both = right.shape[1]
        made = ended(state, 1) if both < left.shape[1] else np.empty_like(state)
        if both:
            made[:, :both] = ended(absorb(state[:, :both], hex_block(right)), 2)
        digests.append(made), states.append(state)
    return digests, states


def levels_of(size: int, depth: int) -> int:
    """Levels hashed in a block of a tier with ``size`` nodes: all that are left, or as many as a block has."""
    return min(depth, (size - 1).bit_length())


BLOCKS = "key string, block long, size long, digests binary, states binary, top binary"


def build_block(key: tuple, rows: pa.Table, depth: int) -> pa.Table:
    """One row per block: all its digests and states, level after level, and its top."""
    rows = rows.sort_by("pos")
    size = rows.column("size")[0].as_py()
    digests, states = grown(words_of(rows.column("digest")), levels_of(size, depth))
    return pa.table({
        "key": [key[0].as_py()], "block": [key[1].as_py()], "size": [size],
        "digests": [b"".join(map(packed, digests))], "states": [b"".join(map(packed, states))],
        "top": [packed(digests[-1])]}, pa.schema([
            ("key", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("digests", pa.binary()),
            ("states", pa.binary()), ("top", pa.binary())]))


class Block:
    """A stored block: digests and states of each level."""

    def __init__(self, number: int, size: int, digests: bytes, states: bytes, depth: int):
        self.levels = levels_of(size, depth)
        width = min(1 << depth, size - (number << depth))
        widths = [width]
        for _ in range(self.levels):
            widths.append((widths[-1] + 1) // 2)
        self.digests = np.split(unpacked(digests), np.cumsum(widths)[:-1], axis=1)
        self.states = np.split(unpacked(states), np.cumsum(widths[1:])[:-1], axis=1)


class Fold:
    """Ways from nodes to the root: replaced digests and the siblings met, for many nodes at once."""

    def __init__(self, digests: np.ndarray):
        n = digests.shape[1]
        self.digests = digests
        self.proof, self.met = np.repeat(START, n, axis=1), np.zeros(n, np.int64)

    def step(self, second: np.ndarray, state: np.ndarray, sibling: np.ndarray, has: np.ndarray) -> None:
        """One level: whether a node is its parent's second child, the parent's state before that slot, the sibling
        and whether there is one."""
        now = absorb(np.where(second, state, START), hex_block(self.digests))
        other = hex_block(sibling)
        right = has & ~second
        if right.any():
            now[:, right] = absorb(now[:, right], other[:, right])
        self.digests = ended(now, np.where(has, 2, 1))
        if has.any():
            self.proof[:, has] = absorb(self.proof[:, has], other[:, has])
            self.met += has

    def block(self, block: Block, at: np.ndarray) -> None:
        """Climb from positions ``at`` of a block to its top."""
        for level in range(block.levels):
            width = block.digests[level].shape[1]
            second, other = (at & 1).astype(bool), at ^ 1
            has = other < width
            self.step(second, block.states[level][:, at >> 1], block.digests[level][:, np.minimum(other, width - 1)], has)
            at = at >> 1

    def way(self, raw: bytes) -> None:
        """Climb the steps that all nodes share: flags, state and sibling of each."""
        n = self.digests.shape[1]
        for i in range(0, len(raw), 65):
            flag, words = raw[i], unpacked(raw[i + 1:i + 65])
            self.step(np.full(n, flag == 2), words[:, :1], np.repeat(words[:, 1:], n, axis=1), np.full(n, flag > 0))


def ways(block: Block) -> list[bytes]:
    """Steps of every node of a block to its top: 0 for a node alone, 1 for a first, 2 for a second child."""
    made = []
    for at in range(block.digests[0].shape[1]):
        steps = []
        for level in range(block.levels):
            other, width = at ^ 1, block.digests[level].shape[1]
            has = other < width
            steps.append(bytes([0 if not has else 1 + (at & 1)]) + packed(block.states[level][:, at >> 1:(at >> 1) + 1])
                         + (packed(block.digests[level][:, other:other + 1]) if has else bytes(32)))
            at >>= 1
        made.append(b"".join(steps))
    return made


# --- tables ---

def field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(n_chars: Column | None = None) -> Column:
    parts = [F.col(c) if c != "n_chars" or n_chars is None else n_chars for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*map(field, parts)), 256))


def leaves(documents: DataFrame) -> DataFrame:
    """doc_id, key of the language, digest, and the digest of a tampered row where it is one."""
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # null before any language
    return documents.select(*FIELDS).select(
        "doc_id", key.alias("key"), leaf_digest().alias("digest"),
        F.when(tampered, leaf_digest(F.col("n_chars") + 1)).alias("other"))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of each row inside its key by ``order``, and ``size``, the key's rows.

    A range sort over all keys; equal rows are told apart by where they were
    read, so that many of them spread. Each part's rows of a key are counted,
    and the counts before a part give its first position.
    """
    tie = F.monotonically_increasing_id()
    sorted_rows = (rows.withColumn("tie", tie).repartitionByRange("key", *order, "tie")
                   .sortWithinPartitions("key", *order, "tie").drop("tie"))
    sorted_rows = staged(sorted_rows.select("*", F.spark_partition_id().alias("part"),
                                            F.monotonically_increasing_id().alias("row")), "merkle-sorted")
    parts = sorted_rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(parts.select(
        "key", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("key")).alias("size")), "merkle-parts")
    return sorted_rows.join(parts, ["key", "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop(
        "part", "row", "shift")


def tiers(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Blocks of every tier over nodes (key, pos, size, digest), the lowest first."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        return build_block(key, rows, depth)

    made: list[DataFrame] = []
    while True:
        blocks = (nodes.select("key", F.shiftright("pos", depth).alias("block"), "pos", "size", "digest")
                  .groupBy("key", "block").applyInArrow(build, BLOCKS))
        made.append(staged(blocks, "merkle-blocks"))
        wider = made[-1].where(F.col("size") > 1 << depth)
        if wider.isEmpty():
            return made
        nodes = wider.select("key", F.col("block").alias("pos"), F.ceil(F.col("size") / (1 << depth)).alias("size"),
                             F.col("top").alias("digest"))


def tops(blocks: list[DataFrame], depth: int) -> DataFrame:
    """Last digest of each key: of the block that is alone in its tier."""
    return reduce(DataFrame.union, [b.where(F.col("size") <= 1 << depth).select("key", F.col("top").alias("digest"))
                                    for b in blocks])


def with_ways(blocks: list[DataFrame], depth: int, onward: DataFrame | None = None) -> DataFrame:
    """The lowest tier's blocks with the steps from their tops to the root.

    ``onward`` has the steps (key, way) behind each key's last digest.
    """
    last, above = F.col("size") <= 1 << depth, None
    for tier in reversed(blocks):
        found = tier.where(last)
        found = found.join(onward, "key") if onward is not None else found.withColumn("way", F.lit(b""))
        if above is not None:
            found = found.unionByName(tier.where(~last).join(above.withColumnRenamed("pos", "block"), ["key", "block"]))
        if tier is not blocks[0]:
            above = staged(node_ways(found, depth), "merkle-ways")
    return found


def node_ways(blocks: DataFrame, depth: int) -> DataFrame:
    """Steps (key, pos, way) from the nodes of blocks with ways to the root."""
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, number, size, digests, states, way in zip(*(c.to_pylist() for c in batch.columns)):
                steps = ways(Block(number, size, digests, states, depth))
                at = np.arange(len(steps)) + (number << depth)
                yield pa.record_batch([pa.array([key] * len(steps), pa.string()), pa.array(at, pa.int64()),
                                       pa.array([s + way for s in steps], pa.binary())], names=["key", "pos", "way"])

    return blocks.select("key", "block", "size", "digests", "states", "way").mapInArrow(
        climb, "key string, pos long, way binary")


FOLDED = "doc_id long, digest binary, subroot binary, folded binary, proof binary"


def fold_block(rows: pa.Table, blocks: pa.Table, depth: int) -> pa.Table:
    """Roots that the replaced leaves of a block lead to, by its stored states and right siblings, and the digests of
    their proofs."""
    number, size, digests, states, way, subroot = (
        blocks.column(c)[0].as_py() for c in ("block", "size", "digests", "states", "way", "subroot"))
    fold = Fold(words_of(pc.coalesce(rows.column("other"), rows.column("digest"))))
    fold.block(Block(number, size, digests, states, depth), rows.column("pos").to_numpy() - (number << depth))
    fold.way(way)
    return pa.table({"doc_id": rows.column("doc_id"), "digest": rows.column("digest"),
                     "subroot": pa.array([subroot] * len(rows), pa.binary()),
                     "folded": column_of(fold.digests), "proof": column_of(ended(fold.proof, fold.met))})


def manifest(documents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row."""
    def fold(key: tuple, rows: pa.Table, stored: pa.Table) -> pa.Table:
        return fold_block(rows, stored, depth)

    placed = staged(positions(staged(leaves(documents), "merkle-leaves"), ["doc_id", "digest"]), "merkle-placed")
    blocks = tiers(placed, depth)
    subroots = staged(tops(blocks, depth), "merkle-subroots")
    ranked = staged(positions(subroots.select(F.lit("").alias("key"), F.col("key").alias("of"), "digest"), ["of"]),
                    "merkle-ranked")
    upper = tiers(ranked, depth)
    root = tops(upper, depth).first()
    onward = (node_ways(with_ways(upper, depth), depth).join(ranked.select("pos", "of"), "pos")
              .select(F.col("of").alias("key"), "way"))
    low = with_ways(blocks, depth, staged(onward, "merkle-onward")).join(
        subroots.withColumnRenamed("digest", "subroot"), "key").select(
        "key", "block", "size", "digests", "states", "way", "subroot")
    folded = (placed.withColumn("block", F.shiftright("pos", depth)).groupBy("key", "block")
              .cogroup(low.groupBy("key", "block")).applyInArrow(fold, FOLDED))

    def hexed(c: str) -> Column:
        return F.lower(F.hex(c))

    top = F.lit(root.digest.hex() if root else None).cast("string")
    return folded.select(
        "doc_id", hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), top.alias("root"),
        hexed("proof").alias("proof_sha256"), hexed("folded").alias("folded_root"),
        (hexed("folded") == top).alias("verified"))
