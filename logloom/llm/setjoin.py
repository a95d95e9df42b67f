"""Jaccard self-join of word n-gram sets, size-aware: subsets for small sets, inverted lists for large ones.

Two sets of s and t grams reach the similarity when they share at least
``least_common(s, t)`` grams. Equal sets are one node, named by the smallest id.

* Small sets up to a boundary list all their subsets of exactly that size, one
  list for each size a partner may have; sets that meet in a subset are linked
  as they stand, and a meeting's links go to one member of the other size.
* Large sets go through inverted lists. Grams are ordered from rare to common,
  and a set is listed under its first grams only, as many as a similar partner
  cannot miss. Members of a list try its smallest member first; then only
  members of different components are compared, in blocks of like size, and
  those whose positions leave room for enough common grams scan the full
  inverted lists of the other's chunk, which counts exact overlaps.
* The boundary is the size at which the lists' lengths and the numbers of
  subsets, summed over all sets, cost least.

Common grams are told by a table of counts of fixed size over all documents;
it decides the order, never the result. Grams are compared by 64-bit hashes,
equal sets and common subsets by 128 bits.

Results: an empty or null text has no grams and links with nothing. A row
without id stands alone, its component is null. Rows that repeat an id share
that id's node and join what their texts link to. Extra columns stay aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .flat import U64, blocks, mix, ragged
from .minhash import groups_of, shingles
from .work import discard, staged

WIDTH = 4
PERCENT = 85
#: Sets above this size are always large; subsets beyond it are far too many.
SMALL_MAX = 32
#: Cells of the table of gram counts, and parts in which it is summed.
CELLS, SLICES, SHARES = 1 << 18, 16, 32
#: Members of a list that are compared in one task; members and visitors that meet in one task.
BLOCK, CHUNK = 4096, 256
#: Bits of the table of ids that is sent to the texts, 4 MB whatever the input; where many ids share a bit, more texts are dealt.
MARKS = 1 << 25


def least_common(s, t, percent: int = PERCENT):
    """Smallest number of common members of two sets that reach the similarity; for numbers and arrays."""
    return -(-percent * (s + t) // (100 + percent))


def least_common_of(s: Column, t: Column, percent: int) -> Column:
    return F.ceil(percent * (s + t) / (100 + percent))


def partners(s: int, limit: int, percent: int = PERCENT) -> list[int]:
    """Sizes up to ``limit`` of sets, other than equal ones, that may be similar to a set of size s."""
    return [t for t in range(1, limit + 1)
            if least_common(s, t, percent) <= min(s, t) and (t != s or least_common(s, s, percent) < s)]


def first_grams(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many of its rarest grams a set is listed under."""
    return s - -(-percent * s // 100) + 1


# --- one pass over all texts: set sizes, set keys, gram counts ---

DESCRIBED = "doc_id long, n_shingles long, key_a long, key_b long, slice int, cells binary, grams array<long>"


def set_sums(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit sums per set over its grams, mixed apart."""
    at = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
    made = []
    with np.errstate(over="ignore"):
        for value in gram_values(hashes):
            sums = np.concatenate((np.zeros(1, U64), np.cumsum(value, dtype=U64)))
            made.append(sums[at[1:]] - sums[at[:-1]])
    return np.stack(made)


def gram_values(hashes: np.ndarray) -> np.ndarray:
    return np.stack([mix(hashes ^ U64(0x5851F42D4C957F2D)), mix(hashes ^ U64(0x14057B7EF767814F))])


def described(documents: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id, set size and key, and the grams of a small set; and the gram counts of each task, in slices."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CELLS, np.int64)
        for batch in batches:
            for first, end, texts in blocks(batch.column(1)):
                hashes, owner = shingles(texts, width)
                seen += np.bincount((hashes % U64(CELLS)).astype(np.int64), minlength=CELLS)
                key, none = set_sums(hashes, owner, texts.n).view(np.int64), pa.nulls(texts.n)
                size = np.bincount(owner, minlength=texts.n)
                small = size <= SMALL_MAX
                yield pa.record_batch([
                    batch.column(0).slice(first, end - first), pa.array(size),
                    pa.array(key[0]), pa.array(key[1]), none.cast(pa.int32()), none.cast(pa.binary()),
                    ragged(hashes[small[owner]].view(np.int64), np.where(small, size, 0))], names=FIELDS)
        if seen.any():
            yield slices(seen.reshape(SLICES, -1), range(SLICES))

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(describe, DESCRIBED)


FIELDS = ["doc_id", "n_shingles", "key_a", "key_b", "slice", "cells", "grams"]


def slices(rows: np.ndarray, numbers) -> pa.RecordBatch:
    none = pa.nulls(len(rows), pa.int64())
    return pa.record_batch(
        [none] * 4 + [pa.array(list(numbers), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary()),
                      pa.nulls(len(rows), pa.list_(pa.int64()))], names=FIELDS)


def grades(rows: DataFrame) -> np.ndarray:
    """Counts of all tasks summed, cell by cell, as one byte each on a logarithmic scale."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, raw in zip(batch.column(4).to_pylist(), batch.column(5)):
                counts = np.frombuffer(raw.as_buffer(), np.int64)
                total[number] = total[number] + counts if number in total else counts
        if total:
            yield slices(np.stack(list(total.values())), total)

    parts = rows.where("slice is not null").withColumn("share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
    parts = parts.repartition("slice", "share").drop("share").mapInArrow(add, DESCRIBED)
    summed = parts.repartition("slice").mapInArrow(add, DESCRIBED).collect()
    total = np.zeros((SLICES, CELLS // SLICES), np.int64)
    for r in summed:
        total[r.slice] += np.frombuffer(r.cells, np.int64)
    return np.minimum(np.log1p(total.ravel()) / log(1.1), 255).astype(np.uint8)


# --- small sets: subsets of a fixed size ---

@lru_cache(maxsize=None)
def left_out(s: int, drop: int) -> np.ndarray:
    """All ways to leave out ``drop`` of s members, one row each."""
    return np.array(list(combinations(range(s), drop)), np.int64).reshape(comb(s, drop), drop)


SUBSETS = "key_a long, key_b long, low int, high int, id long, size int"


def subset_keys(values: np.ndarray, s: int, keep: int) -> np.ndarray:
    """Keys of all subsets of ``keep`` members: the sums over all members less those left out."""
    with np.errstate(over="ignore"):
        return values.sum(axis=1, dtype=U64)[:, None] - values[:, left_out(s, s - keep)].sum(axis=2, dtype=U64)


def small_links(sets: DataFrame, limit: int, percent: int) -> DataFrame:
    """Links (a, b) of the sets (id, grams) of up to ``limit`` grams with each other."""
    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, grams in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = grams.values.to_numpy().view(U64)
                s, values = len(hashes), gram_values(hashes)
                for t in partners(s, limit, percent):
                    keys = subset_keys(values, s, least_common(s, t, percent)).view(np.int64)
                    n = keys.shape[1]
                    yield pa.record_batch(
                        [pa.array(keys[0]), pa.array(keys[1])]
                        + [pa.array(np.full(n, x, np.int32)) for x in (min(s, t), max(s, t))]
                        + [pa.array(np.full(n, number)), pa.array(np.full(n, s, np.int32))],
                        names=["key_a", "key_b", "low", "high", "id", "size"])

    meeting = ["key_a", "key_b", "low", "high"]
    rows = sets.where(F.size("grams") <= limit).select("id", "grams").mapInArrow(enumerate_subsets, SUBSETS)
    ends = rows.groupBy(*meeting).agg(F.min(F.when(F.col("size") == F.col("low"), F.col("id"))).alias("of_low"),
                                      F.min(F.when(F.col("size") == F.col("high"), F.col("id"))).alias("of_high"),
                                      F.count(F.lit(1)).alias("n")).where("n > 1 and of_low is not null and of_high is not null")
    to = F.when(F.col("size") == F.col("low"), F.col("of_high")).otherwise(F.col("of_low"))
    return rows.join(ends, meeting).select(F.col("id").alias("a"), to.alias("b")).where("a <> b").distinct()


# --- large sets: inverted lists ---

INDEXED = "token long, key_a long, at long"


def indexed(documents: DataFrame, grade: np.ndarray, width: int, percent: int) -> DataFrame:
    """Rows of the inverted lists (token, key_a, size and position of the gram)."""
    scale = grade.tobytes()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.frombuffer(scale, np.uint8)
        for batch in batches:
            for _, _, texts in blocks(batch.column(0)):
                hashes, owner = shingles(texts, width)
                if not len(hashes):
                    continue
                key = set_sums(hashes, owner, texts.n)[0].view(np.int64)
                size = np.bincount(owner, minlength=texts.n)
                by = np.lexsort((hashes, order[(hashes % U64(CELLS)).astype(np.int64)], owner))
                begin = np.concatenate(([0], np.cumsum(size)))
                place = np.arange(len(hashes)) - begin[owner]
                short = np.flatnonzero(place < first_grams(size, percent)[owner])
                of = owner[short]
                yield pa.record_batch([
                    pa.array(hashes[by[short]].view(np.int64)), pa.array(key[of]), pa.array((size[of] << 32) + place[short])],
                    names=["token", "key_a", "at"])

    return documents.select("text").mapInArrow(index, INDEXED)


def boundary(nodes: DataFrame, members: DataFrame, percent: int) -> int:
    """Size up to which sets list their subsets: where subsets and list entries together are fewest.

    Both sums are over all sets; sizes are at most SMALL_MAX rows."""
    sets = dict(nodes.where(F.col("n_shingles") <= SMALL_MAX).groupBy("n_shingles").count().collect())
    scans = dict(members.where(F.col("size") <= SMALL_MAX).groupBy("size").agg(F.sum("n")).collect())

    def cost(limit: int) -> int:
        subsets = sum(n * sum(comb(s, least_common(s, t, percent)) for t in partners(s, limit, percent) if t in sets)
                      for s, n in sets.items() if s <= limit)
        return subsets + sum(n for s, n in scans.items() if s > limit)

    return min(range(SMALL_MAX + 1), key=cost)


def room(s: Column, p: Column, t: Column, q: Column, limit: int, percent: int) -> Column:
    """Whether two sets of sizes s and t whose first common gram has positions p and q may be similar, and one is large."""
    return (F.least(s - p, t - q) >= least_common_of(s, t, percent)) & (F.greatest(s, t) > limit)


def common_listed(s: Column, t: Column, percent: int) -> Column:
    """How many grams two similar sets of sizes s and t have in common among those they are listed under, at least.

    The m-th common gram, in order, stands behind at most m - 1 common ones and the s - c that are not common.
    """
    least = least_common_of(s, t, percent)

    def spare(n: Column) -> Column:
        return n - F.ceil(percent * n / 100) + 1 - (n - least)

    return F.greatest(F.least(spare(s), spare(t)), F.lit(1))


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole runs of rows that agree in the first ``keys`` integer columns of a sorted partition."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        values = np.stack([table.column(i).to_numpy() for i in range(keys)])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        if len(cuts):
            yield table.slice(0, cuts[-1])
        held = table.slice(cuts[-1] if len(cuts) else 0).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


#: Runs up to this length are compared side by side with the others of their batch.
SHORT_RUN = 64


def compare_blocks(limit: int, percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For runs of (token, group, one, two): pairs of nodes of different components that may be similar, the one to
        visit first, with their sizes and the other's chunk."""
        for table in whole_runs(batches, 4):
            token, group, one, two, ids, block, kind, size, place, component, often, chunk = (
                c.to_numpy() for c in table.columns)
            new = np.ones(len(ids), bool)
            new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            start = np.flatnonzero(new)
            length = np.diff(np.append(start, len(ids)))
            run, found = np.cumsum(new) - 1, []

            def keep(i, j):
                """Pairs of rows of one run that may be similar."""
                ok = (component[i] != component[j]) & ((kind[i] == group[i]) | (kind[j] == group[j]))
                i, j = i[ok], j[ok]
                ok = ((block[i] == one[i]) & (block[j] == two[i])) | ((block[j] == one[i]) & (block[i] == two[i]))
                ok &= np.minimum(size[j] - place[j], size[i] - place[i]) >= least_common(size[i], size[j], percent)
                ok &= np.maximum(size[i], size[j]) > limit
                i, j = i[ok], j[ok]
                # The node of the smaller component goes to the other's chunk.
                to = often[j] >= often[i]
                found.append((np.where(to, i, j), np.where(to, j, i)))

            short = np.flatnonzero(length[run] <= SHORT_RUN)
            for d in range(1, int(length[length <= SHORT_RUN].max(initial=1))):
                i, j = short[:-d], short[d:]
                near = run[i] == run[j]
                keep(i[near], j[near])
            for low, n in zip(start[length > SHORT_RUN], length[length > SHORT_RUN]):
                for i in range(low, low + n - 1):
                    keep(np.full(low + n - 1 - i, i), np.arange(i + 1, low + n))
            i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
            if len(i):
                pairs = np.unique(np.stack([ids[i], ids[j], size[i], size[j], chunk[j]]), axis=1)
                yield pa.record_batch([pa.array(x) for x in pairs], names=["id", "other", "size", "other_size", "chunk"])

    return compare


def scan_chunks(width: int, percent: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each run of (chunk, part): visitors scan the inverted lists of the chunk's members; one link each at most."""
        for run in groups_of(batches, 2):
            ids, visits = run.column(2).to_numpy(), run.column(3).to_numpy().astype(bool)
            hashes, owner = [], []
            for first, _, texts in blocks(run.column(4).combine_chunks()):
                x, of = shingles(texts, width)
                hashes.append(x), owner.append(of + first)
            hashes, owner = np.concatenate(hashes), np.concatenate(owner)
            size = np.bincount(owner, minlength=len(ids))
            at = np.concatenate(([0], np.cumsum(size)))
            listed = np.flatnonzero(~visits[owner])
            listed = listed[np.argsort(hashes[listed], kind="stable")]
            tokens, of, links = hashes[listed], owner[listed], []
            for i in np.flatnonzero(visits):
                mine = hashes[at[i]:at[i + 1]]
                low, high = np.searchsorted(tokens, mine), np.searchsorted(tokens, mine, side="right")
                length = high - low
                entries = np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())
                common = np.bincount(of[entries], minlength=len(ids))
                linked = np.flatnonzero((common > 0) & (common >= least_common(size, size[i], percent)) & (ids != ids[i]))
                if len(linked):
                    links.append((ids[i], ids[linked[0]]))
            if links:
                a, b = zip(*links)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return scan


def met(visits: DataFrame, members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between visitors (chunk, id) and the members (chunk, id) of the chunks they visit."""
    parts = visits.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    visiting = visits.join(parts, "chunk").select(
        "chunk", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", F.lit(1).alias("visits"))
    hosts = (members.join(parts, "chunk")
             .select("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "id",
                     F.lit(0).alias("visits")))
    meeting = (visiting.union(hosts).join(texts, "id").select("chunk", "part", "id", "visits", "text")
               .repartition("chunk", "part").sortWithinPartitions("chunk", "part"))
    return staged(meeting.mapInArrow(scan_chunks(width, percent), "a long, b long"), "setjoin-links")


def marked(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of documents (id, ...) with an id of ids (id), and a few others whose ids share a bit with one; none is shuffled."""
    cell = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    bits = ids.groupBy(F.bitmap_bucket_number(cell).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits"))
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return documents.join(F.broadcast(bits), (F.bitmap_bucket_number(cell) == F.col("bucket"))
                          & (F.getbit(byte, at.bitwiseAND(7).cast("int")) == 1), "left_semi")


def rest_of(members: DataFrame, groups: DataFrame, limit: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Visits between components that still share a list, and the members of the chunks."""
    sizes = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("often"))
    named = (members.join(groups.join(sizes, "component_id"), "id", "left")
             .withColumn("component", F.coalesce("component_id", "id")).withColumn("often", F.coalesce("often", F.lit(1))))
    several = (named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .where("low <> high").select("token"))
    spread = F.pmod(F.xxhash64("id"), F.ceil(F.col("often") / CHUNK))
    # Similar sizes lie in one class or in neighbours; a class is a little wider than the similarity asks for.
    kind = F.floor(F.log("size") / (1.001 * log(100 / percent)))
    rows = staged(named.join(several, "token").select(
        "token", "id", kind.alias("kind"), "size", "place", "component", "often",
        F.xxhash64("component", spread).alias("chunk")), "setjoin-open")
    grouped = rows.withColumn("group", F.explode(F.array("kind", F.col("kind") + 1)))
    counted = (grouped.groupBy("token", "group").agg(F.count(F.lit(1)).alias("n"), F.max("kind").alias("top"))
               .where("n > 1 and top = group").select("token", "group", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    dealt = (grouped.join(counted, ["token", "group"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
             .select("token", "group", "one", "two", "id", "block", "kind", "size", "place", "component", "often", "chunk")
             .repartition("token", "group", "one", "two").sortWithinPartitions("token", "group", "one", "two"))
    pairs = dealt.mapInArrow(compare_blocks(limit, percent),
                             "id long, other long, size long, other_size long, chunk long").distinct()
    # A pair that is similar has many of its listed grams in common, not just one.
    tokens = members.groupBy("id", "size").agg(F.collect_set("token").alias("tokens"))
    both = pairs.join(tokens, ["id", "size"]).join(
        tokens.select(F.col("id").alias("other"), F.col("size").alias("other_size"), F.col("tokens").alias("theirs")),
        ["other", "other_size"])
    visits = both.where(F.size(F.array_intersect("tokens", "theirs"))
                        >= common_listed(F.col("size"), F.col("other_size"), percent)).select("id", "chunk").distinct()
    visits = staged(visits, "setjoin-visits")
    return visits, rows.select("chunk", "id").distinct().join(visits.select("chunk").distinct(), "chunk", "left_semi")


def linked_sets(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH, limit: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of documents (doc_id, text). ``limit`` fixes the boundary."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = staged(described(documents, width), "setjoin-described")
    rows, key = table.where("slice is null").select("doc_id", "n_shingles", "key_a", "key_b", "grams"), ["key_a", "key_b", "n_shingles"]
    full = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = staged(full.groupBy(*key).agg(F.min("doc_id").alias("id")), "setjoin-nodes")
    # Ids with several rows; each of their texts joins the id to the node of its set.
    again = staged(full.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "setjoin-again")
    own = full.drop("grams").join(again, "doc_id", "left_semi").join(nodes, key).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))

    index = indexed(documents.where("doc_id is not null"), grades(table), width, percent)
    listed = index
    lists = listed.groupBy("token").agg(F.min("key_a").alias("least"), F.max("key_a").alias("most")).where("least <> most")
    size, place = F.shiftright("at", 32), F.col("at").bitwiseAND(0xFFFFFFFF)
    members = listed.join(lists.select("token"), "token").distinct().select(
        "token", "key_a", size.alias("n_shingles"), place.alias("place"))
    members = members.join(nodes, ["key_a", "n_shingles"]).select("token", "id", F.col("n_shingles").alias("size"), "place")
    members = staged(members, "setjoin-members")
    heads = staged(members.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "size", "place")).alias("head")).where("n > 1"), "setjoin-heads")
    members = members.join(heads, "token")
    if limit is None:
        limit = boundary(nodes, members, percent)
    small = full.where(F.col("n_shingles") <= limit).select(*key, "grams").distinct().join(nodes, key).select("id", "grams")
    links = own.union(small_links(small, limit, percent))

    # The first tries skip pairs that have few lists in common; those left out meet again below.
    head = F.col("head")
    tried = members.where((F.col("id") != head.id) & room(
        F.col("size"), F.col("place"), head.size, head.place, limit, percent)).groupBy(
            head.id.alias("chunk"), "id").agg(
                F.count(F.lit(1)).alias("n"), F.min(common_listed(F.col("size"), head.size, percent)).alias("least"))
    tried = staged(tried.where(F.col("n") * 8 >= F.col("least")).select("chunk", "id"), "setjoin-tried")
    hosts = tried.select("chunk", F.col("chunk").alias("id")).distinct()
    repeated = again.withColumnRenamed("doc_id", "id")

    def texts_of(ids: DataFrame) -> DataFrame:
        """One row per id and text."""
        ids = staged(ids.distinct(), "setjoin-ids")
        found = marked(documents.withColumnRenamed("doc_id", "id"), ids).join(ids, "id", "left_semi")
        return staged(found.join(repeated, "id", "left_anti").union(found.join(repeated, "id", "left_semi").distinct()),
                      "setjoin-texts")

    texts = texts_of(tried.select("id").union(hosts.select("id")))
    links = staged(links.union(met(tried, hosts, texts, width, percent)), "setjoin-all")
    groups = components(links)
    visits, hosts = rest_of(members.select("token", "id", "size", "place"), groups, limit, percent)
    discard(texts)
    texts = texts_of(visits.select("id").union(hosts.select("id")))
    more = met(visits, hosts, texts, width, percent)
    if not more.isEmpty():
        groups = components(links.union(more))
    discard(texts)
    classes = nodes.join(groups, "id", "left").select(*key, F.coalesce("component_id", "id").alias("component_id"))
    return (full.join(classes, key).select("doc_id", "n_shingles", "component_id")
            .union(rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", "doc_id")))
