"""MinHash near-dedup with fast similarity sketches, banding and exact verification.

Documents are sets of five-word shingles. A sketch has ``coordinates`` bins:
in each round every shingle is thrown into one bin by that round's hash and a
bin keeps the smallest value of the first round that reaches it; from round
``coordinates`` on, every shingle goes to one given bin, so all bins are filled
after twice as many rounds at most. Equal coordinates have the probability of
the Jaccard similarity, and their number keeps Chernoff bounds.

Bands of the sketch give candidates, full sets confirm them:

1. Documents of equal sets are one node, named by the smallest id.
2. Nodes that share a band meet its smallest node; confirmed links join them.
3. Bands that still hold several components compare the rest in blocks, by
   size and sketch first; what passes is confirmed against the other component's
   members in chunks, until no pair of different components is left open.

Results: an empty or null text has no shingles, links with nothing and is
kept. A row without id stands alone and is kept; its component is null. Rows
that repeat an id share that id's node. Extra columns stay aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .flat import BASE, SPACE, U64, Texts, blocks, mix, ragged, windows
from .work import discard, staged

WIDTH = 5
PERCENT = 75
COORDINATES = 128
BAND_ROWS = 4
#: Members of a band that are compared by sketch in one task, members of a
#: component and their visitors that are compared by full sets in one task.
BLOCK = 512
CHUNK = 256
#: Similarity by sketch below which a pair is not looked at: five deviations
#: of 128 coordinates under the threshold.
SKETCH_FLOOR = 0.55

SIGNATURE = ("doc_id long, n_shingles long, key_a long, key_b long, sketch array<int>, bands array<long>")


def shingles(texts: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and the text number of each, sorted by text, then hash."""
    texts = texts.lower()
    starts, ends, docs = texts.spans(SPACE)
    words = texts.hashes(starts, ends)
    hashes, first = windows(words, docs, width)
    owner = docs[first]
    for doc in np.flatnonzero((counts := np.bincount(docs, minlength=texts.n)) * (counts < width)):
        at = np.searchsorted(docs, doc)
        with np.errstate(over="ignore"):
            total = U64(counts[doc])
            for word in words[at:at + counts[doc]]:
                total = total * BASE + word
        hashes, owner = np.append(hashes, mix(np.array([total], U64))), np.append(owner, doc)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def sketches(hashes: np.ndarray, owner: np.ndarray, n: int, coordinates: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches, one row per set; rows of empty sets hold the largest value."""
    none = U64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full((n, coordinates), none, U64)
    live = np.zeros(n, bool)
    live[owner] = True
    for turn in range(2 * coordinates):
        if not live.any():
            break
        mine = live[owner]
        if not mine.all():
            hashes, owner = hashes[mine], owner[mine]
        with np.errstate(over="ignore"):
            value = mix(hashes + U64(turn + 1) * BASE)
        if turn < coordinates:
            bins = (value >> U64(40)).astype(np.int64) % coordinates
        else:
            bins = np.full(len(hashes), turn - coordinates)
        # Rounds are drawn apart, so a coordinate of another round never equals this one.
        thrown = np.full(n * coordinates, none, U64)
        np.minimum.at(thrown, owner * coordinates + bins, mix(value))
        empty = sketch == none
        sketch[empty] = thrown.reshape(n, coordinates)[empty]
        live &= (sketch == none).any(axis=1)
    return sketch


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    bands = sketch.shape[1] // rows
    with np.errstate(over="ignore"):
        total = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0xA24BAED4963EE407), (len(sketch), bands)).copy()
        for j in range(rows):
            total = mix(total * BASE + sketch[:, j:bands * rows:rows])
    return total


def signatures(documents: DataFrame) -> DataFrame:
    """Set size, 128-bit set key, sketch and band keys of every document's whole text."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in blocks(batch.column(1)):
                hashes, owner = shingles(texts)
                sketch = sketches(hashes, owner, texts.n)
                keys = band_keys(sketch)
                n = np.bincount(owner, minlength=texts.n)
                with np.errstate(over="ignore"):
                    sums = np.zeros((3, len(hashes) + 1), U64)
                    for k in (1, 2):
                        np.cumsum(mix(hashes ^ U64(0x5851F42D4C957F2D * k & 0xFFFFFFFFFFFFFFFF)), out=sums[k, 1:])
                    at = np.concatenate(([0], np.cumsum(n)))
                    key = sums[:, at[1:]] - sums[:, at[:-1]]
                full = np.where(n > 0, 1, 0)
                yield pa.record_batch([
                    batch.column(0).slice(first, end - first), pa.array(n, pa.int64()),
                    pa.array(key[1].view(np.int64)), pa.array(key[2].view(np.int64)),
                    ragged(sketch[n > 0].astype(np.uint32).view(np.int32).ravel(), full * sketch.shape[1]),
                    ragged(keys[n > 0].view(np.int64).ravel(), full * keys.shape[1])],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "sketch", "bands"])
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, SIGNATURE)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, left in blocks(batch.column(2), 1 << 20):
                for low, high, right in blocks(batch.column(3).slice(first, end - first), 1 << 20):
                    keep = similar(left, low, right, percent)
                    rows = batch.slice(first + low, high - low)
                    yield pa.record_batch([rows.column(0), rows.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(confirm, "a long, b long")


def similar(left: Texts, skip: int, right: Texts, percent: int) -> np.ndarray:
    """For text skip + i on the left and text i on the right: whether their sets are similar enough."""
    own = Texts(left.data[left.offsets[skip]:left.offsets[skip + right.n]],
                left.offsets[skip:skip + right.n + 1] - left.offsets[skip])
    (x, of_x), (y, of_y) = shingles(own), shingles(right)
    with np.errstate(over="ignore"):
        # The pair's number goes into the hash: one sort finds what both sides hold.
        x, y = mix(x + of_x.astype(U64) * BASE), mix(y + of_y.astype(U64) * BASE)
    common = np.bincount(of_x[np.isin(x, y)], minlength=right.n)
    size = np.bincount(of_x, minlength=right.n) + np.bincount(of_y, minlength=right.n)
    return (common > 0) & (100 * common >= percent * (size - common))


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` integer columns of a sorted partition; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        values = np.stack([table.column(i).to_numpy() for i in range(keys)])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for first, end in zip(np.concatenate(([0], cuts[:-1])), cuts):
            yield table.slice(first, end - first)
        held = table.slice(cuts[-1]).to_batches() if len(cuts) else held
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy())


def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of (band, one, two): nodes and the chunks of other components that size and sketch allow a link to."""
    for run in groups_of(batches, 3):
        one, two = run.column(1)[0].as_py(), run.column(2)[0].as_py()
        ids, component, block, size, chunk = (run.column(i).to_numpy() for i in range(3, 8))
        if (component == component[0]).all():
            continue
        sketch, found = matrix(run.column(8)), []
        _, which, often = np.unique(component, return_inverse=True, return_counts=True)
        often = often[which]
        right = np.flatnonzero(block == two)
        for i in np.flatnonzero(block == one):
            j = right[(component[right] != component[i]) & ((ids[right] > ids[i]) | (one != two))]
            j = j[100 * np.minimum(size[j], size[i]) >= PERCENT * np.maximum(size[j], size[i])]
            j = j[(sketch[j] == sketch[i]).mean(axis=1) >= SKETCH_FLOOR]
            # The node of the rarer component goes to the other's chunk.
            to = often[j] >= often[i]
            found.append(np.stack([np.where(to, ids[i], ids[j]), np.where(to, chunk[j], chunk[i])]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        if pairs.shape[1]:
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], names=["id", "chunk"])


def confirm_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of (chunk, part): one confirmed link of every visiting node to the chunk's members, if there is any."""
    for run in groups_of(batches, 2):
        ids, visits = run.column(2).to_numpy(), run.column(3).to_numpy(zero_copy_only=False).astype(bool)
        hashes, owner = [], []
        for first, end, texts in blocks(run.column(4).combine_chunks(), 1 << 20):
            x, of = shingles(texts)
            hashes.append(x), owner.append(of + first)
        hashes, owner = np.concatenate(hashes), np.concatenate(owner)
        size = np.bincount(owner, minlength=len(ids))
        at = np.concatenate(([0], np.cumsum(size)))
        _, number = np.unique(hashes, return_inverse=True)
        mine = ~visits[owner]
        members, of = number[mine], owner[mine]
        held, links = np.zeros(len(hashes), bool), []
        for i in np.flatnonzero(visits):
            held[number[at[i]:at[i + 1]]] = True
            common = np.bincount(of, held[members], len(ids)).astype(np.int64)
            held[number[at[i]:at[i + 1]]] = False
            linked = np.flatnonzero((common > 0) & (100 * common >= PERCENT * (size[i] + size - common)) & (ids != ids[i]))
            if len(linked):
                links.append((ids[i], ids[linked[0]]))
        if links:
            a, b = zip(*links)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def rest_links(open_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components of the bands in ``open_rows``
    (band, n, id, component, size, n_shingles, sketch).

    Bands are compared in pairs of blocks by size and sketch. What is left,
    nodes and the chunk of one other component they may touch, is confirmed on
    full sets: a chunk's members and some of its visitors meet in one task, and
    one link joins a visitor to the component, so the links are as few as nodes.
    """
    spread = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / CHUNK))
    rows = open_rows.withColumn("chunk", F.xxhash64("component", spread))
    dealt = (rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
             .select("band", "one", "two", "id", "component", "block", "n_shingles", "chunk", "sketch")
             .repartition("band", "one", "two").sortWithinPartitions("band", "one", "two"))
    visits = staged(dealt.mapInArrow(compare_blocks, "id long, chunk long").distinct(), "minhash-visits")
    parts = visits.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    visiting = visits.join(parts, "chunk").select(
        "chunk", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", F.lit(True).alias("visits"))
    members = (rows.select("id", "chunk").distinct().join(parts, "chunk")
               .select("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "id",
                       F.lit(False).alias("visits")))
    meeting = (visiting.union(members).join(texts, "id").select("chunk", "part", "id", "visits", "text")
               .repartition("chunk", "part").sortWithinPartitions("chunk", "part"))
    return staged(meeting.mapInArrow(confirm_chunks, "a long, b long"), "minhash-links")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents (doc_id, text)."""
    signed = staged(signatures(documents), "minhash-signatures")
    key = ["key_a", "key_b", "n_shingles"]
    nodes = (signed.where("n_shingles > 0 and doc_id is not null")
             .groupBy(*key).agg(F.min("doc_id").alias("node")))
    nodes = staged(nodes, "minhash-nodes")
    distinct = (signed.where("n_shingles > 0").join(nodes, key).where("doc_id = node")
                .select(F.col("node").alias("id"), "n_shingles", "sketch", "bands"))
    banded = distinct.select("id", F.explode("bands").alias("band"))
    shared = (banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).where("n > 1"))
    members = staged(banded.join(shared, "band"), "minhash-members")
    texts = staged(documents.select(F.col("doc_id").cast("long").alias("id"), "text")
                   .join(members.select("id").distinct(), "id", "left_semi"), "minhash-texts")

    tried = staged(members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(),
                   "minhash-pairs")
    links = staged(confirmed(tried, texts), "minhash-links")
    groups = components(links)
    sizes = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("size"))
    named = (members.join(groups.join(sizes, "component_id"), "id", "left")
             .select("band", "n", "id", F.coalesce("component_id", "id").alias("component"),
                     F.coalesce("size", F.lit(1)).alias("size")))
    open_bands = (named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                  .where("low <> high").select("band"))
    more = rest_links(named.join(open_bands, "band").join(distinct.select("id", "n_shingles", "sketch"), "id"), texts)
    if not more.isEmpty():
        groups = components(links.union(more))
    discard(members, texts)
    classes = (nodes.join(groups.withColumnRenamed("id", "node"), "node", "left")
               .select(*key, F.coalesce("component_id", "node").alias("component_id")))
    wide = signed.select("doc_id", *key)
    return (wide.where("n_shingles > 0 and doc_id is not null").join(classes, key)
            .select("doc_id", "n_shingles", "component_id")
            .union(wide.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", "doc_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))
