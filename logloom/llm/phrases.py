"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

Rows are dealt into shards. Each step scans one shard and counts, side by side,
phrases of all lengths that are active: words from the first step on, a longer
phrase from the step after both of its parts (all words but the last, all but
the first) have reached the threshold. The scans go round the shards until
every phrase has been counted over one full cycle, wherever it began.

When a phrase starts is read from a table: a cell per hash of a part, holding
the step from which the parts of that cell are taken as frequent. Cells are set
once, so a phrase's start never changes; parts that share a cell with a frequent
one only start phrases too early, which counts more but never miscounts. A table
has several cells for each part that is frequent when it is made, up to a limit.

A phrase is the row of its words' 64-bit hashes, which hold the language. A task
adds its phrases up and sends them as arrays, one row for each of a fixed number
of ranges of keys; a range's arrays are joined, sorted and added up there. So no
phrase is a row or a text of its own until it is frequent. Words go with their text: where two
that differ share a hash, all is counted anew with other hashes.

Results: a null text has no words, a null language is ``und``. Rows may repeat
and may lack an id; repeated rows count as often as they occur. Extra columns stay
aside. An empty table gives no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .flat import U64, Texts, blocks, mix
from .work import discard, staged

LONGEST = 3
LEAST = 10
TOP = 2000
COVER_PERCENT = 50
SHARDS = 2
#: Cells of a table of starts, of one byte each: at least, at most, and for each frequent part.
CELLS, MOST_CELLS, CELLS_EACH = 1 << 22, 1 << 27, 8
#: Bytes of text that are cut into words together.
BLOCK = 1 << 20
#: Phrases that a task holds before it adds them up and sends them.
HELD = 1 << 20
#: Ranges of keys for each shuffle partition.
RANGES = 4

BLANK = np.zeros(256, bool)
BLANK[[9, 32]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
NOT_WORD = BLANK | BREAK
#: Start of parts that are not frequent so far.
NEVER = 255

STEP = U64(0xD1342543DE82EF95)

#: Phrases of a range of keys: ``words`` has a row of hashes per place, ``texts`` the spelling of single words,
#: ``reached`` how many have the threshold, ``clash`` whether words that differ share a hash.
COUNTED = "k int, start int, bucket int, size int, reached int, clash boolean, words binary, n binary, texts binary"


class Words:
    """Words of a block, laid end to end with one space after each."""

    def __init__(self, texts: Texts):
        texts = texts.lower()
        starts, ends, self.docs = texts.spans(NOT_WORD)
        breaks = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(BREAK[texts.data], out=breaks[1:])
        # A piece ends with its text or at a break.
        self.pieces = breaks[starts] + self.docs
        self.at = np.concatenate(([0], np.cumsum(ends - starts + 1)))
        data = np.append(texts.data, np.uint8(32))
        flat = np.repeat(starts - self.at[:-1], ends - starts + 1) + np.arange(self.at[-1])
        laid = data[flat]
        laid[self.at[1:] - 1] = 32
        self.laid = Texts(laid, np.array([0, len(laid)]))
        self.n = len(starts)

    def phrases(self, k: int) -> np.ndarray:
        """First words of the runs of k words inside one piece."""
        if self.n < k:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.pieces[:self.n - k + 1] == self.pieces[k - 1:])

    def hashes(self, seed: int) -> np.ndarray:
        """Hashes of the words; another seed gives others."""
        laid = Texts(self.laid.data ^ np.uint8(seed), self.laid.offsets) if seed else self.laid
        return laid.hashes(self.at[:-1], self.at[1:] - 1)

    def texts_of(self, first: np.ndarray, k: int) -> pa.Array:
        low, size = self.at[first], self.at[first + k] - 1 - self.at[first]
        offsets = np.concatenate(([0], np.cumsum(size)))
        flat = np.repeat(low - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(
            len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.laid.data[flat])).cast(pa.string())


def lang_salt(langs: list[str]) -> np.ndarray:
    """A number per language, apart from the hashes of words spelled alike."""
    raw = [x.encode() for x in langs]
    at = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
    return mix(~Texts(np.frombuffer(b"".join(raw), np.uint8), at).hashes(at[:-1], at[1:]))


def longer(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of phrases that go on with one more word."""
    with np.errstate(over="ignore"):
        return mix(keys * STEP + words)


def cells(keys: np.ndarray, n: int) -> np.ndarray:
    return (keys % U64(n)).astype(np.int64)


def grouped(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of phrases (a row of hashes per place) by key that brings equal ones together, and where each begins in it."""
    def edges(order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, bool]:
        """Where phrases change, and whether some do within a key."""
        rows, keys = np.take(words, order, axis=1), keys[order]
        edge = reduce(np.logical_or, (row[1:] != row[:-1] for row in rows))
        return edge, bool((edge & (keys[1:] == keys[:-1])).any())

    size = words.shape[1]
    keys = reduce(longer, words)
    # Numbers sort faster than places: the lowest bits of the keys give way to these.
    bits = U64(size.bit_length())
    places = (U64(1) << bits) - U64(1)
    order = (np.sort(keys & ~places | np.arange(size, dtype=U64)) & places).astype(np.int64)
    edge, mixed = edges(order, keys >> bits)
    if mixed:
        order = np.argsort(keys)
        edge, mixed = edges(order, keys)
    if mixed:
        order = np.lexsort([*words, keys])
        edge, _ = edges(order, keys)
    return order, np.flatnonzero(np.append(np.ones(min(1, size), bool), edge))


class Tally:
    """Phrases of one length, their counts and, of single words, a table of their spelling."""

    def __init__(self, words: np.ndarray, n: np.ndarray, texts: pa.Table | None = None, clash: bool = False):
        self.words, self.n, self.texts, self.clash = words, n, texts, clash

    @staticmethod
    def of(row: dict) -> Tally:
        words = np.frombuffer(row["words"], U64).reshape(row["k"], row["size"])
        texts = row["texts"] and pa.ipc.open_stream(row["texts"]).read_all()
        return Tally(words, np.frombuffer(row["n"], np.int64), texts, row["clash"])

    @property
    def keys(self) -> np.ndarray:
        return reduce(longer, self.words)

    @staticmethod
    def summed(parts: list[Tally]) -> Tally:
        """Each phrase once, by key."""
        words, n = np.concatenate([x.words for x in parts], axis=1), np.concatenate([x.n for x in parts])
        texts = pa.concat_tables([x.texts for x in parts]).combine_chunks() if parts[0].texts is not None else None
        order, first = grouped(words)
        clash = any(x.clash for x in parts)
        if texts is not None and len(n):
            group = np.repeat(first, np.diff(np.append(first, len(n))))
            clash |= not all(pc.all(pc.equal(c.take(order), c.take(order[group]))).as_py() for c in texts.columns)
            texts = texts.take(order[first])
        total = np.add.reduceat(n[order], first) if len(n) else n
        return Tally(np.take(words, order[first], axis=1), total, texts, clash)

    def rows(self, k: int, start: int, buckets: np.ndarray, least: int) -> pa.RecordBatch:
        """A row for each bucket, whose phrases lie side by side."""
        low = np.flatnonzero(np.append(np.ones(min(1, len(buckets)), bool), buckets[1:] != buckets[:-1]))
        spans = list(zip(low.tolist(), np.append(low[1:], len(buckets)).tolist()))

        def texts(a: int, b: int) -> bytes | None:
            if self.texts is None:
                return None
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.texts.schema) as out:
                out.write_table(self.texts.slice(a, b - a).combine_chunks())
            return sink.getvalue().to_pybytes()

        def ints(values) -> pa.Array:
            return pa.array([int(x) for x in values], pa.int32())

        return pa.record_batch([
            ints([k] * len(spans)), ints([start] * len(spans)), ints(buckets[low]), ints(b - a for a, b in spans),
            ints(np.count_nonzero(self.n[a:b] >= least) for a, b in spans), pa.array([self.clash] * len(spans), pa.bool_()),
            pa.array([self.words[:, a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([self.n[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([texts(a, b) for a, b in spans], pa.binary())],
            names=["k", "start", "bucket", "size", "reached", "clash", "words", "n", "texts"])


def over_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def counting(step: int, shards: int, longest: int, starts: dict[int, bytes], seed: int, ranges: int, least: int, block: int):
    """Counts of one step's active phrases in a shard's rows (lang, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = {k: np.frombuffer(raw, np.uint8) for k, raw in starts.items()}
        held: dict[tuple[int, int], list[Tally]] = {}
        size = 0
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            langs, code = coded.dictionary, coded.indices.to_numpy()
            salts = lang_salt(langs.to_pylist())
            for low, end, texts in blocks(batch.column(1), block):
                words = Words(texts)
                if not words.n:
                    continue
                for group, found in active(words, code[low:end][words.docs], langs, salts, begin):
                    held.setdefault(group, []).append(found)
                    size += len(found.n)
                if size >= HELD:
                    yield from sent(held)
                    held, size = {}, 0
        yield from sent(held)

    def sent(held: dict[tuple[int, int], list[Tally]]) -> Iterator[pa.RecordBatch]:
        for group in sorted(held):
            total = Tally.summed(held.pop(group))
            # Ranges of the highest bits follow one another as the keys do.
            buckets = ((total.keys >> U64(40)) * U64(ranges) >> U64(24)).astype(np.int64)
            yield total.rows(*group, buckets, least)

    def active(words: Words, lang: np.ndarray, langs: pa.Array, salts: np.ndarray,
               begin: dict) -> Iterator[tuple[tuple[int, int], Tally]]:
        each = parts = mix(words.hashes(seed) ^ salts[lang])
        for k in range(1, longest + 1):
            first = words.phrases(k)
            if k == 1 and step < shards:
                order, at = grouped(each[None])
                one, n = order[at], np.diff(np.append(at, len(each)))
                texts = pa.table({"lang": langs.take(pa.array(lang[one])), "word": words.texts_of(one, 1)})
                yield (1, 0), Tally(each[None, one], n, texts)
            if k > 1:
                if k - 1 not in begin or not len(first):
                    break
                found = begin[k - 1][cells(parts, len(begin[k - 1]))]
                start = np.maximum(found[first], found[first + 1])
                for s in np.flatnonzero(np.bincount(start, minlength=NEVER + 1)[:NEVER]):
                    if s <= step < s + shards:
                        at = first[start == s]
                        yield (k, int(s)), Tally(np.stack([each[at + i] for i in range(k)]), np.ones(len(at), np.int64))
                parts = longer(parts[:-1], each[k - 1:])

    return count


def joining(least: int):
    """Adds up rows of one length, start and bucket that follow one another."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, start, bucket), run in groupby(over_rows(batches), lambda row: (row["k"], row["start"], row["bucket"])):
            total = Tally.summed([Tally.of(row) for row in run])
            yield total.rows(k, start, np.full(len(total.n), bucket), least)

    return join


def frequent_cells(counted: DataFrame, least: int, n_cells: int) -> np.ndarray:
    """Cells of the phrases with n >= least: a bitmap of ``n_cells`` bits, joined from those of the tasks."""
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in over_rows(batches):
            found = Tally.of(row)
            yield pa.record_batch([pa.array(np.unique(cells(found.keys[found.n >= least], n_cells)))], names=["cell"])

    # Bitmap positions count from one.
    marks = counted.mapInArrow(locate, "cell long").select((F.col("cell") + 1).alias("cell"))
    maps = marks.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    wide = len(maps[0].bits) * 8 if maps else 1
    found = [np.flatnonzero(np.unpackbits(np.frombuffer(m.bits, np.uint8), bitorder="little")) + (m.bucket - 1) * wide
             for m in maps]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def frequent_rows(counted: DataFrame, least: int) -> DataFrame:
    """(k, w, lang, phrase, f) of the phrases with n >= least; only single words are spelled."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in over_rows(batches):
            found = Tally.of(row)
            kept = np.flatnonzero(found.n >= least)
            k, size = len(found.words), len(kept)
            texts = found.texts.take(kept).combine_chunks() if found.texts is not None else None
            spelled = [texts[c].combine_chunks() if texts is not None else pa.nulls(size, pa.string()) for c in ("lang", "word")]
            yield pa.record_batch([
                pa.array(np.full(size, k, np.int32)),
                pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * k),
                                         pa.array(np.ascontiguousarray(found.words[:, kept].T).view(np.int64).ravel())),
                *spelled, pa.array(found.n[kept])], names=["k", "w", "lang", "phrase", "f"])

    return counted.mapInArrow(rows, "k int, w array<long>, lang string, phrase string, f long")


def words_per_language(counted: DataFrame) -> DataFrame:
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in over_rows(batches):
            found = Tally.of(row)
            table = pa.table({"lang": found.texts["lang"], "n": pa.array(found.n)}).group_by("lang").aggregate([("n", "sum")])
            yield pa.record_batch([table["lang"].combine_chunks(), table["n_sum"].combine_chunks()], names=["lang", "n"])

    return counted.mapInArrow(total, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def spelled(phrases: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Phrases (k, lang, phrase, f) of k words by the words' hashes."""
    phrases = phrases.select("k", "f", *(F.col("w")[i].alias(f"h{i}") for i in range(k)))
    for i in range(k):
        names = words.select(F.col("w")[0].alias(f"h{i}"), *(["lang"] if not i else []), F.col("phrase").alias(f"p{i}"))
        phrases = phrases.join(names, f"h{i}")
    return phrases.select("k", "lang", F.concat_ws(" ", *(f"p{i}" for i in range(k))).alias("phrase"), "f")


def counts(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, shards: int = SHARDS,
           n_cells: int = 0, block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Phrases (k, lang, phrase, f) with f >= least, and words per language (lang, n). Without ``n_cells``, tables of
    starts follow the number of frequent parts."""
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", F.xxhash64("doc_id").alias("h"))
    ranges = RANGES * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables: dict[int, np.ndarray] = {}
    #: Groups (k, start) whose cycles run or have run.
    groups, done, words, before = {(1, 0)}, [], None, None
    step = 0

    def runs(start: int) -> bool:
        return start <= step < start + shards

    while any(start + shards > step for _, start in groups):
        shard = rows.where(F.pmod("h", F.lit(shards)) == step % shards).select("lang", "text")
        found = shard.mapInArrow(counting(step, shards, longest, {k: t.tobytes() for k, t in tables.items()},
                                          seed, ranges, least, block), COUNTED)
        if before is not None:
            # What runs on is added to what it counted before.
            found = found.union(before.where(F.col("start") + shards > step))
        now = staged(found.repartition("bucket").sortWithinPartitions("k", "start", "bucket")
                     .mapInArrow(joining(least), COUNTED), "phrase-step")
        if before is not None:
            discard(before)
        before = now
        sums = now.groupBy("k", "start").agg(F.sum("reached").alias("reached"), F.max("clash").alias("clash")).collect()
        if any(r.clash for r in sums):
            return counts(documents, longest, least, shards, n_cells, block, seed + 1)
        reached = {(r.k, r.start): r.reached for r in sums}
        for k, start in sorted(g for g in groups if runs(g[1])):
            total = now.where((F.col("k") == k) & (F.col("start") == start))
            if step == start + shards - 1:
                done.append((k, staged(frequent_rows(total, least), "phrase-frequent")))
                if k == 1:
                    words = staged(words_per_language(total), "phrase-words")
            if k < longest and reached.get((k, start)):
                if k not in tables:
                    wanted = 1 << (CELLS_EACH * reached[k, start] - 1).bit_length()
                    tables[k] = np.full(n_cells or min(max(wanted, CELLS), MOST_CELLS), NEVER, np.uint8)
                fresh = frequent_cells(total, least, len(tables[k]))
                fresh = fresh[tables[k][fresh] == NEVER]
                if len(fresh):
                    tables[k][fresh] = step + 1
                    groups.add((k + 1, step + 1))
        step += 1
    singles = next(d for k, d in done if k == 1)
    return reduce(DataFrame.union, [singles.select("k", "lang", "phrase", "f"),
                                    *(spelled(d, singles, k) for k, d in done if k > 1)]), words


def wide_product(*factors: Column | int) -> Column:
    """A product of whole numbers of up to 38 digits."""
    parts = [F.lit(x).cast("decimal(7,0)") if isinstance(x, int) else x.cast("decimal(19,0)") for x in factors]
    return reduce(lambda a, b: (a * b).cast("decimal(38,0)"), parts)


def collocations(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 cover_percent: int = COVER_PERCENT, shards: int = SHARDS, n_cells: int = 0,
                 block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language.

    A phrase scores floor(1000000 * a * a / (l * r)) for its weakest cut into a
    first part that occurs l times and a rest that occurs r times. Phrases
    inside a longer one that holds ``cover_percent`` of their occurrences go.
    """
    frequent, words = counts(documents, longest, least, shards, n_cells, block)
    frequent = staged(frequent, "phrase-all")
    phrases = frequent.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = F.col("cut")
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "w", "k").select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), cut), " ").alias("first"),
        F.array_join(F.slice("w", cut + 1, F.col("k") - cut), " ").alias("rest"))
    scored = (cuts.join(frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    value = F.expr("big div small").cast("long")
    scored = (scored.withColumns({"big": wide_product(F.col("a"), F.col("a"), 1_000_000),
                                  "small": wide_product(F.col("l"), F.col("r"))})
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(value.alias("score"), "cut", "l", "r")).alias("best")))
    inner = phrases.where(F.col("k") > 2).select(
        "lang", "a", "w", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    covered = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover_percent))
    left = left.select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    # Best of each part of a language first, so that no language passes through one task whole.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = (left.withColumn("near", F.row_number().over(Window.partitionBy("lang", spread).orderBy(*order)))
            .where(F.col("near") <= top))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(words, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
