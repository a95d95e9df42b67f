"""SentencePiece encoding and decoding with Gumbel top-k sampling.

A text is cut into the pieces of a public model's vocabulary. Each piece has a
log probability by its rank (Zipf's law), a segmentation the sum of its
pieces'. The lattice of all segmentations is summed from the right, which tells
the mass behind every node, and a best-first search takes nodes in the order of
their perturbed mass: a node's Gumbel value is the largest of its leaves', and
the values of its children are drawn on condition of that maximum. The first
``k`` leaves reached are ``k`` distinct segmentations, sampled without
replacement; the value of the next one is the threshold that gives their
inclusion scores, ``P(value > threshold)``.

A frontier node is a prefix of an emitted path with the options that were taken
at its last place barred; only the best ``k`` matter. All texts of a block run
through the lattice together in numpy. Random numbers are hashes of seed, row
key and place, so that the result of a row does not depend on its batch.

Pieces never cross a word: spaces lead a word, as in the vocabulary. A
character without a piece is one lattice step that gives its UTF-8 bytes as
byte pieces, so every text decodes to itself.

Results: a null or empty text has one segmentation without pieces. Texts with
fewer than ``k`` segmentations give all they have, with inclusion 1. Rows are
sampled by their id, repeated rows alike; a null id counts as 0. Extra columns
stay aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import BASE, U64, Texts, blocks, mix, ragged

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
POWER = 1.0
SHIFT = 2.7
UNKNOWN_PENALTY = 10.0
#: Text bytes whose lattice is held at once: about 100 bytes of arrays each.
TEXT_BYTES = 3 << 18
MARK = "▁".encode()
SPACE = 32


def read_model(path: str) -> bytes:
    """The model file, read once on the driver and sent with the tasks (0.5 MB)."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """Byte trie over the pieces, as one dense table of the inner nodes; the space stands for the word mark."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        m, size = self.model, self.model.get_piece_size()
        self.byte_ids = np.full(256, m.unk_id(), np.int32)
        self.bytes_of: list[bytes] = [b""] * size
        normal = []
        for i in range(size):
            if m.is_byte(i):
                value = int(m.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.bytes_of[i] = m.id_to_piece(i).encode().replace(MARK, b" ")
                normal.append(i)
        if (self.byte_ids == m.unk_id()).any():
            raise ValueError("the model has no byte fallback")
        ranked = sorted(normal, key=lambda i: (-m.get_score(i), i))
        weight = -POWER * np.log(np.arange(len(ranked)) + 1 + SHIFT)
        weight -= np.log(np.exp(weight).sum())
        self.logp = np.full(size + 1, weight.min() - UNKNOWN_PENALTY)
        self.logp[ranked] = weight
        self.unknown = size
        shared, children, piece = set(), [{}], [-1]
        for i in normal:
            raw = self.bytes_of[i]
            if b" " in raw.lstrip(b" ") or (raw.startswith(b"  ") and raw.strip(b" ")):
                raise ValueError("a piece crosses words")
            if len(raw.decode()) > 1:
                shared.update(raw)
            node = 0
            for c in raw:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({}), piece.append(-1)
                node = children[node][c]
            piece[node] = i
        inner = [n for n, c in enumerate(children) if c]
        place = {n: k for k, n in enumerate(inner + [n for n, c in enumerate(children) if not c])}
        self.inner = len(inner)
        self.next = np.full((self.inner, 256), -1, np.int32)
        for n in inner:
            for c, to in children[n].items():
                self.next[place[n], c] = place[to]
        self.piece = np.full(len(children), -1, np.int32)
        for n, k in place.items():
            self.piece[k] = piece[n]
        #: ASCII bytes that no longer piece holds: a word can be cut around them.
        self.lonely = np.array([c < 128 and c not in shared for c in range(256)])


_vocabularies: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """One per worker process; tasks of one model share it."""
    key = hashlib.sha256(model).digest()
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(model)
    return _vocabularies[key]


@dataclass
class Lattice:
    """Options at each place of distinct chunks: ``log_q[row, j]``, ``piece``, ``step``; row = first[chunk] + place."""

    first: np.ndarray
    length: np.ndarray
    log_q: np.ndarray
    piece: np.ndarray
    step: np.ndarray
    options: np.ndarray


def chunks(texts: Texts, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs ``spaces + word``, cut around lonely bytes."""
    data, n = texts.data, len(texts.data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    space, lonely = data == SPACE, v.lonely[data]
    cut = np.zeros(n, bool)
    cut[1:] = (space[1:] & ~space[:-1]) | lonely[1:] | lonely[:-1]
    cut[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(texts.offsets, starts, side="right") - 1


def lattice(texts: Texts, starts: np.ndarray, ends: np.ndarray, v: Vocabulary) -> Lattice:
    """Sum the lattice of each chunk from the right; chunks of like length go together."""
    length = ends - starts
    first = np.concatenate(([0], np.cumsum(length)))
    total = int(first[-1])
    parts: list[tuple[np.ndarray, ...]] = []
    size = 4
    left = np.ones(len(length), bool)
    while left.any():
        chosen = np.flatnonzero(left & (length <= size))
        left[chosen] = False
        # A few thousand rows at a time keep the working arrays small.
        per = max(1, (1 << 19) // size)
        for at in range(0, len(chosen), per):
            parts += edges(texts, starts, length, first, chosen[at:at + per], v)
        size *= 2
    width = max((int(p[1].max()) + 1 for p in parts if len(p[1])), default=1)
    wide = [np.full((total, width), fill, kind) for fill, kind in ((-np.inf, np.float64), (-1, np.int32), (0, np.int16))]
    for row, column, *values in parts:
        for target, value in zip(wide, values):
            target[row, column] = value
    options = (wide[2] > 0).sum(axis=1)
    return Lattice(first[:-1], length, *wide, options)


def edges(texts: Texts, starts: np.ndarray, length: np.ndarray, first: np.ndarray, chosen: np.ndarray,
          v: Vocabulary) -> list[tuple[np.ndarray, ...]]:
    """Options (row, column, log_q, piece, step) of the chosen chunks, place by place from the right."""
    found = []
    longest = int(length[chosen].max())
    beta = np.full((len(chosen), longest + 1), -np.inf)
    beta[np.arange(len(chosen)), length[chosen]] = 0.0
    for place in range(longest - 1, -1, -1):
        live = np.flatnonzero(length[chosen] > place)
        at = starts[chosen[live]] + place
        head = texts.data[at]
        begin = (head & 0xC0) != 0x80
        live, at, head = live[begin], at[begin], head[begin]
        if not len(live):
            continue
        bytes_ = 1 + (head >= 0xC0).astype(np.int64) + (head >= 0xE0) + (head >= 0xF0)
        room = length[chosen[live]] - place
        bytes_ = np.minimum(bytes_, room)
        node, who, depth = np.zeros(len(live), np.int64), np.arange(len(live)), 0
        rows, columns, ids, steps = [], [], [], []
        seen = np.zeros(len(live), np.int64)
        single = np.zeros(len(live), bool)
        while len(who):
            node = v.next[node, texts.data[at[who] + depth]]
            ok = node >= 0
            node, who = node[ok], who[ok]
            depth += 1
            piece = v.piece[node]
            hit = piece >= 0
            mine = who[hit]
            rows.append(mine), columns.append(seen[mine]), ids.append(piece[hit])
            steps.append(np.full(len(mine), depth, np.int32))
            seen[mine] += 1
            single[mine[bytes_[mine] == depth]] = True
            more = (node < v.inner) & (room[who] > depth)
            node, who = node[more], who[more]
        lone = np.flatnonzero(~single)
        rows.append(lone), columns.append(seen[lone]), ids.append(np.full(len(lone), v.unknown, np.int32))
        steps.append(bytes_[lone].astype(np.int32))
        row, column, piece, step = map(np.concatenate, (rows, columns, ids, steps))
        value = v.logp[piece] + beta[live[row], place + step]
        top = np.full(len(live), -np.inf)
        np.maximum.at(top, row, value)
        mass = np.bincount(row, np.exp(value - top[row]), minlength=len(live))
        whole = top + np.log(mass)
        beta[live, place] = whole
        found.append((first[chosen[live[row]]] + place, column, value - whole[row], piece, step))
    return found


def uniform(key: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    """Numbers inside (0, 1) from 64-bit keys and counters."""
    with np.errstate(over="ignore"):
        bits = mix(key + (np.asarray(count).astype(U64) + U64(1)) * BASE)
    return ((bits >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)


@dataclass
class Path:
    """Steps of one segmentation per text: flat arrays with ``at[i]:at[i + 1]`` for text i."""

    at: np.ndarray
    chunk: np.ndarray
    row: np.ndarray
    piece: np.ndarray
    log_q: np.ndarray
    barred: np.ndarray
    rest: np.ndarray
    value: np.ndarray


def walk(lat: Lattice, cumulative: np.ndarray, which: np.ndarray, place: np.ndarray, key: np.ndarray,
         stream: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sample every chunk from its place to its end: counts of steps, then rows and columns, chunk by chunk."""
    log, live = [], np.flatnonzero(place < lat.length[which])
    place, taken = place.copy(), np.zeros(len(which), np.int64)
    while len(live):
        row = lat.first[which[live]] + place[live]
        u = uniform(key[live], (stream[live] << 20) + place[live])
        column = (cumulative[row] < u[:, None]).sum(axis=1)
        column = np.minimum(column, lat.options[row] - 1)
        log.append((live, taken[live], row, column))
        place[live] += lat.step[row, column]
        taken[live] += 1
        live = live[place[live] < lat.length[which[live]]]
    at = np.concatenate(([0], np.cumsum(taken)))
    rows, columns = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
    for live, step, row, column in log:
        rows[at[live] + step], columns[at[live] + step] = row, column
    return taken, rows, columns


def truncated(phi: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of location phi on condition that they are below the bound."""
    with np.errstate(divide="ignore", invalid="ignore"):
        value = -np.logaddexp(-bound, np.log(-np.log(u)) - phi)
    return np.where(np.isneginf(phi), -np.inf, value)


def per_text_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Running sums inside each text, before each value."""
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[:-1] - np.repeat(total[at[:-1]], np.diff(at))


def frontier(path: Path, mass_barred: np.ndarray, key: np.ndarray, turn: int) -> None:
    """Draw the perturbed value of what branches off at each step of the path."""
    owner = np.repeat(np.arange(len(path.at) - 1), np.diff(path.at))
    place = np.arange(len(owner)) - path.at[owner]
    prefix = per_text_sums(path.log_q, path.at)
    with np.errstate(divide="ignore"):
        phi = prefix + np.log(np.maximum(1 - mass_barred, 0))
    path.rest = truncated(phi, path.value[owner], uniform(mix(key[owner] ^ U64(turn)), place))


def sampled(texts: Texts, keys: np.ndarray, v: Vocabulary, k: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For sample 1..k: which texts have one, their piece counts, pieces, step bytes, log probability, inclusion."""
    space = np.full(1, SPACE, np.uint8)
    # Every text that is not empty gets the space that leads a word.
    has = np.diff(texts.offsets) > 0
    lead = np.concatenate(([0], np.cumsum(has)))
    data = np.insert(texts.data, texts.offsets[:-1][has], space)
    texts = Texts(data, texts.offsets + lead)
    starts, ends, owner = chunks(texts, v)
    _, one, which = np.unique(texts.hashes(starts, ends), return_index=True, return_inverse=True)
    lat = lattice(texts, starts[one], ends[one], v)
    cumulative = lat.log_q.astype(np.float32)
    np.cumsum(np.exp(cumulative, out=cumulative), axis=1, out=cumulative)
    key = mix(keys.view(U64) ^ mix(np.array([seed], np.int64).view(U64) + U64(1)))
    n, of = texts.n, np.searchsorted(owner, np.arange(texts.n + 1))
    number = np.arange(len(which)) - of[owner]
    bytes_at = starts

    def path_of(counts, chunk, rows, columns, barred, value):
        at = np.concatenate(([0], np.cumsum(counts)))
        return Path(at, chunk, rows, columns, lat.log_q[rows, columns], barred, np.zeros(0), value)

    taken, rows, columns = walk(lat, cumulative, which, np.zeros(len(which), np.int64), key[owner], number)
    chunk = np.repeat(np.arange(len(which)), taken)
    value = -np.log(-np.log(uniform(mix(key), 0)))
    sole = lat.options[rows] == 1
    path = path_of(np.bincount(owner[chunk], minlength=n), chunk, rows, columns, np.uint64(1) << columns.astype(U64), value)
    frontier(path, np.where(sole, 1.0, np.exp(path.log_q)), key, 1)
    paths, alive = [path], [np.ones(n, bool)]
    for turn in range(2, k + 1):
        best, source, split = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for s, p in enumerate(paths):
            top, step = best_step(p)
            better = (top > best) & alive[s]
            best[better], source[better], split[better] = top[better], s, step[better]
        ok = np.isfinite(best)
        if not ok.any():
            break
        some = np.flatnonzero(ok)
        low, cut = (np.zeros(len(some), np.int64) for _ in range(2))
        cut_chunk, cut_row, cut_barred = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), np.zeros(len(some), U64)
        for s, p in enumerate(paths):
            mine = source[some] == s
            low[mine], cut[mine] = p.at[some[mine]], split[some[mine]]
            at = cut[mine]
            cut_chunk[mine], cut_row[mine], cut_barred[mine] = p.chunk[at], p.row[at], p.barred[at]
            p.rest[at] = -np.inf
        # Another option at the place of the split, among those not barred.
        bits, odds = np.arange(lat.log_q.shape[1], dtype=U64), np.exp(lat.log_q[cut_row])
        free = ((cut_barred[:, None] >> bits) & U64(1)) == 0
        mass = np.cumsum(np.where(free, odds, 0), axis=1)
        u = uniform(mix(key[some] ^ U64(turn)), cut - low) * mass[:, -1]
        option = np.argmax((mass >= u[:, None]) & free & (odds > 0), axis=1)
        cut_barred |= U64(1) << option.astype(U64)
        taken_there = ((cut_barred[:, None] >> bits) & U64(1)) == 1
        at_cut = np.where(taken_there.sum(axis=1) == lat.options[cut_row], 1.0,
                          np.where(taken_there, odds, 0).sum(axis=1))
        # The rest of the chunk that was split, and all later chunks, are drawn anew.
        todo = ranges(cut_chunk, of[some + 1] - cut_chunk)
        text = np.repeat(some, of[some + 1] - cut_chunk)
        place = np.zeros(len(todo), np.int64)
        place[np.concatenate(([0], np.cumsum(of[some + 1] - cut_chunk)))[:-1]] = (
            cut_row - lat.first[which[cut_chunk]] + lat.step[cut_row, option])
        taken, new_row, new_column = walk(lat, cumulative, which[todo], place, mix(key[text] ^ U64(turn)), number[todo])
        tail = np.bincount(text, taken, minlength=n).astype(np.int64)[some]
        counts = np.zeros(n, np.int64)
        counts[some] = cut - low + 1 + tail
        start = (np.cumsum(counts) - counts)[some]
        chunk, rows, columns = (np.zeros(counts.sum(), np.int64) for _ in range(3))
        barred, gone = np.zeros(counts.sum(), U64), np.ones(counts.sum())
        for s, p in enumerate(paths):
            mine = source[some] == s
            to, from_ = ranges(start[mine], (cut - low)[mine]), ranges(low[mine], (cut - low)[mine])
            chunk[to], rows[to], columns[to], barred[to] = p.chunk[from_], p.row[from_], p.piece[from_], p.barred[from_]
        to = start + cut - low
        chunk[to], rows[to], columns[to], barred[to], gone[to] = cut_chunk, cut_row, option, cut_barred, at_cut
        to = ranges(to + 1, tail)
        chunk[to], rows[to], columns[to] = np.repeat(todo, taken), new_row, new_column
        barred[to] = U64(1) << new_column.astype(U64)
        gone[to] = np.where(lat.options[new_row] == 1, 1.0, np.exp(lat.log_q[new_row, new_column]))
        path = path_of(counts, chunk, rows, columns, barred, np.where(ok, best, -np.inf))
        frontier(path, gone, key, turn)
        paths.append(path), alive.append(ok)
    threshold = np.max([np.where(a, best_step(p)[0], -np.inf) for p, a in zip(paths, alive)], axis=0)
    for p, a in zip(paths, alive):
        logp = np.bincount(np.repeat(np.arange(n), np.diff(p.at)), p.log_q, minlength=n)
        inclusion = np.where(np.isneginf(threshold), 1.0, -np.expm1(-np.exp(np.minimum(logp - threshold, 700))))
        place = p.row - lat.first[which[p.chunk]]
        yield (a, np.diff(p.at), lat.piece[p.row, p.piece], bytes_at[p.chunk] + place, lat.step[p.row, p.piece],
               texts.data, logp, inclusion)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of the given lengths, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def best_step(p: Path) -> tuple[np.ndarray, np.ndarray]:
    """The best branch of each text's path and where it leaves."""
    n = len(p.at) - 1
    top, step = np.full(n, -np.inf), np.zeros(n, np.int64)
    full = np.flatnonzero(np.diff(p.at))
    if len(full):
        top[full] = np.maximum.reduceat(p.rest, p.at[full])
        owner = np.repeat(np.arange(n), np.diff(p.at))
        hits = np.flatnonzero((p.rest == top[owner]) & np.isfinite(p.rest))
        step[owner[hits[::-1]]] = hits[::-1]
    return top, step


def ids_of(counts: np.ndarray, piece: np.ndarray, at: np.ndarray, step: np.ndarray, data: np.ndarray,
           v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary ids, a character without a piece as its bytes; ids per text and the ids."""
    unknown = piece == v.unknown
    width = np.where(unknown, step, 1)
    ends = np.cumsum(width)
    ids = np.repeat(piece, width)
    if unknown.any():
        spot = np.flatnonzero(np.repeat(unknown, width))
        source = np.repeat(np.arange(len(piece)), width)[spot]
        ids[spot] = v.byte_ids[data[at[source] + spot - (ends - width)[source]]]
    total = np.concatenate(([0], ends))
    cut = np.concatenate(([0], np.cumsum(counts)))
    return np.diff(total[cut]), ids.astype(np.int32)


def decode_ids(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The text of piece ids: pieces and bytes in a row, without the space that leads the first word."""
    return b"".join(map(v.bytes_of.__getitem__, ids.tolist()))[1:]


ENCODED = "doc_id long, sample int, ids array<int>, log_prob double, inclusion double"
DIGEST = "doc_id long, sample int, n_pieces long, log_prob double, inclusion double, ids_sha256 string, round_trip boolean"


def encoder(model: bytes, k: int, seed: int, digest: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for first, end, texts in blocks(batch.column(1), TEXT_BYTES):
                ids = batch.column(0).slice(first, end - first)
                keys = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for turn, (some, counts, piece, at, step, data, logp, inclusion) in enumerate(sampled(texts, keys, v, k, seed)):
                    per, pieces = ids_of(counts, piece, at, step, data, v)
                    names = ["doc_id", "sample"]
                    fields = [ids, pa.array(np.full(texts.n, turn + 1, np.int32))]
                    measures = [pa.array(logp), pa.array(inclusion)]
                    if digest:
                        cut = np.concatenate(([0], np.cumsum(per)))
                        own = [pieces[cut[i]:cut[i + 1]] for i in range(texts.n)]
                        fields += [pa.array(per.astype(np.int64)), *measures,
                                   pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in own]),
                                   pa.array([decode_ids(x, v) == texts.text(i) for i, x in enumerate(own)])]
                        names += ["n_pieces", "log_prob", "inclusion", "ids_sha256", "round_trip"]
                    else:
                        fields += [ragged(pieces, per, pa.int32()), *measures]
                        names += ["ids", "log_prob", "inclusion"]
                    yield pa.record_batch(fields, names=names).filter(pa.array(some))
    return encode


def encoded(documents: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = 42) -> DataFrame:
    """k distinct sampled encodings per document (doc_id, text): ids, log probability, inclusion score."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encoder(read_model(model), k, seed, False), ENCODED)


def encoded_digest(documents: DataFrame, model: str = MODEL, k: int = SAMPLES, seed: int = 42) -> DataFrame:
    """As ``encoded``, with the ids' count, digest and whether they decode to the text instead of the ids."""
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encoder(read_model(model), k, seed, True), DIGEST)


def decoded(encodings: DataFrame, model: str = MODEL) -> DataFrame:
    """All columns of encodings and ``text``, decoded from the array ``ids``; null ids give null."""
    proto, columns = read_model(model), [c for c in encodings.columns if c != "text"]
    at = columns.index("ids")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(proto)
        for batch in batches:
            texts = [None if ids is None else decode_ids(np.asarray(ids, np.int32), v).decode("utf-8", "replace")
                     for ids in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*columns, "text"])

    return encodings.select(*columns).mapInArrow(decode, encodings.select(*columns).schema.add("text", "string"))
