"""Chat formatting by columnar byte assembly.

Each turn becomes header, content and footer of a template whose control
strings mark who speaks. A control string inside a text is escaped: a backslash
goes before a letter that stands for its first character, and a backslash in a
text is doubled, so that reading back is exact and no text can forge a turn.

Turns are laid out by column: the lengths of all segments, their running sum
and the scatter indices are computed in numpy, and headers, contents and
footers are copied into one buffer that becomes the Arrow column. Loss spans
(the assistants' contents) come from the same offsets.

Turns are ranged by conversation and turn, so a conversation of any length
spreads over tasks; what is formatted is one segment per turn, and a
conversation is its segments in order. Reading back runs over sorted segments
and keeps running digests only, never a conversation.

Results: a null text or role is empty; null turns come first, turns of null
conv_id form a conversation of their own. Rows that repeat a turn are all kept,
ordered by role and text. Extra columns stay aside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import Texts, blocks

# The template's control strings, and around each role's content what opens and closes it.
CONTROL = (b"<s>", b"</s>", b"[INST]", b"[/INST]", b"[SYS]", b"[/SYS]", b"[ROLE", b"[/ROLE]")
FRAMES = {b"user": (b"<s>[INST] ", b" [/INST]"), b"assistant": (b" ", b" </s>"), b"system": (b"[SYS] ", b" [/SYS]")}

ESCAPED = {0x5C: 0x5C, 0x3C: 0x6C, 0x5B: 0x62}  # backslash, less-than as l, bracket as b
UNESCAPED = {b"\\\\": b"\\", b"\\l": b"<", b"\\b": b"["}

SEGMENTS = "conv_id long, turn long, segment binary, loss_start long, loss_end long"


def frame(role: bytes) -> tuple[bytes, bytes]:
    """Header and footer; a role without a frame is named in hexadecimal."""
    return FRAMES.get(role) or (b"[ROLE " + role.hex().encode() + b"] ", b" [/ROLE]")


def escape_marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks bytes that get a backslash: backslashes and first bytes of control strings inside one text."""
    marks = data == 0x5C
    text_end = np.repeat(offsets[1:], np.diff(offsets))
    for control in CONTROL:
        last = len(data) - len(control) + 1
        if last <= 0:
            continue
        at = np.flatnonzero(data[:last] == control[0])
        for j, c in enumerate(control[1:], 1):
            at = at[data[at + j] == c]
        marks[at[at + len(control) <= text_end[at]]] = True
    return marks


def scatter(buffer: np.ndarray, to: np.ndarray, source: np.ndarray, at: np.ndarray, length: np.ndarray) -> None:
    """Copy ``length[i]`` bytes from ``source[at[i]:]`` to ``buffer[to[i]:]``."""
    ends = np.cumsum(length)
    step = np.arange(ends[-1] if len(ends) else 0)
    buffer[np.repeat(to - (ends - length), length) + step] = source[np.repeat(at - (ends - length), length) + step]


def assemble(roles: list[bytes], texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer and offsets of the segments, and where the content of each starts and ends inside it."""
    kinds, kind = np.unique(np.array(roles, object), return_inverse=True) if roles else ([], np.zeros(0, np.int64))
    frames = [frame(k) for k in kinds]
    heads, feet = ([f[i] for f in frames] for i in (0, 1))
    head_len, foot_len = (np.array([len(x) for x in part], np.int64) for part in (heads, feet))
    marks = escape_marks(texts.data, texts.offsets)
    extra = np.concatenate(([0], np.cumsum(marks)))
    content_at = texts.offsets + extra[texts.offsets]
    content = np.zeros(content_at[-1], np.uint8)
    place = np.arange(len(texts.data)) + extra[1:]
    content[place] = texts.data
    content[place[marks] - 1] = 0x5C
    for raw, letter in ESCAPED.items():
        content[place[marks & (texts.data == raw)]] = letter
    body = np.diff(content_at)
    length = head_len[kind] + body + foot_len[kind]
    at = np.concatenate(([0], np.cumsum(length)))
    buffer = np.empty(at[-1], np.uint8)
    for parts, sizes, to in ((heads, head_len, at[:-1]), (feet, foot_len, at[1:] - foot_len[kind])):
        source = np.frombuffer(b"".join(parts), np.uint8)
        scatter(buffer, to, source, (np.cumsum(sizes) - sizes)[kind], sizes[kind])
    scatter(buffer, at[:-1] + head_len[kind], content, content_at[:-1], body)
    return buffer, at, head_len[kind], head_len[kind] + body


def formatted(turns: DataFrame) -> DataFrame:
    """One segment per turn (conv_id, turn, role, text), in order, with the span that is under the loss mask."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in blocks(batch.column(3)):
                rows = batch.slice(first, end - first)
                roles = [r.encode() for r in rows.column(2).to_pylist()]
                buffer, at, start, stop = assemble(roles, texts)
                silent = np.array([r != b"assistant" for r in roles], bool)
                segments = pa.Array.from_buffers(pa.large_binary(), texts.n, [None, pa.py_buffer(at), pa.py_buffer(buffer)])
                yield pa.record_batch([rows.column(0), rows.column(1), segments.cast(pa.binary()),
                                       pa.array(start, mask=silent), pa.array(stop, mask=silent)],
                                      names=["conv_id", "turn", "segment", "loss_start", "loss_end"])

    ordered = (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text"))
    # Partitions are ranges in order, so the number of a row follows the order of turns.
    return ordered.mapInArrow(build, SEGMENTS).withColumn("place", F.monotonically_increasing_id())


UNESCAPE = re.compile(rb"\\[\\lb]")
NAMED = re.compile(rb"\[ROLE ([0-9a-f]*)\] ")


def parse(segment: bytes) -> tuple[bytes, bytes]:
    """Role and text of a segment."""
    for role, (head, foot) in FRAMES.items():
        if segment.startswith(head) and segment.endswith(foot) and len(segment) >= len(head) + len(foot):
            return role, unescape(segment[len(head):len(segment) - len(foot)])
    named = NAMED.match(segment)
    if not named or not segment.endswith(b" [/ROLE]"):
        raise ValueError("not a segment of this template")
    return bytes.fromhex(named[1].decode()), unescape(segment[named.end():-len(b" [/ROLE]")])


def unescape(content: bytes) -> bytes:
    return UNESCAPE.sub(lambda m: UNESCAPED[m[0]], content) if b"\\" in content else content


READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from its formatted segments: turns, digests of turns and of the text under the loss mask.

    The segments of a conversation pass through one task in order, as a digest
    needs them, one batch at a time.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, state = False, None

        def row():
            conv, n, turns, chars, loss, total = state
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), total]

        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4)]
            for conv, segment, start, stop in zip(*columns):
                if not open_ or conv != state[0]:
                    if open_:
                        done.append(row())
                    open_, state = True, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[1] += 1
                state[2].update(role + b"\n" + text + b"\n")
                state[5] += len(segment.decode())
                if start is not None:
                    masked = unescape(segment[start:stop])
                    state[3] += len(masked.decode())
                    state[4].update(masked)
            if done:
                yield table_of(done)
        if open_:
            yield table_of([row()])

    def table_of(rows):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(read, READ_BACK)
