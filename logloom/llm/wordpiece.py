"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form a byte trie. A node that cannot go on pops its
longest pieces and falls back to the node of the text that is left: its
failure link, with the number of popped pieces computed beforehand. Resolved
for every byte, this is one table ``state, byte -> state, popped``, so a word's
number of greedy longest-match pieces takes one step per byte, and no piece is
built. All distinct words of a block take their steps together in numpy.

A word is a run without white space; its first piece is one that starts a word
(the vocabulary's word mark), the others continue it. A word with a character
that no piece covers is one unknown token.

Results: a null or empty text has no words and tokens. Repeated rows and ids
are counted each for itself. Extra columns stay aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import SPACE, Texts, blocks
from .pieces import MARK, MODEL, read_model

COUNTED = "doc_id long, n_words long, n_tokens long, n_unknown long, max_word_tokens long"


def word_pieces(model: bytes) -> list[bytes]:
    """Pieces of the model as bytes; a leading space marks those that start a word."""
    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [m.id_to_piece(i).encode().replace(MARK, b" ") for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]


class Automaton:
    """``state`` and ``popped`` by (row, byte); state -1 means that no piece fits.

    Row 0 is the root inside a word, a word starts at ``begin``, the node of
    the space. ``left`` and ``unfit`` say how many pieces a node's own text
    gives at a word's end, and whether it gives any.
    """

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for raw in pieces:
            node = 0
            for c in raw:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({}), final.append(False)
                node = children[node][c]
            final[node] = node > 0
        order, at = [0], 0
        while at < len(order):
            order += children[order[at]].values()
            at += 1
        inner = [n for n in order if children[n] or not n]
        row_of = {n: k for k, n in enumerate(inner)}
        fail, pops = {0: -1}, {0: 0}
        self.state = np.full((len(inner), 256), -1, np.int32)
        self.popped = np.zeros((len(inner), 256), np.uint8)
        for node in order:
            if node in row_of:
                row = row_of[node]
                if node and fail[node] >= 0:
                    self.state[row] = self.state[row_of[fail[node]]]
                    self.popped[row] = self.popped[row_of[fail[node]]] + np.uint8(pops[node])
                for c, child in children[node].items():
                    # Failure and pops of the child, from the nodes above.
                    if final[child]:
                        fail[child], pops[child] = 0, 1
                    else:
                        z, n = fail[node], pops[node]
                        while z >= 0 and c not in children[z]:
                            n, z = n + pops[z], fail[z]
                        fail[child], pops[child] = (children[z][c], n) if z >= 0 else (-1, 0)
                        # A child that failed to a leaf pops that leaf as well.
                        while fail[child] >= 0 and not children[fail[child]]:
                            fail[child], pops[child] = 0, pops[child] + 1
                    leaf = child not in row_of
                    self.state[row, c] = 0 if leaf else row_of[child]
                    self.popped[row, c] = 1 if leaf else 0
        # A leaf is popped at once, as no longer piece can follow.
        self.left, self.unfit = np.zeros(len(inner), np.int32), np.zeros(len(inner), bool)
        for node, row in row_of.items():
            while node > 0:
                self.left[row] += pops[node]
                node = fail[node]
            self.unfit[row] = node < 0
        # Where no longer piece starts a word, the mark is popped before its first byte.
        space = children[0].get(32)
        self.begin = -1 if space is None else row_of.get(space, 0)
        self.lead = int(self.begin == 0)

    def lengths(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word; 0 where no pieces fit."""
        state = np.full(len(starts), self.begin, np.int32)
        total = np.full(len(starts), self.lead, np.int64)
        length, at = ends - starts, 0
        live = np.flatnonzero((length > 0) & (state >= 0))
        while len(live):
            c, s = texts.data[starts[live] + at], state[live]
            total[live] += self.popped[s, c]
            state[live] = s = self.state[s, c]
            at += 1
            live = live[(s >= 0) & (length[live] > at)]
        dead = state < 0
        last = np.maximum(state, 0)
        return np.where(dead | self.unfit[last], 0, total + self.left[last])


_automata: dict[bytes, Automaton] = {}


def automaton(model: bytes) -> Automaton:
    """One per worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _automata:
        _automata.clear()
        _automata[key] = Automaton(word_pieces(model))
    return _automata[key]


def token_counts(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """Words, tokens, unknown words and the longest word's tokens of every document (doc_id, text)."""
    proto = read_model(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(proto)
        for batch in batches:
            for first, end, texts in blocks(batch.column(1)):
                starts, ends, docs = texts.spans(SPACE)
                _, one, which = np.unique(texts.hashes(starts, ends), return_index=True, return_inverse=True)
                pieces = machine.lengths(texts, starts[one], ends[one])[which]
                unknown, most = pieces == 0, np.zeros(texts.n, np.int64)
                tokens = np.where(unknown, 1, pieces)
                np.maximum.at(most, docs, tokens)
                sums = [np.bincount(docs, w, texts.n).astype(np.int64) for w in (None, tokens, unknown)]
                yield pa.record_batch([batch.column(0).slice(first, end - first), *map(pa.array, (*sums, most))],
                                      names=["doc_id", "n_words", "n_tokens", "n_unknown", "max_word_tokens"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, COUNTED)
