"""License scans with a positional index of rare words.

Words are lower-case runs of letters, digits and non-ASCII characters. Two
things are found in each whole text:

* base phrases, wherever their words stand in a row;
* licence notices. The index holds each template's rarest words, by document
  frequency over the whole corpus, with their positions. A text's words that
  the index holds vote for alignments (template, position in text minus
  position in template). An alignment with enough votes is compared word by
  word; it counts if the matched share of words is high enough and the
  template's mandatory phrases stand in the aligned place.

Results: a null or empty text has no words, labels or score. A template longer
than the text can match in part. Ties between alignments all count. Repeated
rows are judged each for itself. Extra columns stay aside.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import NOT_ALNUM, Texts, blocks

# Phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licences, with the phrases that must stand in a match.
TEMPLATES = {
    "mit-grant": ("released under the mit license", ["mit license"]),
    "mit-notice": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction", ["without restriction"]),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2"]),
    "gpl-2.0": ("licensed under the gnu general public license version 2", ["general public license version 2"]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3",
                ["general public license version 3"]),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation", ["free software", "general public license"]),
    "lgpl": ("licensed under the gnu lesser general public license", ["lesser general public license"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["source and binary forms", "conditions are met"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["with or without fee"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                ["mozilla public license"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["public domain"]),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license",
              ["creative commons attribution"]),
}
#: Index words per template, votes an alignment needs, matched share it needs.
RARE_WORDS = 8
VOTES = 2
MATCHED = 0.7
#: Score of a text that holds base phrases but no notice.
BASE_SCORE = 0.5

FOUND = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
         "score double")


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


@dataclass
class Words:
    """Words of the templates and phrases by number, and how to find them in a block."""

    names: list[str]
    hashes: np.ndarray
    order: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Words:
        names = sorted({w for t in texts for w in words_of(t)})
        block = next(blocks(pa.array(names)))[2]
        hashes = block.hashes(block.offsets[:-1], block.offsets[1:])
        order = np.argsort(hashes)
        return Words(names, hashes[order], order)

    def numbers(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word (-1: none of ours) and its text, for lower-case texts."""
        starts, ends, docs = texts.spans(NOT_ALNUM)
        hashes = texts.hashes(starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1), docs

    def sequence(self, text: str) -> np.ndarray:
        place = {w: i for i, w in enumerate(self.names)}
        return np.array([place[w] for w in words_of(text)])


def places(numbers: np.ndarray, docs: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Indexes of the words at which the phrase starts."""
    last = len(numbers) - len(phrase) + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    hit = docs[:last] == docs[len(phrase) - 1:]
    for j, word in enumerate(phrase):
        hit &= numbers[j:last + j] == word
    return np.flatnonzero(hit)


def document_frequencies(documents: DataFrame, words: Words) -> tuple[np.ndarray, int]:
    """In how many texts of the corpus each word stands, and the number of texts. One row per word is collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words.names) + 1, np.int64)
        for batch in batches:
            for _, _, texts in blocks(batch.column(0)):
                numbers, docs = words.numbers(texts.lower())
                seen = np.unique(docs[numbers >= 0] * len(words.names) + numbers[numbers >= 0]) % len(words.names)
                total[:-1] += np.bincount(seen, minlength=len(words.names))
                total[-1] += texts.n
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    rows = documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n")).collect()
    total = np.zeros(len(words.names) + 1, np.int64)
    for word, n in rows:
        total[word] = n
    return total[:-1], int(total[-1])


class Index:
    """Postings (word -> template, position) of each template's words of the highest IDF."""

    def __init__(self, words: Words, idf: np.ndarray, templates: dict):
        self.labels = list(templates)
        self.texts = [words.sequence(text) for text, _ in templates.values()]
        self.keys = [[words.sequence(k) for k in keys] for _, keys in templates.values()]
        postings: list[list[tuple[int, int]]] = [[] for _ in words.names]
        for t, sequence in enumerate(self.texts):
            rare = sorted(set(sequence.tolist()), key=lambda w: (-idf[w], w))[:RARE_WORDS]
            for at, word in enumerate(sequence.tolist()):
                if word in rare:
                    postings[word].append((t, at))
        self.count = np.array([len(p) for p in postings])
        self.first = np.cumsum(self.count) - self.count
        flat = np.array([x for p in postings for x in p]).reshape(-1, 2)
        self.template, self.position = flat[:, 0], flat[:, 1]

    def notices(self, numbers: np.ndarray, docs: np.ndarray, doc_first: np.ndarray) -> Iterator[tuple[int, str, float]]:
        """Text number, label and matched share of every confirmed alignment."""
        rare = np.flatnonzero(numbers >= 0)
        rare = rare[self.count[numbers[rare]] > 0]
        times = self.count[numbers[rare]]
        at = np.repeat(rare, times)
        entry = np.repeat(self.first[numbers[rare]], times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        key = np.stack([docs[at], self.template[entry], at - doc_first[docs[at]] - self.position[entry]], axis=1)
        if not len(key):
            return
        aligned, votes = np.unique(key, axis=0, return_counts=True)
        for doc, template, shift in aligned[votes >= VOTES].tolist():
            sequence = self.texts[template]
            base, end = doc_first[doc], doc_first[doc + 1]
            low, high = max(base, base + shift), min(end, base + shift + len(sequence))
            window, offset = numbers[low:high], low - base - shift
            share = float((window == sequence[offset:offset + len(window)]).sum()) / len(sequence)
            same = np.zeros(len(window), np.int64)
            if share >= MATCHED and all(len(places(window, same, key)) for key in self.keys[template]):
                yield doc, self.labels[template], share


def scanned(documents: DataFrame, templates: dict | None = None) -> DataFrame:
    """Base phrases, labels and score of every document (doc_id, text)."""
    templates = templates or TEMPLATES
    words = Words.of([*BASE_PHRASES, *(t for t, _ in templates.values()), *(k for _, ks in templates.values() for k in ks)])
    frequency, n = document_frequencies(documents, words)
    index = Index(words, np.log1p(n / (1 + frequency)), templates)
    phrases = {label: words.sequence(phrase) for phrase, label in BASE_PHRASES.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in blocks(batch.column(1)):
                numbers, docs = words.numbers(texts.lower())
                n_words = np.bincount(docs, minlength=texts.n)
                doc_first = np.concatenate(([0], np.cumsum(n_words)))
                n_base, low, high = np.zeros(texts.n, np.int64), np.full(texts.n, len(docs)), np.full(texts.n, -1)
                base: list[set[str]] = [set() for _ in range(texts.n)]
                for label, phrase in phrases.items():
                    at = places(numbers, docs, phrase)
                    own = at - doc_first[docs[at]]
                    n_base += np.bincount(docs[at], minlength=texts.n)
                    np.minimum.at(low, docs[at], own)
                    np.maximum.at(high, docs[at], own)
                    for doc in np.unique(docs[at]).tolist():
                        base[doc].add(label)
                labels = [set(x) for x in base]
                score = np.where(n_base > 0, BASE_SCORE, 0.0)
                for doc, label, share in index.notices(numbers, docs, doc_first):
                    labels[doc].add(label)
                    score[doc] = max(score[doc], share)
                none = n_base == 0
                yield pa.record_batch([
                    batch.column(0).slice(first, end - first), pa.array(n_words.astype(np.int64)), pa.array(n_base),
                    pa.array(low, mask=none), pa.array(high, mask=none),
                    pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in labels]),
                    pa.array(score)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, FOUND)
