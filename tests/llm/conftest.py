"""Small corpora with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, id long, topic string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["stone", "river", "Étude", "cloud", "paper", "ñandú", "green", "the", "of", "over", "träumt", "light"]
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 60)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1:]) for k in (10, 58)]
    far = " ".join(words[:30]) + " " + prose(2, 30)
    texts = [
        base, base, base.upper(), near[0], near[1], far, None, "", " \n\t ", "one", "one", "two words", "x" * 30_000,
        prose(3, 9_000), "a b c d e a b c d e a b c d e f g h i j", "日本語 😀 #### $$$$ |||| <<>> ok", prose(4, 30),
        "line one\nline one\nline two\n\n\nline one", "Released under the MIT License.", "mit-license MIT\nlicense"]
    made = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 7, "clash", -i, "own")
            for i, t in enumerate(texts)]
    return made + [made[3], (None, base, "en", "s0", 1, "k", 1, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
