"""Small documents with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row long, toxicity string, _tokens string"


def documents(spark, rows):
    """``rows`` of (doc_id, text), with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7, None, "x", "y") for i, t in rows], SCHEMA)


def words(n, seed):
    rng = random.Random(seed)
    return [rng.choice(["the", "of", "blend", "Ouir", "thenti", "edston", "île", "straße", "nd", "where"]) + rng.choice(["", "er", "ing", "x", "é"]) for _ in range(n)]


def odd_texts():
    """Null, empty, blank, short, repeated, special and very long texts."""
    long = " ".join(words(6000, 1))
    return [None, "", " ", "one", "two words", "a  b \n c ", "Don't <|endoftext|> stop", "naïve café 日本 😀 ΣΑΣ", "x" * 5000, long, long, " ".join(words(80, 2)), " ".join(words(80, 2)) + " end"]


def rows():
    return [(i, t) for i, t in enumerate(odd_texts())] + [(None, "no id at all"), (3, "one"), (3, "another text of three")]


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}
