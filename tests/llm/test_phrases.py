"""Phrase mining against counting by hand."""

import re
from collections import Counter

import pytest
from conftest import rows_of

from oreline.llm import phrases
from oreline.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def by_hand(rows, max_words=3, min_count=10, top=2000, inside=50):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            words = tuple(w for w in re.split(r"[ \t]", piece) if w)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[words[i : i + k]] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= inside * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def frame(spark, rows, tasks=3):
    extended = [(i, t, lang, "x", i) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(extended, "doc_id long, text string, lang string, phrase string, score long").repartition(tasks)


ODD = [
    (None, "en"),
    ("", "en"),
    (" \t\n.,;", "en"),
    ("Ärger ärger ÄRGER", "de"),
    *[("New York City\tnew  york. Hall; York\x0bhall", None)] * 6,
    *[("a a a a a a a", "en")] * 4,
    *[("the cat, the cat! the dog sat:the dog sat\ron it", "en"), ("\U0001f600 naïve \U0001f600 naïve", "")] * 7,
    ("one two three " * 4000, "en"),
    ("x" * 100_000, "en"),
]


@pytest.mark.parametrize("leaves", [phrases.LEAVES, 50])
@pytest.mark.parametrize("chunk", [phrases.CHUNK_BYTES, 40])
def test_odd_texts(spark, monkeypatch, leaves, chunk):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    found = phrases.collocations(frame(spark, ODD), leaves=leaves)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(found) == by_hand(ODD)


def test_longer_phrases_and_a_short_list(spark):
    rows = [("to be or not to be that is the question", "en"), ("to be sure, or not to be", "en")] * 3
    options = {"max_words": 4, "min_count": 3, "top": 7}
    assert rows_of(phrases.collocations(frame(spark, rows), **options)) == by_hand(rows, inside=50, **options)


def test_no_phrases(spark):
    assert phrases.collocations(frame(spark, ODD).limit(0)).count() == 0
    assert phrases.collocations(frame(spark, [("a b c", "en"), (None, None)])).count() == 0


def test_open_branches_only(spark):
    """A suffix is sent only if both shorter phrases are frequent."""
    texts = ["a b c"] * 10 + ["a b x", "y b c"]
    import pyarrow as pa

    chunk = phrases.Words(pa.array(texts), pa.array(["en"] * len(texts)))
    pairs, counts = chunk.suffixes(2, None)
    frequent = chunk.hashes(pairs[counts >= 10], 2)
    at, counts = chunk.suffixes(3, lambda hashes: (hashes[:, None] == frequent).any(axis=1))
    assert [p.as_py() for p in chunk.rows(at, 3)[1]] == ["a b c"] and list(counts) == [10]
