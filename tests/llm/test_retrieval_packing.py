"""Packing: the contract, checked from the pieces themselves."""

import functools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from oreline.llm import retrieval_packing as packing
from oreline.llm.common import ship
from oreline.llm.queries import PACK_TOKENIZER, tokenizer_definition


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def definition():
    return tokenizer_definition(PACK_TOKENIZER)


@functools.cache
def library(definition):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def by_library(definition, text):
    return [*library(definition).encode(text or "", add_special_tokens=False).ids, packing.END]


ODD_TEXTS = [
    "",
    None,
    " \t\n",
    "Hello WORLD, it's 1234!\x0bI'll\x0c'd résumé ́x",
    "a<|endoftext|>b <|startoftext|> x<|endoftext|><|endoftext|>",
    "İstanbul ΣΑΣ \xa0non breaking\x85 \x1cgroup\x1d sep 漢字 हिन्दी 👩‍👩‍👧 ‍",
    "x" * 9000,
    "word " * 9000,
    "''s 't'll--''  'RE",
    "it's, IT'S. a.'s ,'s',s x'.s 3.14 1,000;two:three!?four \u2014, \u00e9,\u00e9 e\u0301.e n.\u0303 (a)b",
    "lower and UPPER <|ENDOFTEXT|> <|endoftext|>, Done.",
    "No specials, but Mixed CASE; \u0130stanbul stra\u00dfe \ufb01n \u01c5.",
]


def test_any_text_as_the_library_has_it(definition):
    rng = random.Random(11)
    pieces = ["a", "B", "ll", "'s", "'", ".", ",", ";!", " ", "\t", "7", "\u00e9", "e\u0301", "\u0303", "\u2014", "<|endoftext|>", "<", "x" * 60, "\u0130", "\u4e2d"]
    for specials in (True, False):
        some = [p for p in pieces if specials or "<" not in p]
        texts = ["".join(rng.choices(some, k=rng.randint(0, 30))) for _ in range(400)]
        ids, ends = packing.Encoder(definition).texts(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [by_library(definition, t) for t in texts]


@pytest.mark.parametrize("batch", [1, 3, len(ODD_TEXTS)])
def test_ids_are_the_librarys(definition, batch):
    encoder = packing.Encoder(definition)
    assert encoder.by_word
    for at in range(0, len(ODD_TEXTS), batch):
        texts = ODD_TEXTS[at : at + batch]
        ids, ends = encoder.texts(pa.array([t or "" for t in texts], pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [by_library(definition, t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    encoder = packing.Encoder(tokenizer_definition())
    assert not encoder.by_word
    ids, ends = encoder.texts(pa.array(["a b", ""], pa.large_string()))
    assert ids[ends[0] - 1] == packing.END and ids[ends[1] - 1] == packing.END and ends[1] == ends[0] + 1


def check(rows, wanted, window):
    """``wanted``: (id, ids) of each row. Every id in one piece, sequences gapless, full or a power of two."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id, r.doc_tokens].append((r.start, ids))
    padded = 0
    for parts in sequences.values():
        length = 0
        for offset, size in sorted(parts):
            assert offset == length
            length += size
        assert length <= window
        padded += 0 if length & (length - 1) == 0 else window - length
    expected = Counter((doc, len(ids)) for doc, ids in wanted)
    assert set(docs) == set(expected)
    # Rows that share id and length share the pieces' names: the ids at each start must be theirs, taken together.
    tokens = Counter()
    for (doc, count), pieces in docs.items():
        for start, ids in pieces:
            tokens.update((doc, count, start + i, t) for i, t in enumerate(ids))
    assert tokens == Counter((doc, len(ids), i, t) for doc, ids in wanted for i, t in enumerate(ids))
    return padded


@pytest.mark.parametrize("shard_tokens", [400, packing.SHARD_TOKENS])
@pytest.mark.parametrize("window", [64, 4096])
def test_every_id_is_in_one_piece(spark, definition, window, shard_tokens):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ba", "ko", "li", "mu") for b in ("n", "rt", "sk", "st")]
    texts = [*ODD_TEXTS, *[" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(150)]]
    rows = [(i if i % 5 else None, t, 1, "x") for i, t in enumerate(texts)] + [(7, "same text", 2, "y")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, length long, ids string").repartition(3)
    found = packing.pack_documents(df, definition, window=window, shard_tokens=shard_tokens)
    assert found.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert check(found.collect(), [(r[0], by_library(definition, r[1])) for r in rows], window) == 0


def test_nothing_to_pack(spark, definition):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, definition).count() == 0


def test_neighbours_share_a_window():
    """Documents of ten vocabularies, shuffled: windows hold one vocabulary each, but where one runs out."""
    rng = np.random.default_rng(1)
    topics = [np.arange(100 * t, 100 * t + 100) for t in range(10)]
    tails, topic = [], []
    for _ in range(400):
        t = int(rng.integers(10))
        tails.append(np.append(rng.choice(topics[t], 100), packing.END).astype(np.uint16))
        topic.append(t)
    weights = packing.Weights(dict(enumerate(np.bincount(np.concatenate([np.unique(x[:-1]) for x in tails]), minlength=1000).tolist())) | {-1: 400, -2: 40400}, 1000)
    windows = list(packing.fill(tails, weights, 1024))
    assert all(sum(b - a for _, a, b in w) == 1024 for w in windows[:39])
    pure = [len({topic[t] for t, _, _ in w}) for w in windows[:39]]
    assert sum(n == 1 for n in pure) >= 25


def test_scores_are_bm25():
    tails = [np.array(x, np.uint16) for x in ([1, 3, 3, 2], [3, 4, 2], [5, 2], [1, 4, 4, 4, 2])]
    weights = packing.Weights({1: 2, 3: 2, 4: 2, 5: 1, -1: 4, -2: 14}, 6)
    index = packing.Index(tails, weights)
    unused = np.array([False, True, True, True])
    assert index.neighbours(0, unused) == [1, 3]

    def idf(df):
        return np.log(1 + (4 - df + 0.5) / (df + 0.5))

    at = index.terms.tolist().index(4)
    got = dict(zip(index.tails[index.bounds[at] : index.bounds[at + 1]].tolist(), index.scores[index.bounds[at] : index.bounds[at + 1]]))
    for tail, tf, length in ((1, 1, 3), (3, 3, 5)):
        assert got[tail] == pytest.approx(idf(2) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / 3.5)), rel=1e-5)


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_distinct(kind):
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 500):
        ids = rng.integers(0, 40, n).astype(kind)
        terms, counts = packing.distinct(ids)
        assert dict(zip(terms.tolist(), counts.tolist())) == Counter(ids.tolist()) and list(terms) == sorted(terms)


def test_powers_of_two():
    parts = [(0, 5, 105), (1, 0, 60), (2, 0, 1)]
    pieces = list(packing._powers(parts, 161))
    assert [sum(b - a for _, a, b in p) for p in pieces] == [128, 32, 1]
    assert [x for p in pieces for x in p] == [(0, 5, 105), (1, 0, 28), (1, 28, 60), (2, 0, 1)]
