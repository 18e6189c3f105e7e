"""The parts that run inside tasks, without Spark: hashes, token counts, ZIP packages, spans."""

import io
import itertools
import random
import re
import time
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oreline.llm import decontaminate, near_join, pii, token_counts, warc_zip
from oreline.llm.queries import tokenizer_definition
from oreline.llm.words import LETTERS, SPACED, runs, shingles

TEXTS = st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aB \n\t\x0b.é\x00\x1c", max_size=40))


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=200, deadline=None)
def test_equal_words_have_equal_hashes(texts):
    seen = {}
    got = [h[a:b].tolist() for _, h, lim in runs(pa.array(texts, pa.string()), SPACED) for a, b in zip(lim[:-1], lim[1:])]
    assert [len(x) for x in got] == [len(words_of(t)) for t in texts]
    for text, hashes in zip(texts, got):
        for word, h in zip(words_of(text), hashes):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_letters_ignore_case_and_punctuation():
    (_, h, lim), = runs(pa.array(["Ab, c!", "ab c", None, ""]), LETTERS)
    assert lim.tolist() == [0, 2, 4, 4, 4] and h[:2].tolist() == h[2:4].tolist()


def test_shingles_of_short_texts():
    (_, h, lim), = runs(pa.array(["a b c", "a b c d e", "a b c d e f", "a b c"]), SPACED)
    sets = [shingles(h[a:b]) for a, b in zip(lim[:-1], lim[1:])]
    assert [len(s) for s in sets] == [1, 1, 2, 1] and sets[0] == sets[3] and sets[1][0] in sets[2]


@pytest.mark.parametrize("n", [4, 7, 15, 40, 130, 600, 3000])
def test_sets_at_the_threshold_share_a_key(n):
    rng = np.random.default_rng(n)
    for trial in range(60):
        apart = near_join.allowed(2 * n) // 2
        common = rng.integers(0, 2**63, n - apart, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, apart, dtype=np.uint64)])) for _ in range(2))
        keys, owner = near_join.parity_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        if apart:
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())
        one = near_join.bit_sketches(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        far = sum(int(x).bit_count() for x in one[:8] ^ one[8:])
        assert far <= len(set(a.tolist()) ^ set(b.tolist()))


@given(st.text(max_size=80) | st.text(alphabet="a1 '\n\t \x1c.!<|endoftext|>", max_size=60))
@settings(max_examples=150, deadline=None)
def test_token_counts_equal_the_library(text):
    from tokenizers import Tokenizer

    definition = tokenizer_definition()
    count = test_token_counts_equal_the_library.__dict__.setdefault("count", token_counts.counter(definition))
    whole = test_token_counts_equal_the_library.__dict__.setdefault("whole", Tokenizer.from_str(definition))
    for t in (text, f"{text}<|endoftext|>{text}"):
        assert count(t) == len(whole.encode(t, add_special_tokens=False).ids)


def _edits(a, b):
    """Least edits between a and any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_bit_parallel_search_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 120))]
        mask = {}
        for j, w in enumerate(a):
            mask[w] = mask.get(w, 0) | 1 << j
        assert decontaminate._search(mask, len(a), b)[0] == _edits(a, b)


def test_edited_items_are_found():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 60)))) for i in range(60)]
    index = decontaminate._index(items)
    docs, found = [], 0
    for i, text in items:
        words = text.split()
        for _ in range(max(1, int(decontaminate.EDIT_RATIO * len(words)))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append(" ".join(rng.choice(vocabulary) for _ in range(50)) + " " + " ".join(words) + " tail")
    batch = pa.RecordBatch.from_pydict({"id": list(range(60)), "text": docs})
    rows = [r for out in decontaminate._matcher(index)([batch]) for r in out.to_pylist()]
    found = {r["id"] for r in rows if r["id"] == r["item_id"]}
    assert len(found) >= 57
    for r in rows:
        words = docs[r["id"]].split()[r["start_word"] : r["end_word"]]
        assert _edits(items[r["item_id"]][1].split(), words) == r["edits"] <= max(1, int(decontaminate.EDIT_RATIO * r["n_words"]))
    exact = pa.RecordBatch.from_pydict({"id": list(range(60)), "text": [f"Some words. {t.upper()}!" for _, t in items]})
    rows = [r for out in decontaminate._matcher(index)([exact]) for r in out.to_pylist()]
    assert {r["id"] for r in rows if r["id"] == r["item_id"] and not r["edits"]} == set(range(60))


@pytest.mark.parametrize("n", [8, 12, 14, 18, 27, 41, 61])
def test_no_edited_item_is_missed(n):
    """Copies with as many edits of all kinds as the bound allows, spread evenly, and short items word for word."""
    rng = random.Random(n)
    items = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(n))) for i in range(100)] + [(100, "only three words")]
    docs, bound = [], max(1, int(decontaminate.EDIT_RATIO * n))
    for _, text in items[:100]:
        words = text.split()
        for k in reversed(range(bound)):
            at = (2 * k + 1) * n // (2 * bound)
            words[at : at + 1] = rng.choice([["x"], [], ["y", words[at]]])
        docs.append("a few words before " + " ".join(words) + " and after")
    batch = pa.RecordBatch.from_pydict({"id": list(range(101)), "text": [*docs, "Here: only THREE words, and only two"]})
    rows = [r for out in decontaminate._matcher(decontaminate._index(items))([batch]) for r in out.to_pylist()]
    assert {r["id"] for r in rows if r["id"] == r["item_id"]} == set(range(101))


def test_members_of_zip_and_zip64():
    for big in (False, True):
        f = io.BytesIO()
        with zipfile.ZipFile(f, "w", zipfile.ZIP_STORED) as z:
            z.comment = b"a comment with PK\x05\x06 inside"
            with z.open("archive/data", "w", force_zip64=big) as m:
                m.write(b"payload")
            z.writestr("empty", b"")
        size = f.tell()
        first, second = warc_zip.members(f, size)
        assert (first.name, first.stored, second.size) == ("archive/data", 7, 0)
        assert warc_zip._read(f, first.offset, first.stored) == b"payload"


def test_zip64_directory():
    """A directory whose sizes and offsets all stand in ZIP64 fields, as in archives beyond 4 GB."""
    import struct

    name, data = b"x", b"hello"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + name + struct.pack("<HHQQ", 1, 16, 5, 5)
    at = len(local) + 5
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    f = io.BytesIO(local + data + entry + end64 + locator + end)
    (m,) = warc_zip.members(f, len(f.getvalue()))
    assert warc_zip._read(f, m.offset, m.stored) == data


def test_damaged_packages_are_refused():
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.members(io.BytesIO(b"x" * 100), 100)
    record = warc_zip._record(1, "u", "response", None, 3, "0" * 40, b"abc")
    with pytest.raises(ValueError, match="digest"):
        warc_zip.parse_record(record)


NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive_spans(text):
    out = []
    for kind, pattern in NAIVE.items():
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            if kind == "card":
                total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
                if not 13 <= len(d) <= 19 or total % 10:
                    continue
            out.append((kind, *m.span()))
    return out


@given(st.text(alphabet="a.@-+%0123456789 ()\né", max_size=80))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == naive_spans(text)
    both = text + " 4111 1111 1111 1111 x@y.zz +1 (784) 555-8120 1.2.3.4 " + text
    assert pii.base_spans(both) == naive_spans(both)


def test_mentions_follow_an_entity_through_the_document():
    text = "Call +1 (784) 555-8120 or write to ann.lee40@mail.example.com. " + "words " * 50 + "Again 784 555 8120, or ann.lee40 as ever. 111 222 3333 is not it."
    counts = {("shape", pii.shape("784 555 8120"), "none"): 50, ("shape", pii.shape("784 555 8120"), "phone"): 20, ("shape", "word 0", "none"): 5000,
              ("shape", "word 1-6", "none"): 50, ("shape", "word 1-6", "email"): 5, ("chain", "none", "none"): 5000, ("skip", "phone", "phone"): 9}
    found = pii.Field(counts).mentions(text, pii.base_spans(text))
    assert [(k, text[s:e]) for k, s, e in found if k == "phone_ref"] == [("phone_ref", "784 555 8120")]
    assert pii.Field(counts).mentions("784 555 8120", []) == []


def exact_marginals(field, unary, names, beside):
    """By enumeration of all labellings: chain potentials of neighbours, skip potentials of every two look-alikes."""
    n, k = unary.shape
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        weight = sum(unary[i, x] for i, x in enumerate(labels))
        weight += sum(field.chain[labels[i], labels[j]] for i in range(n) for j in beside[i] if i < j)
        weight += sum(field.agree[labels[i], labels[j]] for i in range(n) for j in range(i) if names[i] & names[j])
        total[range(n), labels] += np.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


COUNTS = {("shape", "word 0", "none"): 900, ("shape", "word 0", "email"): 40, ("like", "word 0", "email"): 60, ("stray", "word 0", "email"): 15,
          ("chain", "none", "none"): 900, ("chain", "none", "email"): 40, ("chain", "email", "email"): 40, ("skip", "email", "email"): 20, ("skip", "email", "phone"): 5}


@pytest.mark.parametrize(
    "text",
    [
        "Write to office@example.org soon. The office is open.",
        "Write to office@example.org soon. The office is open, office workers say; an office",
        "office office office@example.org and desk.one@example.org, not desk.one or office desk.one or office",
    ],
)
def test_messages_between_look_alikes_equal_enumeration(text):
    field = pii.Field(COUNTS)
    nodes = pii.tokens(text, pii.base_spans(text))
    free, unary, names, beside = field.graph(text, nodes)
    unary[0] += [0, 3, 0, 0, 0]
    assert {text[nodes[i][0] : nodes[i][1]].strip(".,;") for i in free} <= {"office", "desk.one"} and len(free) <= 6
    assert all(abs(free[i] - free[j]) == 1 for i, near in enumerate(beside) for j in near)
    got, want = field.marginals(unary, names, beside), exact_marginals(field, unary, names, beside)
    assert (got.argmax(axis=1) == want.argmax(axis=1)).all()
    # On a graph without loops they are the same; with loops, near.
    assert np.abs(got - want).max() < (1e-3 if len(free) <= 2 else 0.2)


def test_look_alikes_that_are_not_observed_share_what_is_known_of_one():
    field = pii.Field(COUNTS)
    unary = np.array([[0.0, 2, -9, -9, -9], [0.5, 0, -9, -9, -9], [0.5, 0, -9, -9, -9]])
    apart = field.marginals(unary, [frozenset({"a"}), frozenset({"b"}), frozenset({"c"})], [[], [], []])
    alike = field.marginals(unary, [frozenset({"a"})] * 3, [[], [], []])
    assert list(apart.argmax(axis=1)) == [1, 0, 0] and list(alike.argmax(axis=1)) == [1, 1, 1]


def test_a_word_repeated_ten_thousand_times_takes_no_pairs():
    text = "Write to bob.smith@example.org. " + "bob.smith " * 5000 + "Then bob.smith said. " * 5000
    base = pii.base_spans(text)
    began = time.monotonic()
    found = pii.Field(COUNTS | {("like", "word 0 joined", "email"): 9, ("shape", "word 0 joined", "none"): 9}).mentions(text, base)
    assert len(found) == 10_000 and time.monotonic() - began < 20
