"""Benchmark decontamination by CGK embeddings and bit sampling.

Words are the symbols. The CGK embedding walks over a string: at step j it writes the symbol it stands
on, and a random bit of (j, symbol) tells whether to move on. Strings within a few edits fall into step
again after each edit, so their embeddings have a small Hamming distance. Bit sampling reads the
embedding at a few random steps: equal samples make a candidate. Walks and samples are repeated until
a window within the edit bound is found with the target probability, which is measured on items with
random edits.

Sampling alone misses copies near the edit bound, mostly of items that are short for their class. So items are
also cut into one piece more than the edits allowed: edits within the bound leave a piece as it is, and every
place of a document that holds a piece word for word is a candidate too. Nothing within the bound is missed.
Items of fewer than 8 words are one piece and match exactly.

Windows are sized per class of item lengths (a factor of 1.5) and start at every s-th word of a
document; an item is indexed from each of its first words, so that some window is aligned with the item
whatever its place. Candidates are verified by the exact edit distance between the whole item and its
best-fitting stretch of words.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.words import LETTERS, mix, runs

#: An item is found in a document if a stretch of words is within this part of its length in edits.
EDIT_RATIO = 0.15
TARGET_RECALL = 0.99
#: Symbols read per sample.
SAMPLES = 4
#: A word is common if it stands in more than this part of the items.
COMMON = 0.02
#: Items of fewer words match only word for word.
MIN_WORDS = 8
#: Scripts without spaces between words (Thai, Lao, Burmese, Khmer, kana, Han): each character is a word.
UNSPACED = r"([\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}])"
#: Items go to every task, so they are taken in blocks of about so many bytes of text.
BLOCK_BYTES = 4 << 20

MATCH = "id long, item_id long, edits long, n_words long, start_word long, end_word long"


class Family:
    """Windows and samples for one class of item lengths."""

    def __init__(self, low: int, items: list[np.ndarray], common: np.ndarray, seed: int):
        self.common = common
        self.stride = max(1, low // 3)
        self.width = low - self.stride + 1
        self.steps = 3 * self.width
        rng = random.Random(seed)
        bound = max(1, int(EDIT_RATIO * low))
        chance = self._chance(items, bound, random.Random(seed + 1))
        self.repeats = max(2, math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - chance)))
        self.seeds = [rng.getrandbits(63) for _ in range(self.repeats)]
        self.reads = [self._sample(rng) for _ in range(self.repeats)]

    def _sample(self, rng: random.Random) -> list[int]:
        # A walk passes about one word in two steps: these reach over most of the window.
        return sorted(rng.sample(range(5 * self.width // 4), SAMPLES))

    def _chance(self, items: list[np.ndarray], bound: int, rng: random.Random) -> float:
        """The measured chance that one repetition finds an item with ``bound`` random edits.

        Measured on at most 50 items and 8 edited copies of each; never taken below 2 %.
        """
        hits = tries = 0
        for item in items[:50]:
            for _ in range(8):
                copy = list(item)
                for _ in range(bound):
                    at, kind = rng.randrange(len(copy)), rng.randrange(3)
                    if kind == 0:
                        copy[at] = rng.getrandbits(63)
                    elif kind == 1 and len(copy) > 1:
                        del copy[at]
                    else:
                        copy.insert(at, rng.getrandbits(63))
                shift, seed, reads = rng.randrange(self.stride), rng.getrandbits(63), self._sample(rng)
                edited = np.array([rng.getrandbits(63) for _ in range(self.stride)] + copy, np.uint64)
                starts = np.arange(shift, len(edited), self.stride)
                own, _, seen = self.item_keys(item, seed, reads)
                own = own[seen >= 2]
                hits += bool(np.isin(self.keys(edited, starts, np.full(len(starts), len(edited)), seed, reads), own).any())
                tries += 1
        return min(0.9, max(0.02, hits / max(1, tries)))

    def walk(self, words: np.ndarray, starts: np.ndarray, seed: int, reads: list[int]) -> Iterator[np.ndarray]:
        """The word that each start's walk stands on at each sampled step."""
        bits = [
            np.append((words * np.uint64((seed * (2 * k + 3) | 1) & (2**64 - 1)) >> np.uint64(33)).astype(np.int64), 0)
            for k in range(reads[-1] // 31 + 1)
        ]
        at, step = starts.astype(np.int64), 0
        for read in reads:
            while step < read:
                # Beyond the last word "clip" finds a blank, which never moves on.
                move = bits[step // 31].take(at, mode="clip")
                move >>= step % 31
                move &= 1
                at += move
                step += 1
            yield at

    def keys(self, words: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int, reads: list[int]) -> np.ndarray:
        """The sampled embedding, as one hash, of the window that begins at each start.

        Past its width, or where its text stops, a window reads blanks.
        """
        ends = np.minimum(starts + self.width, stops)
        out = np.full(len(starts), seed & (2**63 - 1), np.uint64)
        padded = np.append(words, np.uint64(1))
        for at in self.walk(words, starts, seed, reads):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += padded.take(np.where(at < ends, at, len(words)), mode="clip")
        return mix(out)

    def item_keys(self, words: np.ndarray, seed: int, reads: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, starts, uncommon words among the samples) of an item's windows."""
        starts = np.arange(max(1, len(words) - self.width + 1))
        stops = np.full(len(starts), len(words))
        marked, ends = np.append(~np.isin(words, self.common), False), np.minimum(starts + self.width, stops)
        seen = np.zeros(len(starts), np.int64)
        for at in self.walk(words, starts, seed, reads):
            seen += marked.take(np.where(at < ends, at, len(words)), mode="clip")
        return self.keys(words, starts, stops, seed, reads), starts, seen


def bound_of(n: int) -> int:
    """The edits that a copy of an item of n words may have."""
    return max(1, int(EDIT_RATIO * n)) if n >= MIN_WORDS else 0


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive words."""
    out = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for k in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[k : k + len(out)]
    return mix(out)


class Index:
    """The sampled windows of a bounded block of items, and their exact verification."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        classes: dict[int, list[int]] = defaultdict(list)
        for i, (_, words) in enumerate(items):
            if len(words) >= MIN_WORDS:
                classes[int(math.log(len(words) / MIN_WORDS) / math.log(1.5) + 1e-9)].append(i)
        # Words that stand in many items are common ones.
        every, times = np.unique(np.concatenate([np.unique(w) for _, w in items] or [np.zeros(0, np.uint64)]), return_counts=True)
        common = every[times > max(2, COMMON * len(items))]
        self.families = []
        for c, own in sorted(classes.items()):
            low = math.ceil(MIN_WORDS * 1.5**c - 1e-9)
            family = Family(low, [items[i][1] for i in own], common, 1000 + c)
            found: list[list[tuple]] = [[] for _ in family.seeds]
            for i in own:
                rows = [family.item_keys(items[i][1], seed, reads) for seed, reads in zip(family.seeds, family.reads)]
                seen = np.array([r[2] for r in rows])
                # A sample with less than two uncommon words would match any text. What leaving it out costs is
                # part of the measured chance, but each alignment keeps its best samples: no exact copy is missed.
                kept = seen >= 2
                for turn in range(family.stride):
                    part = np.s_[:, turn :: family.stride]
                    if not kept[part].any():
                        kept[part] |= seen[part] == seen[part].max(initial=0)
                for out, keep, (keys, starts, _) in zip(found, kept, rows):
                    out.append((keys[keep], np.full(int(keep.sum()), i), starts[keep]))
            tables = []
            for rows in found:
                keys, which, at = map(np.concatenate, zip(*rows))
                order = np.argsort(keys, kind="stable")
                tables.append((keys[order], which[order], at[order]))
            self.families.append((family, tables))
        pieces: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for i, (_, words) in enumerate(items):
            n = len(words)
            if n:
                count = bound_of(n) + 1
                width = n // count
                grams = _grams(words, width)
                pieces[width] += [(int(grams[at]), i, at) for at in sorted({k * n // count for k in range(count)})]
        self.pieces = []
        for width, rows in sorted(pieces.items()):
            rows.sort()
            self.pieces.append((width, np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])))
        # Bit masks for the verification: where in the item a word stands.
        self.masks = []
        for _, words in items:
            mask: dict[int, int] = defaultdict(int)
            for j, w in enumerate(words.tolist()):
                mask[w] |= 1 << j
            self.masks.append(dict(mask))

    def candidates(self, words: np.ndarray, limits: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, word at which the item would begin) for texts words[limits[i]:limits[i + 1]]."""
        found: set[tuple[int, int, int]] = set()
        for family, tables in self.families:
            starts = np.arange(0, len(words), family.stride)
            text = np.searchsorted(limits, starts, side="right") - 1
            stops = limits[text + 1]
            for (keys, which, at), seed, reads in zip(tables, family.seeds, family.reads):
                mine = family.keys(words, starts, stops, seed, reads)
                if not len(keys):
                    continue
                place = np.searchsorted(keys, mine)
                place[place == len(keys)] = 0
                for hit in np.flatnonzero(keys[place] == mine):
                    k, p = mine[hit], int(place[hit])
                    while p < len(keys) and keys[p] == k:
                        found.add((int(text[hit]), int(which[p]), int(starts[hit] - at[p])))
                        p += 1
        for width, keys, which, at in self.pieces:
            mine = _grams(words, width)
            place = np.searchsorted(keys, mine)
            place[place == len(keys)] = 0
            for hit in np.flatnonzero(keys[place] == mine):
                text = int(np.searchsorted(limits, hit, side="right")) - 1
                if hit + width > limits[text + 1]:
                    continue
                k, p = mine[hit], int(place[hit])
                while p < len(keys) and keys[p] == k:
                    found.add((text, int(which[p]), int(hit - at[p])))
                    p += 1
        return found

    def verify(self, item: int, words: np.ndarray, begin: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the item's best-fitting stretch of words near ``begin``, if within the bound."""
        n = len(self.items[item][1])
        bound = bound_of(n)
        low, high = max(0, begin - bound), min(len(words), begin + n + 2 * bound)
        edits, end = _search(self.masks[item], n, words[low:high].tolist())
        if edits > bound:
            return None
        # The same search backwards from the end gives the start.
        mask = {w: int(f"{m:0{n}b}"[::-1], 2) for w, m in self.masks[item].items()}
        _, back = _search(mask, n, words[low : low + end][::-1].tolist(), edits)
        return edits, low + end - back, low + end


def _search(masks: dict[int, int], n: int, words: list[int], stop: int = 0) -> tuple[int, int]:
    """Bit-parallel search of a pattern of n words: (least edits, words read until then), starting anywhere."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, at = n, 0
    for i, w in enumerate(words, 1):
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
        if score < best:
            best, at = score, i
            if best <= stop:
                break
    return best, at


def _index(items: list[tuple[int, str]]) -> Index:
    texts = pa.array([t for _, t in items], pa.string())
    words = [hashes[i:j].copy() for _, hashes, limits in runs(texts, LETTERS) for i, j in zip(limits[:-1], limits[1:])]
    return Index([(i, w) for (i, _), w in zip(items, words)])


def _matcher(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("id")
            for first, hashes, limits in runs(batch.column("text"), LETTERS):
                best: dict[tuple[int, int], tuple] = {}
                for i, item, begin in sorted(index.candidates(hashes, limits)):
                    if best.get((i, item), (1,))[0] == 0:
                        continue
                    match = index.verify(item, hashes[limits[i] : limits[i + 1]], begin - int(limits[i]))
                    if match and match < best.get((i, item), (1 << 30,)):
                        best[i, item] = match
                for (i, item), (edits, start, end) in sorted(best.items()):
                    out.append((ids[first + i].as_py(), index.items[item][0], edits, len(index.items[item][1]), start, end))
            columns = list(zip(*out)) if out else [[]] * 6
            names = [c.split()[0] for c in MATCH.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Rows (id, item_id, edits, n_words, start_word, end_word): each benchmark item a document holds, once.

    ``edits`` is the exact distance in words between the item and the document's best stretch, at most
    ``max(1, 0.15 * n_words)``. Words are runs of ASCII letters and digits and any non-ASCII characters,
    with A-Z in lower case, so case, punctuation and line ends do not hide a copy; in scripts without spaces
    each character is a word. Null and empty texts match nothing, items of fewer than 8 words only
    word for word; repeated items and rows are each reported; empty
    tables give no rows. Only the named columns are read. Documents stay where they are read: there is
    no shuffle, and a long one is cut into runs of words only for memory.

    Items go to all tasks in blocks of about 4 MB of text, as many passes over the documents as there
    are blocks; the driver holds one block at a time while it plans.
    """
    apart = lambda name: F.regexp_replace(F.col(name).cast("string"), UNSPACED, " $1 ")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), apart(text_col).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), apart(item_text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    parts = []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        found = sorted(own.collect(), key=lambda r: (r.item_id is None, r.item_id, r.text))
        parts.append(rows.mapInArrow(_matcher(_index([(r.item_id, r.text) for r in found])), MATCH))
    matches = parts[0]
    for p in parts[1:]:
        matches = matches.unionByName(p)
    return matches.withColumnRenamed("id", id_col)
