"""Phrase collocations from suffix trees that are partitioned by prefix and cut off at a depth.

The suffixes of all pieces of text, as far as the longest phrase, form one tree: a phrase is a node, and
the leaves below it are its occurrences. No machine holds that tree, so it is cut *vertically*:

1. Words are counted, which are the tree's first level. A group is the set of word prefixes whose
   leaves fit into ``LEAVES``: as many groups as the number of leaves asks for, prefixes dealt by hash. A
   word with more than a quarter of a group's leaves is extended by the next word, and these longer
   prefixes are dealt on their own.
2. A task reads texts, counts equal suffixes among them, and sends each once, with its count, to the
   group of its prefix. Groups build their subtrees side by side, and know nothing of each other.
3. Subtrees grow level by level. Below a node with fewer leaves than ``min_count`` no phrase can be
   frequent, so such a branch is closed: the next level's suffixes are sent only if both the phrase
   without its last and the one without its first word are open. Which are open travels as a bitmap of
   fixed size; a hash that is set by chance lets a suffix through that is then counted and dropped.

Scores and the choice of cuts are joins on the counted phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import staged
from oreline.llm.words import _buffers, mix, runs

#: Leaves (suffixes) of a group of prefixes; what one task holds at a time.
LEAVES = 1 << 18
#: Bits that tell open branches from closed ones: 8 MB, whatever the input.
OPEN_BITS = 26
#: Bytes of text whose suffixes are counted together before they are sent; a longer text is taken whole.
CHUNK_BYTES = 4 << 20
#: Rows that are handed on at once.
BATCH_ROWS = 1 << 16
#: Language of documents that state none.
UNKNOWN = "und"

_SPACE, _BREAK = 0x20, 0x0A
_CLASSES = bytes(
    _BREAK if b in b".,;:!?\x0a\x0b\x0c\x0d" else _SPACE if b in b"\x20\x09" else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)
#: For hashing phrases, where a single space separates words and nothing else does.
_APART = bytes(0 if b == _SPACE else b or 0xFF for b in range(256))


def _step(i: int) -> np.uint64:
    return mix(np.array([i + 1], np.uint64))[0] | np.uint64(1)


def _hash(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """A hash of phrases from those of their languages and words."""
    total = lang + np.uint64(len(words))
    for i, word in enumerate(words):
        total = total + word * _step(i)
    return mix(total)


def _hash_texts(texts: pa.Array) -> np.ndarray:
    """A hash of each of some whole texts (language codes)."""
    bare = pc.binary_replace_slice(texts.cast(pa.large_binary()), 0, 0, b"l").cast(pa.large_string())
    return np.concatenate([np.zeros(0, np.uint64), *(h for _, h, _ in runs(bare, bytes(b or 0xFF for b in range(256))))])


class Words:
    """The words of a chunk of texts in order: which they are, their language, and whether each one continues the piece before."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        offsets, data = _buffers(texts)
        bounds = offsets - offsets[0]
        own = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes().translate(_CLASSES), np.uint8)
        own = np.insert(own, bounds[1:], _BREAK)  # texts break phrases as well
        bounds = bounds + np.arange(len(bounds))
        solid = np.zeros(len(own) + 1, bool)
        np.logical_and(own != _SPACE, own != _BREAK, out=solid[1:])
        edges = np.flatnonzero(solid[1:] != solid[:-1]).astype(np.int64)
        self.count = len(edges) // 2
        if not self.count:
            return
        # Words and the gaps between them as one array of texts, of which every second is taken.
        both = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(own))
        words = both.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
        begin = edges[::2]
        piece = np.searchsorted(np.flatnonzero(own == _BREAK), begin)
        self.follows = np.zeros(self.count, bool)
        self.follows[1:] = piece[1:] == piece[:-1]
        self.word, self.texts = np.asarray(words.indices).astype(np.int64), words.dictionary
        langs = pc.fill_null(langs.cast(pa.string()), UNKNOWN).dictionary_encode()
        text = np.searchsorted(bounds, begin, "right") - 1
        self.lang, self.langs = np.asarray(langs.indices).astype(np.int64)[text], langs.dictionary
        self._word_hash = np.concatenate([h for _, h, _ in runs(self.texts, _APART)])
        self._lang_hash = _hash_texts(self.langs)

    def hashes(self, at: np.ndarray, words: int) -> np.ndarray:
        return _hash(self._lang_hash[self.lang[at]], [self._word_hash[self.word[at + i]] for i in range(words)])

    def rows(self, at: np.ndarray, words: int) -> tuple[pa.Array, pa.Array]:
        """(language, phrase) of the phrases that begin at ``at``."""
        parts = [self.texts.take(pa.array(self.word[at + i])).cast(pa.string()) for i in range(words)]
        phrase = parts[0] if words == 1 else pc.binary_join_element_wise(*parts, " ")
        return self.langs.take(pa.array(self.lang[at])), phrase

    def suffixes(self, words: int, is_open: Callable[[np.ndarray], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases of so many words whose branches are open: where each begins, and how often it occurs."""
        _, first, code, counts = np.unique(
            self.lang * len(self.texts) + self.word, return_index=True, return_inverse=True, return_counts=True
        )
        if words == 1:
            return first, counts
        base, single = len(first), code
        start = np.arange(self.count)
        for size in range(2, words + 1):
            start = start[start + size <= self.count]
            start = start[self.follows[start + size - 1]]
            # ``code`` numbers the shorter phrases, densely, by where they begin.
            keys = code[start] * base + single[start + size - 1]
            if is_open is not None and size == words:
                # Each shorter phrase is looked up once, not once for each place.
                able = np.zeros(int(code.max(initial=0)) + 1, bool)
                able[code[first]] = is_open(self.hashes(first, size - 1))
                kept = able[code[start]] & able[code[start + 1]]
                start, keys = start[kept], keys[kept]
            _, where, dense, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            first = start[where]
            code = np.zeros(self.count, np.int64)
            code[start] = dense
        return first, counts


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Words]:
    for batch in batches:
        texts = pc.fill_null(batch.column(0).cast(pa.large_string()), "")
        sizes = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
            chunk = Words(texts.slice(at, stop - at), batch.column(1).slice(at, stop - at))
            if chunk.count:
                yield chunk
            del chunk
            pa.default_memory_pool().release_unused()
            at = stop


def _in_batches(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for at in range(0, whole.num_rows, BATCH_ROWS):
        yield whole.slice(at, BATCH_ROWS)


def _is_open(bits: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    def ask(hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64(2**OPEN_BITS - 1)
        return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    return ask


def _word_counts(limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, limit):
            at, counts = chunk.suffixes(1, None)
            lang, phrase = chunk.rows(at, 1)
            yield from _in_batches([lang, phrase, pa.array(counts)], ["lang", "phrase", "f"])

    return task


#: Leaves on their way to a group: a row for each chunk and language, with first words, how many leaves each of
#: them has, and the rest and the count of each leaf. Words end with a space.
_LEAVES = "grp int, lang string, words string, leaves array<int>, rests string, counts array<int>"


def _joined(texts: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Runs of texts as one text each, without a copy: those from one of ``bounds`` to the next."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets[bounds]), texts.buffers()[2]).cast(pa.string())


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _leaves(words: int, bits: np.ndarray, heavy: np.ndarray, groups: int, limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = _is_open(bits)
        for chunk in _chunks(batches, limit):
            at, counts = chunk.suffixes(words, ask)
            if not len(at):
                continue
            prefix = chunk.hashes(at, 1)
            prefix = np.where(np.isin(prefix, heavy), chunk.hashes(at, 2), prefix)
            group = ((prefix >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
            order = np.lexsort((chunk.word[at], chunk.lang[at], group))
            at, counts, group = at[order], counts[order], group[order]
            apart = (group[1:] != group[:-1]) | (chunk.lang[at[1:]] != chunk.lang[at[:-1]])
            row = np.flatnonzero(np.concatenate([[True], apart]))
            word = np.flatnonzero(np.concatenate([[True], apart | (chunk.word[at[1:]] != chunk.word[at[:-1]])]))
            # "b c " of one phrase after that of another: a row has a run of them.
            ends = [pa.scalar(x, pa.large_string()) for x in ("", " ")]
            rests = pc.binary_join_element_wise(*[chunk.texts.take(pa.array(chunk.word[at + i])) for i in range(1, words)], *ends)
            heads = pc.binary_join_element_wise(chunk.texts.take(pa.array(chunk.word[at[word]])), *ends)
            bounds, word_bounds = np.append(row, len(at)), np.append(np.searchsorted(word, row), len(word))
            yield from _in_batches(
                [
                    pa.array(group[row]),
                    chunk.langs.take(pa.array(chunk.lang[at[row]])),
                    _joined(heads, word_bounds),
                    _lists(np.diff(np.append(word, len(at))), word_bounds),
                    _joined(rests, bounds),
                    _lists(counts, bounds),
                ],
                ["grp", "lang", "words", "leaves", "rests", "counts"],
            )

    return task


def _split(texts: pa.Array) -> pa.Array:
    """The words of all texts; each ends with a space, the last one's begins an empty word."""
    return pc.list_flatten(pc.split_pattern(pc.utf8_rtrim(texts, " "), " "))


def _subtree(words: int, min_count: int):
    """The nodes of one level of a group's subtrees: equal suffixes meet, their leaves are added."""

    def build(leaves: pa.Table) -> pa.Table:
        columns = {name: leaves[name].combine_chunks() for name in leaves.column_names}
        lang = columns["lang"].take(pc.list_parent_indices(columns["counts"]))
        sizes = np.asarray(pc.list_flatten(columns["leaves"]))
        word = _split(columns["words"]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        parts = _split(columns["rests"])
        rest = [parts.take(pa.array(np.arange(i, len(parts), words - 1))) for i in range(words - 1)]
        phrase = pc.binary_join_element_wise(word, *rest, " ")
        found = pa.table([lang, phrase, pc.list_flatten(columns["counts"]).cast(pa.int64())], names=["lang", "phrase", "f"])
        nodes = found.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        nodes = nodes.filter(pc.greater_equal(nodes["f_sum"], min_count))
        return pa.table([nodes["lang"], nodes["phrase"], nodes["f_sum"]], names=["lang", "phrase", "f"])

    return build


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of phrases as ``Words.hashes`` has them; all phrases have as many words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column(0).dictionary_encode()
        words = np.concatenate([h for _, h, _ in runs(batch.column(1), _APART)]).reshape(batch.num_rows, -1)
        lang = _hash_texts(langs.dictionary)[np.asarray(langs.indices)]
        hashes = _hash(lang, [words[:, i] for i in range(words.shape[1])])
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["h"])


def _hashes(phrases: DataFrame) -> DataFrame:
    return phrases.select("lang", "phrase").mapInArrow(_hashed, "h long")


def _open_bitmap(phrases: DataFrame) -> np.ndarray:
    """The bitmap of the open branches: at most 2^20 words come to the driver."""
    slot = f"(h & {2**OPEN_BITS - 1}L)"
    words = (
        _hashes(phrases)
        .groupBy(F.expr(f"shiftright({slot}, 6)").alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits"))
    ).toArrow()
    bits = np.zeros(2 ** (OPEN_BITS - 6), np.uint64)
    bits[np.asarray(words["at"])] = np.asarray(words["bits"]).view(np.uint64)
    return bits


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text", lang_col: str = "lang", leaves: int = LEAVES) -> list[DataFrame]:
    """Tables (lang, phrase, f): all words, then the phrases of 2, 3, ... words that occur ``min_count`` times or more."""
    texts = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    partial = texts.mapInArrow(_word_counts(CHUNK_BYTES), "lang string, phrase string, f long")
    levels = [staged(partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrases-1")]
    total = levels[0].agg(F.sum("f")).first()[0] or 0
    groups = -(-total // leaves) or 1
    # Fewer than four to a group.
    heavy = np.asarray(_hashes(levels[0].where(F.col("f") > leaves // 4)).toArrow()["h"]).astype(np.int64).view(np.uint64)
    for words in range(2, max_words + 1):
        bits = _open_bitmap(levels[-1].where(F.col("f") >= min_count))
        suffixes = texts.mapInArrow(_leaves(words, bits, heavy, groups, CHUNK_BYTES), _LEAVES)
        nodes = suffixes.groupBy("grp").applyInArrow(_subtree(words, min_count), "lang string, phrase string, f long")
        levels.append(staged(nodes, f"phrases-{words}"))
    return levels


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    min_count: int = 10,
    top: int = 2000,
    inside_percent: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    leaves: int = LEAVES,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``max_words`` words.

    Texts are lower-cased in A-Z, split into pieces at ``. , ; : ! ?`` and line ends, and those into words
    at spaces and tabs. ``n`` counts a language's words, ``a`` the phrase's occurrences within pieces,
    ``l`` and ``r`` those of its two parts at the cut with the lowest score, the first of equals. The
    score is ``floor(1000000 * a * a / (l * r))``, in decimals of 38 digits, so counts may go up to 10^15.
    A phrase that lies inside a longer candidate with at least ``inside_percent`` of its occurrences
    is dropped. Order: score, then ``a``, both falling, then the phrase by its bytes.

    A null or empty text has no words, a null language is ``und``. Repeated rows and ids count as often
    as they come. Only the two named columns are read. An empty table, or one without frequent phrases,
    gives no rows. A text is worked on whole, which takes some twenty times its size in one task.
    """
    levels = phrase_counts(docs, max_words, min_count, text_col, lang_col, leaves)
    totals = levels[0].groupBy(F.col("lang").alias("t_lang")).agg(F.sum("f").alias("n"))
    counted = reduce(DataFrame.unionByName, [levels[0].where(F.col("f") >= min_count), *levels[1:-1]])
    candidates = reduce(DataFrame.unionByName, [t.withColumn("words", F.lit(i)) for i, t in enumerate(levels[1:], 2)])
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, words - 1)"))).selectExpr(
        "lang", "phrase", "f as a", "cut", "substring_index(phrase, ' ', cut) as first", "substring_index(phrase, ' ', cut - words) as rest"
    )
    first = counted.select(F.col("lang").alias("f_lang"), F.col("phrase").alias("f_phrase"), F.col("f").alias("l"))
    rest = counted.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("f").alias("r"))
    exact = "decimal(15, 0)"
    scored = (
        cuts.join(first, (F.col("lang") == F.col("f_lang")) & (F.col("first") == F.col("f_phrase")))
        .join(rest, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
        .withColumn(
            "score",
            F.expr(f"(cast(a as {exact}) * cast(a as {exact}) * cast(1000000 as decimal(7, 0))) div (cast(l as {exact}) * cast(r as {exact}))"),
        )
        .groupBy("lang", "phrase", "a")
        .agg(F.expr("min(struct(score, cut, l, r))").alias("best"))
        .select("lang", "phrase", "a", "best.score", "best.l", "best.r")
    )
    inner = candidates.where("words > 2").selectExpr(
        "lang as i_lang",
        "f as longer",
        "explode(flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), "
        "s -> array_join(slice(split(phrase, ' '), s, k), ' '))))) as i_phrase",
    )
    longest = inner.groupBy("i_lang", "i_phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longest, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")), "left").where(
        f"longer is null or 100 * longer < {inside_percent} * a"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("t_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
