"""Packing documents into windows of tokens, each one around a seed and its lexical neighbours.

1. Texts become token ids. What fills whole windows on its own is a sequence as it is; the rest of each
   document, its tail, is packed with others.
2. Terms are token ids, so there are as many as the tokenizer has. Their document frequencies and the
   mean length are taken over all documents.
3. The index is sharded. A tail's place is its most telling term (highest tf * idf), and a hash of its
   row within that term; places are weighed by tokens and cut into shards of ``SHARD_TOKENS``. A term that
   a third of all tails share makes many shards, and all shards are about equal.
4. A task builds the inverted index of a shard. A seed's strongest terms are looked up; unused tails fill
   the seed's window in the order of their BM25 scores. One that does not fit is passed over as long as
   another does; when none fits, the best is cut, and its remainder is the next seed. So every
   window but the last of a shard is full. That one is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import staged
from oreline.llm.words import _buffers, mix

WINDOW = 4096
#: The id that ends each document.
END = 2
#: Tokens of the tails that are indexed together: some 500 windows.
SHARD_TOKENS = 1 << 21
#: Terms of a seed that are looked up, and neighbours that are ranked, as "more like this" searches have them.
QUERY_TERMS, NEIGHBOURS = 32, 64
K1, B = 1.2, 0.75
#: Bytes of text that are encoded together; a longer text is taken whole.
CHUNK_BYTES = 8 << 20
#: Words remembered by one Python worker, and the longest that is remembered.
MEMO_WORDS, MEMO_CHARS = 600_000, 48

#: Pieces handed on at once.
WHOLE_ROWS = 256

#: Words that are encoded as one text, which costs half of encoding each by itself.
JOINED = 200

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# What a byte is: 0 white space, 1 letter or digit, 2 a mark that a word may be cut at, 3 anything else.
_MARKS = b".,;:!?"
_KINDS = np.array([0 if b == 0x20 or 0x09 <= b <= 0x0D else 2 if b in _MARKS else 1 if b < 128 and chr(b).isalnum() else 3 for b in range(256)], np.uint8)
_TOKENS = 1 << 21
#: Terms of a seed that are looked up, and neighbours that are ranked, as "more like this" searches have them.
QUERY_TERMS, NEIGHBOURS = 32, 64
K1, B = 1.2, 0.75
#: Bytes of text that are encoded together; a longer text is taken whole.
CHUNK_BYTES = 8 << 20
#: Words remembered by one Python worker, and the longest that is remembered.
MEMO_WORDS, MEMO_CHARS = 600_000, 48

#: Pieces handed on at once.
WHOLE_ROWS = 256

_BLANK = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b for b in range(256))
_TOKENS = "doc_id {id}, row long, first_window long, doc_tokens long, ids binary"
_TAILS = "doc_id {id}, row long, start long, doc_tokens long, shard long, place long, ids binary"
PIECES = "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer's ids of a text are those of its words, one after the other.

    So if its normalizer looks at single characters (white space, case) or composes, which white space has
    no part in, and its pre-tokenizer takes matches that never hold white space, nor a letter or digit next to
    one of the marks that words are cut at, and nothing between them.
    """
    import regex

    normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    pre = spec.get("pre_tokenizer") or {}
    steps = normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]
    first = (pre.get("pretokenizers") or [pre])[0]
    if any(s["type"] not in ("NFC", "Lowercase", "Replace") for s in steps) or first.get("type") != "Split":
        return False
    if any(s["type"] == "Replace" and s["pattern"] != {"Regex": "\\s+"} for s in steps):
        return False
    if first["behavior"] != "Removed" or not first["invert"] or "Regex" not in first["pattern"]:
        return False
    added = [t["content"] for t in spec.get("added_tokens") or []]
    matches = regex.findall(first["pattern"]["Regex"], "a b\t1\n!\r's \x0b-\x0c a.b 1,2 c;! ?d 'll:m")
    mixed = regex.compile(r"\s|[A-Za-z0-9][.,;:!?]|[.,;:!?][A-Za-z0-9]")
    return not any(mixed.search(m) for m in [*matches, *added])


class Encoder:
    """Token ids of texts. Words that occur again are encoded once."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = splits_at_blanks(spec)
        normalizer = spec.get("normalizer") or {}
        self.lowers = any(s.get("type") == "Lowercase" for s in normalizer.get("normalizers", [normalizer]))
        # Which ids end a word, where the vocabulary says so.
        suffix = spec["model"].get("end_of_word_suffix")
        vocabulary = spec["model"]["vocab"]
        self.ends = np.zeros(1 + max([END, *vocabulary.values(), *(t["id"] for t in spec.get("added_tokens") or [])]), bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.memo: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters: each is one match of the pre-tokenizer, so it has one id that ends it."""
        for at in range(0, len(words), JOINED):
            part = words[at : at + JOINED]
            ids = np.array(self._encode([" ".join(part)])[0], np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                yield from (ids[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops))
            else:
                yield from self._single(part)

    def _single(self, words: list[str]) -> Iterator[bytes]:
        return (np.array(ids, np.uint32).tobytes() for ids in self._encode(words))

    def _words(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.memo]
        plain = [w for w in new if w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w)]
        fresh = dict(zip(plain, self._joined(plain)))
        other = [w for w in new if w not in fresh]
        fresh.update(zip(other, self._single(other)))
        room = MEMO_WORDS - len(self.memo)
        self.memo.update(itertools.islice(((w, ids) for w, ids in fresh.items() if len(w) <= MEMO_CHARS), max(0, room)))
        return [fresh[w] if w in fresh else self.memo[w] for w in words]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each text followed by ``END``; where each text's ids end)."""
        if not self.by_word:
            lists = [[*ids, END] for ids in self._encode(texts.to_pylist())]
            return np.fromiter(itertools.chain.from_iterable(lists), np.uint32), np.cumsum([len(x) for x in lists])
        offsets, data = _buffers(texts)
        bounds = offsets - offsets[0]
        raw = data[offsets[0] : offsets[-1]].tobytes()
        if self.lowers and b"<" not in raw:
            # Not where a special token may stand: their case counts.
            raw = raw.translate(_LOWER)
        own = np.insert(np.frombuffer(raw, np.uint8), bounds[1:], 0x20)
        bounds = bounds + np.arange(len(bounds))
        kinds = _KINDS[own]
        before, after = np.insert(kinds, 0, 0), np.append(kinds, 0)
        cuts = np.flatnonzero((before != after) & ((before == 0) | (after == 0) | (before + after == 3))).astype(np.int64)
        if not len(cuts):
            return np.full(len(texts), END, np.uint32), np.arange(1, len(texts) + 1)
        # Everything between two cuts as one array of texts, of which white space is left out.
        both = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(own))
        taken = np.flatnonzero(kinds[cuts[:-1]])
        words = both.take(pa.array(taken)).dictionary_encode()
        code, lists = np.asarray(words.indices).astype(np.int64), self._words(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(lists), np.uint32)
        size = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        begin = np.cumsum(size) - size
        count = size[code]
        ends = np.cumsum(count)
        ids = flat[np.repeat(begin[code] - (ends - count), count) + np.arange(ends[-1])]
        # A text's ids end where those of its last word do.
        last = np.searchsorted(cuts[taken], bounds[1:])
        stops = np.concatenate([[0], ends])[last]
        return np.insert(ids, stops, END), stops + np.arange(1, len(stops) + 1)


@functools.lru_cache(maxsize=1)
def encoder_of(definition: str) -> Encoder:
    """One encoder for all tasks of a Python worker: its words stay remembered."""
    return Encoder(definition)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ``values`` up to each of ``ends``, as binaries."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])
    return pa.array([values[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)], pa.binary())


def _ids(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    """The ids of each row, without a copy."""
    whole = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return [whole[a:b].view(kind) for a, b in zip(offsets, offsets[1:])]


def _tokens(definition: str, kind: np.dtype, window: int, limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition)
        number, windows = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            sizes = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
                ids, ends = encoder.texts(texts.slice(at, stop - at))
                counts = np.diff(ends, prepend=0)
                whole = np.cumsum(counts // window)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, stop - at),
                        pa.array(number + np.arange(stop - at)),
                        pa.array(windows + whole - counts // window),
                        pa.array(counts),
                        _binary(ids.astype(kind), ends),
                    ],
                    names=["doc_id", "row", "first_window", "doc_tokens", "ids"],
                )
                number, windows, at = number + stop - at, windows + int(whole[-1]), stop

    return task


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, sorted, and how often each occurs. Short integers are sorted by their digits, in one go."""
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    ordered = np.sort(ids, kind="stable")
    inner = np.flatnonzero(ordered[1:] != ordered[:-1])
    last = np.empty(len(inner) + 1, np.int64)
    last[:-1], last[-1] = inner, len(ids) - 1
    counts = last.copy()
    counts[1:] -= inner
    counts[0] += 1
    return ordered[last], counts


def _sums(name: str, pairs: dict[int, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"term": pa.array(pairs, pa.int64()), name: pa.array(pairs.values(), pa.int64())})


def _frequencies(kind: np.dtype, terms: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows, tokens = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            for ids in _ids(batch.column(0), kind):
                found[distinct(ids[:-1])[0]] += 1
                rows, tokens = rows + 1, tokens + len(ids)
        used = np.flatnonzero(found)
        yield _sums("value", dict(zip(used.tolist(), found[used].tolist())) | {-1: rows, -2: tokens})

    return task


class Weights:
    """What BM25 knows of the corpus: the weight of each term, and the mean length."""

    def __init__(self, frequencies: dict[int, int], terms: int) -> None:
        rows, tokens = frequencies.get(-1, 0), frequencies.get(-2, 0)
        found = np.zeros(terms)
        for term, value in frequencies.items():
            if term >= 0:
                found[term] = value
        self.idf = np.log1p((rows - found + 0.5) / (found + 0.5)).astype(np.float32)
        self.mean = max(1.0, tokens / max(1, rows))

    def terms(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct terms of a tail (its end is none) and how telling each one is."""
        return distinct(ids[:-1])

    def telling(self, ids: np.ndarray) -> int:
        terms, tf = self.terms(ids)
        return int(terms[np.argmax(tf * self.idf[terms])]) if len(terms) else -1


def _tails(batch: pa.RecordBatch, kind: np.dtype, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row of the batch, start, ids) of what does not fill windows of its own."""
    for i, ids in enumerate(_ids(batch.column(batch.schema.get_field_index("ids")), kind)):
        start = len(ids) // window * window
        if start < len(ids):
            yield i, start, ids[start:]


def _masses(kind: np.dtype, window: int, weights: Weights):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass: dict[int, int] = {}
        for batch in batches:
            for _, _, ids in _tails(batch, kind, window):
                term = weights.telling(ids)
                mass[term] = mass.get(term, 0) + len(ids)
        yield _sums("value", mass)

    return task


def _placed(kind: np.dtype, window: int, weights: Weights, masses: dict[int, int], shard_tokens: int):
    names = sorted(masses)
    ends = dict(zip(names, itertools.accumulate(masses[t] for t in names)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_tails(batch, kind, window))
            if not found:
                continue
            rows = pa.array([i for i, _, _ in found], pa.int64())
            number = batch.column(1).take(rows)
            share = mix(np.asarray(number).astype(np.uint64)).astype(float) / 2.0**64
            terms = [weights.telling(ids) for _, _, ids in found]
            place = [ends[t] - masses[t] + int(u * masses[t]) for t, u in zip(terms, share)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    number,
                    pa.array([start for _, start, _ in found], pa.int64()),
                    batch.column(3).take(rows),
                    pa.array([p // shard_tokens for p in place], pa.int64()),
                    pa.array(place, pa.int64()),
                    _binary(np.concatenate([ids for _, _, ids in found]), np.cumsum([len(ids) for _, _, ids in found])),
                ],
                names=["doc_id", "row", "start", "doc_tokens", "shard", "place", "ids"],
            )

    return task


class Index:
    """Inverted index of a shard's tails: the BM25 weight of each term in each tail."""

    def __init__(self, tails: list[np.ndarray], weights: Weights) -> None:
        found = [weights.terms(ids) for ids in tails]
        self.own = found
        self.weights = weights
        terms = np.concatenate([t for t, _ in found])
        tails_of = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
        tf = np.concatenate([c for _, c in found]).astype(np.float32)
        length = np.array([len(ids) for ids in tails], np.float32)[tails_of]
        score = weights.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / np.float32(weights.mean)))
        order = np.argsort(terms, kind="stable")
        self.terms, first = np.unique(terms[order], return_index=True)
        self.bounds = np.append(first, len(order))
        self.tails, self.scores = tails_of[order], score[order]
        self.size = len(tails)

    def neighbours(self, seed: int, unused: np.ndarray) -> list[int]:
        """Unused tails that share the seed's strongest terms, best first."""
        terms, tf = self.own[seed]
        strongest = terms[np.argsort(-tf * self.weights.idf[terms], kind="stable")[:QUERY_TERMS]]
        total = np.zeros(self.size, np.float32)
        for at in np.searchsorted(self.terms, strongest):
            part = slice(self.bounds[at], self.bounds[at + 1])
            total[self.tails[part]] += self.scores[part]
        total[~unused] = 0
        best = np.argsort(-total, kind="stable")[:NEIGHBOURS] if self.size <= NEIGHBOURS else np.argpartition(-total, NEIGHBOURS - 1)[:NEIGHBOURS]
        best = best[total[best] > 0]
        return best[np.lexsort((best, -total[best]))].tolist()


Part = tuple[int, int, int]


def fill(tails: list[np.ndarray], weights: Weights, window: int) -> Iterator[list[Part]]:
    """Windows of parts (tail, from, to). All are full but the last, which is cut into powers of two."""
    index = Index(tails, weights)
    size = [len(ids) for ids in tails]
    at = [0] * len(tails)
    unused = np.ones(len(tails), bool)
    following, seed = 0, None

    def next_unused() -> int | None:
        nonlocal following
        while following < len(tails) and not unused[following]:
            following += 1
        return following if following < len(tails) else None

    while seed is not None or (seed := next_unused()) is not None:
        parts: list[Part] = []
        room = window

        def take(tail: int) -> bool:
            """Use a tail as far as there is room; whether something of it is left."""
            nonlocal room
            stop = min(size[tail], at[tail] + room)
            parts.append((tail, at[tail], stop))
            room -= stop - at[tail]
            at[tail] = stop
            unused[tail] = False
            return stop < size[tail]

        rest = seed if take(seed) else None
        ranked = index.neighbours(seed, unused) if room else []
        while room:
            fits = next((t for t in ranked if size[t] <= room), None)
            tail = fits if fits is not None else ranked[0] if ranked else next_unused()
            if tail is None:
                break
            if tail in ranked:
                ranked.remove(tail)
            if take(tail):
                rest = tail
        seed = rest
        if room:
            yield from _powers(parts, window - room)
        else:
            yield parts


def _powers(parts: list[Part], length: int) -> Iterator[list[Part]]:
    """Parts cut into sequences whose lengths are powers of two, the longest first."""
    parts = parts[::-1]
    while length:
        room = 1 << (length.bit_length() - 1)
        length -= room
        piece: list[Part] = []
        while room:
            tail, start, stop = parts.pop()
            cut = min(stop, start + room)
            piece.append((tail, start, cut))
            room -= cut - start
            if cut < stop:
                parts.append((tail, cut, stop))
        yield piece


def _packed(kind: np.dtype, window: int, weights: Weights, most: int):
    """Tails in the order of their shards -> pieces. ``most`` tokens are held; a shard beyond that is packed in turns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, used = None, 0
        held: list[tuple] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, used
            if not held:
                return
            tails = [ids for _, _, _, ids in held]
            rows, ids = [], []
            for parts in fill(tails, weights, window):
                offset = 0
                for tail, start, stop in parts:
                    doc, first, count, own = held[tail]
                    rows.append((doc, first + start, stop - start, count, (shard << 32) + used, offset))
                    ids.append(own[start:stop])
                    offset += stop - start
                used += 1
            yield _pieces(rows, ids, batch.schema.field("doc_id").type)
            held, tokens = [], 0

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "start", "doc_tokens", "shard")]
            for doc, start, count, own, ids in zip(*columns, _ids(batch.column(batch.schema.get_field_index("ids")), kind)):
                if own != shard or tokens >= most:
                    yield from flush()
                    used = used if own == shard else 0
                    shard = own
                held.append((doc, start, count, ids.copy()))
                tokens += len(ids)
        yield from flush()

    return task


def _pieces(rows: list[tuple], ids: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows))
    longs = [pa.array(c, pa.int64()) for c in columns[1:]]
    binary = _binary(np.concatenate(ids).astype("<u4"), np.cumsum([len(x) for x in ids]))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind), *longs, binary],
        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def _whole_windows(kind: np.dtype, window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            doc_kind = batch.schema.field("doc_id").type
            rows, pieces = [], []
            for doc, row, first, count, ids in zip(*columns, _ids(batch.column(4), kind)):
                number = 2**62 + (row >> 40 << 40) + first
                for i, start in enumerate(range(0, len(ids) // window * window, window)):
                    rows.append((doc, start, window, count, number + i, 0))
                    pieces.append(ids[start : start + window])
                    if len(rows) == WHOLE_ROWS:
                        yield _pieces(rows, pieces, doc_kind)
                        rows, pieces = [], []
            if rows:
                yield _pieces(rows, pieces, doc_kind)

    return task


def pack_documents(
    docs: DataFrame,
    definition: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: id, ``start`` (the document's ids before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence, and ``ids``, its token ids as little-endian 32-bit numbers.

    ``definition`` is the tokenizer's file. Each row's ids, with ``END`` behind, lie in pieces without gap
    or overlap; each sequence's pieces lie gapless from offset 0. A sequence has ``window`` ids, or a power
    of two below that at the end of a shard. A null or empty text is its end alone. Repeated rows and ids
    are documents of their own; a null id stays null. Only the two named columns are read. An empty table
    gives no rows. Two runs may cut differently; a lost executor's tasks repeat what they did.

    Ids are stored once and tails shuffled once; a task holds a shard (8 MB of ids and an index of about ten times that).
    """
    spec = json.loads(definition)
    added = [t["id"] for t in spec.get("added_tokens") or []]
    terms = 1 + max([END, *added, *spec["model"]["vocab"].values()])
    kind = np.dtype("<u2" if terms <= 1 << 16 else "<u4")
    name = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tokens = staged(texts.mapInArrow(_tokens(definition, kind, window, CHUNK_BYTES), _TOKENS.format(id=name)), "tokens")

    def summed(partial: DataFrame) -> dict[int, int]:
        # A row per term of the tokenizer at most.
        return {r["term"]: r["value"] for r in partial.groupBy("term").agg(F.sum("value").alias("value")).collect()}

    weights = Weights(summed(tokens.select("ids").mapInArrow(_frequencies(kind, terms), "term long, value long")), terms)
    masses = summed(tokens.select("ids").mapInArrow(_masses(kind, window, weights), "term long, value long"))
    tails = tokens.mapInArrow(_placed(kind, window, weights, masses, shard_tokens), _TAILS.format(id=name))
    shards = tails.repartition("shard").sortWithinPartitions("shard", "place", "row")
    pieces = PIECES.format(id=name)
    packed = shards.mapInArrow(_packed(kind, window, weights, 2 * shard_tokens), pieces)
    whole = tokens.where(F.col("doc_tokens") >= window).mapInArrow(_whole_windows(kind, window), pieces)
    return packed.unionByName(whole).withColumnRenamed("doc_id", id_col)
