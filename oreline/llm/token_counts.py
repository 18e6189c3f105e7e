"""Token counts through a digest cache.

A text's key is the SHA-256 of its content and the version of the tokenizer (its file and library).
Keys are joined to the counts stored so far; only distinct missing contents are encoded, and their
counts are appended to the cache, so a corpus that changes a little costs a little.

The content is normalised only as far as no tokenizer could see: null counts as empty. Anything more
(case, white space, Unicode forms) would change the count.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.paths import exists

CACHE_SCHEMA = "digest binary, version string, n_tokens long"
#: Pieces remembered by one Python worker, and the longest that is remembered: some 100 MB.
MEMO_PIECES, MEMO_CHARS = 400_000, 48
# White space as the byte-level pre-tokenizer has it: Python's, without the four separators 1C to 1F.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def tokenizer_version(definition: str) -> str:
    import tokenizers

    return f"{hashlib.sha256(definition.encode()).hexdigest()}:tokenizers-{tokenizers.__version__}"


def counter(definition: str) -> Callable[[str], int]:
    """The number of tokens of a text, without added special tokens.

    A byte-level pre-tokenizer never joins a word with the white space after it, so a text may be cut
    there: pieces that occur again and again are encoded once. Any other kind of tokenizer, and a text
    that holds one of its special strings, is encoded whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer, spec = Tokenizer.from_str(definition), json.loads(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    pre = spec.get("pre_tokenizer") or {}
    local = (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
    )
    added = [t["content"] for t in spec.get("added_tokens") or []]
    memo: dict[str, int] = {}

    def whole(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    def count(text: str) -> int:
        if not local or any(a in text for a in added):
            return whole(text)
        pieces = Counter(_PIECE.findall(text))
        new = [p for p in pieces if p not in memo]
        if new:
            if len(memo) > MEMO_PIECES:
                memo.clear()
                new = list(pieces)
            memo.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        total = sum(memo[p] * n for p, n in pieces.items())
        for p in new:
            if len(p) > MEMO_CHARS:
                del memo[p]
        return total

    return count


def token_counts(docs: DataFrame, definition: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``definition`` is the text of a tokenizer's JSON file; ``cache_path`` a Parquet table that is made
    if it does not exist. A null text counts as empty (0 tokens); repeated rows and ids stay; an empty
    table gives none; only the two named columns are read, so others cannot clash. Within one call
    every distinct content is encoded once: the row with the smallest id stands for its copies, so a
    text that fills a third of the table is one row of work. A failed call appends nothing.
    """
    spark, version = docs.sparkSession, tokenizer_version(definition)
    content = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = content.withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path) if exists(spark, cache_path) else spark.createDataFrame([], CACHE_SCHEMA)
    missing = (
        keyed.groupBy("digest")
        .agg(F.min("id").alias("leader"))
        .join(stored.where(F.col("version") == version).select("digest"), "digest", "left_anti")
    )
    # The digest and the id together spread the copies of a text over all tasks.
    leaders = missing.withColumnRenamed("digest", "key").hint("shuffle_hash")
    texts = keyed.join(
        leaders, (F.col("digest") == F.col("key")) & F.col("id").eqNullSafe(F.col("leader"))
    ).select("digest", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(definition)
        for batch in batches:
            texts = batch.column("text")
            counts = pa.array((count(t.as_py()) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(counts), pa.string()), counts],
                ["digest", "version", "n_tokens"],
            )

    texts.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache_path)
        .where(F.col("version") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return (
        keyed.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
        .join(counts, "digest")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
    )
