"""Encoding of a corpus with a public tokenizer through a table of distinct words.

Texts are split into words by the tokenizer's own pattern in the JVM. A chunk of documents becomes a dictionary of its words and the
positions of its documents' words in it, so words travel once a chunk, not once an occurrence. Each distinct word of the corpus is encoded
once; its ids are joined back to every dictionary entry and put in place by position. Decoding goes the same way, through a join of the ids
in a chunk's dictionary with the table of pieces. The vocabulary file is a parameter; only the driver reads it.
"""

from __future__ import annotations

import base64
import math
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.plans.scratch import Scratch

VOCABULARY = os.environ.get("SIEVEWORK_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the published word pattern of the 50k byte-level vocabulary. White space is Unicode's property White_Space.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
#: Documents and bytes of words in a chunk at most; a larger document is a chunk of its own.
CHUNK, CHUNK_BYTES = 1000, 8 << 20
#: Words that are in more than one of so many dictionary entries are sent to all tasks, there are fewer of them than that; longer ones are not.
COMMON, COMMON_CHARS = 1 << 15, 64


def ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def _encoder(pieces: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=pieces, special_tokens={})  # a word is encoded whole


def _chunked(lists: DataFrame, kind: str) -> DataFrame:
    """(chunk, keys, sizes, codes, items) of (key, list of ``kind``): the different items of a chunk, and for each document the number of
    its items (-1 for a null list) and their positions among them."""

    def run(batches):
        from uuid import uuid4

        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for batch in batches:
            items = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False)
            flat = items.flatten()
            width = pc.binary_length(flat).to_numpy(zero_copy_only=False) if kind == "string" else np.full(len(flat), 4)
            ends = np.cumsum(sizes)
            bytes_up_to = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[ends]
            lo = 0
            while lo < batch.num_rows:
                before = bytes_up_to[lo - 1] if lo else 0
                hi = max(lo + 1, min(lo + CHUNK, int(np.searchsorted(bytes_up_to, before + CHUNK_BYTES, side="right"))))
                part = items.slice(lo, hi - lo)
                coded = part.flatten().dictionary_encode(null_encoding="encode")
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
                counts = pc.fill_null(pc.list_value_length(part), -1).cast(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([uuid4().hex]), one(batch.column(0).slice(lo, hi - lo)), one(counts), pa.array([codes.tobytes()], pa.binary()), one(coded.dictionary)], ["chunk", "keys", "sizes", "codes", "items"])
                lo = hi

    return lists.mapInArrow(run, f"chunk string, keys array<bigint>, sizes array<int>, codes binary, items array<{kind}>")


def _placed(chunks: DataFrame, entries: DataFrame, kind: str, join) -> DataFrame:
    """(key, value, missing): the values of (chunk, pos, value) in the places of the items; ``join`` makes the column of values of a
    document's many. Where the list was null, it is missing."""
    packed = entries.groupBy("chunk").agg(F.collect_list(F.struct("pos", "value")).alias("entries"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, sizes, codes, found = (batch.column(c)[i] for c in range(4))
                sizes = sizes.values.to_numpy()
                at = np.frombuffer(codes.as_py(), dtype=np.int32)
                values = found.values.field("value").take(pa.array(np.argsort(found.values.field("pos").to_numpy(), kind="stable"))) if found.is_valid else None
                ends = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
                yield pa.RecordBatch.from_arrays([keys.values, join(values, at, ends), pa.array(sizes < 0)], ["key", "value", "missing"])

    joined = chunks.select("chunk", "keys", "sizes", "codes").join(packed, "chunk", "left").select("keys", "sizes", "codes", "entries")
    return joined.mapInArrow(run, f"key bigint, value {kind}, missing boolean")


def _joined_ids(values, at: np.ndarray, ends: np.ndarray) -> pa.Array:
    if values is None or not len(at):
        n, flat = np.zeros(0, dtype=np.int64), pa.array([], pa.int32())
    else:
        taken = values.take(pa.array(at))
        n, flat = pc.list_value_length(taken).to_numpy(zero_copy_only=False).astype(np.int64), taken.flatten()
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)])[ends].astype(np.int32)), flat)


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids, missing): the ids of every row's text, without special tokens; strings of special tokens are ordinary text.

    Null, empty and null-key rows are kept: the ids of a null and of an empty text are an empty array, and missing tells the null. Repeated
    rows are rows. A word that is in the dictionaries of very many chunks is joined by broadcast (a bounded number of words), the others by
    a shuffle, so no common word is one task's work.
    """
    spark, scratch = documents.sparkSession, Scratch(documents.sparkSession, "tokens")
    lists = documents.select(F.col(key).cast("bigint"), F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0)))
    chunks = scratch.write(_chunked(lists, "string"), "chunks")
    pieces = spark.sparkContext.broadcast(ranks(vocabulary))

    def run(batches):
        enc = _encoder(pieces.value)
        for batch in batches:
            ids = enc.encode_ordinary_batch(batch.column(0).to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["word", "n", "ids"])

    entries = chunks.select("chunk", F.posexplode("items").alias("pos", "word"))
    counted = entries.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = scratch.write(counted.mapInArrow(run, "word string, n bigint, ids array<int>"), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = (F.col("n") > max(1, math.ceil(total / COMMON))) & (F.length("word") <= COMMON_CHARS)
    often = F.broadcast(words.where(common).select("word", "ids"))
    tried = entries.join(often, "word", "left")
    rare = tried.where("ids is null").drop("ids").join(words.where(~common).select("word", "ids"), "word")
    placed = tried.where("ids is not null").unionByName(rare).select("chunk", "pos", F.col("ids").alias("value"))
    return _placed(chunks, placed, "array<int>", _joined_ids).withColumnsRenamed({"key": key, "value": "ids"})


def _joined_text(values, at: np.ndarray, ends: np.ndarray) -> pa.Array:
    taken = pc.fill_null(values.take(pa.array(at)), b"") if values is not None else pa.array([], pa.binary())
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), taken), b"")
    try:
        return whole.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())


def decode(encoded: DataFrame, key: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text): the texts behind (key, ids), through a join of ids with pieces.

    The different ids of a chunk of documents are joined with the table (id, piece), which has the fixed size of the vocabulary and is
    broadcast; the pieces are put in place by position. No ids give an empty text; null ids, and rows that are ``missing`` if there is such
    a column, a null one. Ids outside the vocabulary stand for nothing, and bytes that are no UTF-8 for the replacement character.
    """
    spark, scratch = encoded.sparkSession, Scratch(encoded.sparkSession, "pieces")
    ids = F.when(F.col("missing"), F.lit(None)).otherwise(F.col("ids")) if "missing" in encoded.columns else F.col("ids")
    chunks = scratch.write(_chunked(encoded.select(F.col(key).cast("bigint"), ids.cast("array<int>")), "int"), "chunks")
    pieces = spark.createDataFrame([(i, bytearray(p)) for p, i in ranks(vocabulary).items()], "id int, value binary")
    entries = chunks.select("chunk", F.posexplode("items").alias("pos", "id")).join(F.broadcast(pieces), "id", "left").select("chunk", "pos", "value")
    texts = _placed(chunks, entries, "string", _joined_text)
    return texts.select(F.col("key").alias(key), F.when(~F.col("missing"), F.col("value")).alias("text"))
