"""Encoding of a whole corpus with a public tokenizer.

Method: the tiktoken library with a local rank file; long texts are split before
encoding where the tokenizer's own pattern always ends a piece, so the ids are
those of the whole text; ids are decoded to raw bytes.

The rank file is read on the driver from ``tokenizers`` (a folder, a parameter)
and broadcast: it is one file of fixed size, which is checked.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.session import spread

TOKENIZERS = "/opt/tokenizers"
RANK_FILE = "byte_bpe_50k.tiktoken"
RANK_BYTES = 16 << 20
# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts above this length are split first.
LONG = 8_192
#: A piece always ends before a single blank between other characters, and between a letter or digit and a mark.
SAFE = regex.compile(r"(?<=\S)(?= \S)|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])")

_encodings: dict[int, tiktoken.Encoding] = {}


def read_ranks(tokenizers: str = TOKENIZERS, name: str = RANK_FILE) -> bytes:
    with open(os.path.join(tokenizers, name), "rb") as f:
        data = f.read(RANK_BYTES + 1)
    if len(data) > RANK_BYTES:
        raise ValueError(f"{name} is larger than {RANK_BYTES} bytes")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def encoding(data: bytes) -> tiktoken.Encoding:
    """The encoding of a rank file, made once in each process."""
    key = hash(data)
    if key not in _encodings:
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=parse_ranks(data), special_tokens={})
    return _encodings[key]


def safe_parts(text: str, size: int = LONG) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut at safe boundaries only; a stretch without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str | None) -> np.ndarray:
    if not text:
        return np.empty(0, np.uint32)
    if len(text) <= LONG:
        return enc.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([enc.encode_to_numpy(part, disallowed_special=()) for part in safe_parts(text)])


def _encoded(spark: SparkSession, tokenizers: str, name: str, lengths: bool):
    ranks = spark.sparkContext.broadcast(read_ranks(tokenizers, name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value)
        for batch in batches:
            ids = [encode_text(enc, t) for t in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            if lengths:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes)], names=["doc_id", "n_tokens"])
            else:
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return run


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, name: str = RANK_FILE) -> DataFrame:
    """(doc_id, ids): one row for each row of ``df``; empty and null texts have an empty list.  Strings of special tokens are ordinary text."""
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return spread(source).mapInArrow(_encoded(df.sparkSession, tokenizers, name, False), f"doc_id {kind}, ids array<int>").withColumnRenamed("doc_id", doc_id)


def token_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, name: str = RANK_FILE) -> DataFrame:
    """(doc_id, n_tokens): the length in tokens of each row's text; 0 for empty and null texts."""
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return spread(source).mapInArrow(_encoded(df.sparkSession, tokenizers, name, True), f"doc_id {kind}, n_tokens bigint").withColumnRenamed("doc_id", doc_id)


def decode(df: DataFrame, doc_id: str = "doc_id", ids: str = "ids", tokenizers: str = TOKENIZERS, name: str = RANK_FILE) -> DataFrame:
    """(doc_id, raw): the bytes that the ids stand for.  Null lists give null; an id outside the vocabulary is an error."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(tokenizers, name))
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value)
        for batch in batches:
            raw = [None if x is None else enc.decode_bytes(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "raw"])

    return source.mapInArrow(run, f"doc_id {kind}, raw binary").withColumnRenamed("doc_id", doc_id)
