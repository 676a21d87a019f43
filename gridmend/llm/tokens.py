"""Token counts by a public tokenizer file, in Arrow batches."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.cols import ref

#: The splitting pattern that the byte-level vocabulary was published with.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT = os.environ.get("GRIDMEND_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
_encodings: dict = {}


def encoding(path: str):
    """One encoder a process and file."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encodings[path] = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def pieces(path: str, text: str, memo: dict[str, int]) -> int:
    """Tokens of a text. Lines are counted apart and remembered, so repeated passages cost nothing.

    A cut before a line break is one the pattern makes itself unless white space surrounds it, so text is cut only between a non-space and a
    break that a non-space follows; the sum equals the count of the whole text.
    """
    total, start, n = 0, 0, len(text)
    while start < n:
        end = text.find("\n", start + 1)
        while end != -1 and (end + 1 >= n or text[end - 1].isspace() or text[end + 1].isspace()):
            end = text.find("\n", end + 1)
        part = text[start:] if end == -1 else text[start:end]
        got = memo.get(part)
        if got is None:
            got = memo[part] = len(encoding(path).encode_ordinary(part))
        total += got
        start = n if end == -1 else end
    return total


def with_tokens(df: DataFrame, row_id: str, text: str, path: str = DEFAULT, memory: int = 200_000) -> DataFrame:
    """(row_id, n_tokens): tokens of each text; null text has 0. memory bounds the lines remembered a task; it changes no result."""
    src = df.select(ref(row_id).alias("id"), ref(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for b in batches:
            counts = []
            for t in b.column(1).to_pylist():
                if len(memo) > memory:
                    memo.clear()
                counts.append(pieces(path, t, memo) if t else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["id", "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_tokens bigint").select(F.col("id").alias(row_id), "n_tokens")
