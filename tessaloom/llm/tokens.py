"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary as ranks, and the pattern that parts a text before merging; both are parameters.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _encoding(path: str, pattern: str):  # type: ignore[no-untyped-def]
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    return tiktoken.Encoding("tessaloom", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _count(vocabulary: str, pattern: str):  # type: ignore[no-untyped-def]
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, names = None, None
        for batch in batches:
            encoding = encoding or _encoding(vocabulary, pattern)
            names = names or [n for n in batch.schema.names if n != "_text"]
            # long texts are encoded in parts that end before a blank, which the pattern never joins to what is before it
            sizes = [None if t is None else sum(len(encoding.encode_ordinary(part)) for part in _parts(t)) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(sizes, pa.int64())], [*names, "tokens"])

    return count


def _parts(text: str, size: int = 100_000) -> list[str]:
    if len(text) <= size:
        return [text]
    out, start = [], 0
    boundary = re.compile(r"(?<=\S)(?= \S)")
    while len(text) - start > size:
        found = boundary.search(text, start + size)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


def sized(df: DataFrame, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """The columns of `keep` and `tokens`, the number of tokens of the text; null for null."""
    rows = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_count(vocabulary, pattern), f"{schema}, tokens bigint")
