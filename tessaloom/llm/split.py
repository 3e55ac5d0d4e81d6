"""Problem 6: oversized items split at natural boundaries."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where a text may be cut, strongest first: after what matches. Any other place has strength 1, inside of one seen character 0.
BOUNDARIES = (
    (7, re.compile(r"\n[^\S\n]*\n\s*")),
    (6, re.compile(r"\n\s*")),
    (5, re.compile(r"[.!?…。！？]+[\"'”’»)\]]*\s+|[。！？]")),
    (4, re.compile(r"[;:,،、]\s+|\s[–—]\s")),
    (3, re.compile(r"\s+")),
    (2, re.compile(r"[^\w\s]+(?=\w)")),
)
COLUMNS = ("piece_no bigint", "piece_total bigint", "start bigint", "piece string")


def strengths(text: str) -> np.ndarray:
    """The strength of a cut before each position, 0 to len(text)."""
    out = np.ones(len(text) + 1, np.int64)
    if not text.isascii():
        for m in re.finditer(r"[^\x00-\x7f]", text):
            if unicodedata.combining(m.group()) or m.group() in "‍️":
                out[m.start()] = 0
    for strength, pattern in reversed(BOUNDARIES):
        at = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
        out[at] = np.maximum(out[at], strength)
    return out


class RangeMaximum:
    """Sparse table: level k has the best of each 2**k places. Of equal strength the rightmost is best."""

    def __init__(self, values: np.ndarray, widest: int) -> None:
        n = len(values)
        self.levels = [values * (n + 1) + np.arange(n)]
        self.n = n
        while 2 ** len(self.levels) <= min(widest, n):
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.maximum(last[:-half], last[half:]))

    def best(self, first: int, last: int) -> int:
        k = (last - first + 1).bit_length() - 1
        level = self.levels[k]
        return int(max(level[first], level[last + 1 - 2**k]) % (self.n + 1))


def cuts(text: str, most: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces: each at most `most` long, each beginning `overlap` before the end of the one before.

    The end is the strongest boundary among the lengths from half the limit
    (and more than twice the overlap, if the limit allows) up to it.
    """
    if most < 1 or len(text) <= most:
        return [(0, len(text))]
    overlap = max(0, min(overlap, most - 1))
    least = max(overlap + 1, min(most, max(most // 2, 2 * overlap)))
    index = RangeMaximum(strengths(text), most - least + 1)
    out, start = [], 0
    while len(text) - start > most:
        end = index.best(start + least, start + most)
        out.append((start, end))
        start = end - overlap
    return [*out, (start, len(text))]


def _write(names: list[str]):  # type: ignore[no-untyped-def]
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[tuple] = []
            for i, (text, most, overlap) in enumerate(zip(batch["_text"].to_pylist(), batch["_most"].to_pylist(), batch["_overlap"].to_pylist())):
                pieces = cuts(text, most, overlap or 0)
                rows += [i] * len(pieces)
                out += [(no, len(pieces), start, text[start:end]) for no, (start, end) in enumerate(pieces)]
            taken = batch.take(pa.array(rows, pa.int64()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*(taken[n] for n in names), *(pa.array([o[i] for o in out], kinds[i]) for i in range(4))], [*names, *(c.split()[0] for c in COLUMNS)])

    return write


def split_oversized(df: DataFrame, key: str, text: str, most: str | Column, overlap: str | Column) -> DataFrame:
    """(key, piece_no, piece_total, start, piece) of the items longer than the limit.

    Lengths are in characters (code points) of the untrimmed text. Neighbouring
    pieces share exactly `overlap` characters, and the pieces less their
    overlaps put together are the text. Items within the limit, null texts and
    items without a limit, or one under 1, are not split and don't come out; an
    overlap that isn't under the limit counts as one less than it, a null one
    as 0. The comparison with the limit runs in the JVM: only oversized texts
    reach Python.
    """
    names = [F.col(c) if isinstance(c, str) else c for c in (key, text, most, overlap)]
    rows = df.select(names[0].alias("_key"), names[1].alias("_text"), names[2].cast("int").alias("_most"), names[3].cast("int").alias("_overlap"))
    over = rows.where((F.length("_text") > F.col("_most")) & (F.col("_most") >= 1))
    kind = over.schema["_key"].dataType.simpleString()
    return over.mapInArrow(_write(["_key"]), f"_key {kind}, {', '.join(COLUMNS)}").withColumnRenamed("_key", key)
