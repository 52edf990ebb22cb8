"""Blocks of texts and their word tables, for use inside Arrow tasks.

A block is a run of rows holding a bounded number of text bytes. Its word table lists each
distinct word once; the words of the texts are positions in that table. Work per word is
done once per table entry and joined back by position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes of a block. A longer single text is a block of its own.
BLOCK_BYTES = 16 << 20


def schema_with(df: DataFrame, columns: list[str], new: str) -> StructType:
    """The schema of some columns and of new ones, given as DDL."""
    return StructType(
        df.select(*[f"`{c}`" for c in columns]).schema.fields + StructType.fromDDL(new).fields
    )


def as_row(columns: list[str]) -> Column:
    """Columns of any names as one struct ``row``, which tasks pass through."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")


def of_row(columns: list[str]) -> list[Column]:
    return [F.col("row")[c].alias(c) for c in columns]


def blocks(batches, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into blocks of at most ``limit`` bytes of ``column``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(block: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts, null as empty, with 64-bit offsets that start at 0.

    Built anew, because some string kernels misread the offsets of a slice.
    """
    texts = pc.fill_null(block.column(column).cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = (data or pa.py_buffer(b"")).slice(first, last - first)
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(offsets - first), data]
    )


@dataclass
class WordTable:
    """``codes[starts[i]:starts[i + 1]]`` are the words of text i as places in ``words``."""

    starts: np.ndarray
    codes: np.ndarray
    words: pa.Array

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Per text, the sum of a number that each word has."""
        return segment_sums(per_word[self.codes], self.starts)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each segment. Segments are summed on their own, so no precision is lost."""
    out = np.zeros(len(starts) - 1, dtype=values.dtype)
    full = starts[1:] > starts[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full])
    return out


def word_table(texts: pa.Array) -> WordTable:
    """Words are runs without the white space 0x20 and 0x09 to 0x0D."""
    lists = pc.ascii_split_whitespace(texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts -= starts[0]
    held = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not held.all():  # white space at either end of a text leaves an empty word
        flat = flat.filter(pa.array(held))
        starts = np.concatenate([[0], np.cumsum(held)])[starts]
    encoded = flat.dictionary_encode()
    return WordTable(starts, encoded.indices.to_numpy(), encoded.dictionary)
