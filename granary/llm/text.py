"""Words of whole texts in Arrow batches, and batches of bounded size.

A word is a run of bytes outside space and 0x09-0x0D. A null text has no words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


@dataclass
class Words:
    """Words of consecutive texts: ``codes`` into ``names``; text i has codes[starts[i]:starts[i + 1]]."""

    codes: np.ndarray
    names: pa.Array
    starts: np.ndarray

    def owners(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each text."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one text, or texts of about ``limit`` bytes, are worked on at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def plain(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "")


def word_lists(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and where each text's words start."""
    texts = plain(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    ends = np.cumsum(np.concatenate([[0], pc.list_value_length(lists).to_numpy(zero_copy_only=False)]), dtype=np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    kept = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), kept[ends]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    flat, starts = word_lists(texts, lower)
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, starts)


def text_mark(column: str) -> Column:
    """A hash of the whole text, to tell texts under one doc_id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
