"""Words of whole texts where bytes fall into three kinds: of words, blank, or a break between pieces.

Everything is found with array operations over the joined bytes of many texts; A-Z become a-z.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from granary.llm.text import plain

WORD, BLANK, BREAK = 0, 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def kinds(blank: Iterable[int] = (), breaks: Iterable[int] = ()) -> np.ndarray:
    """The kind of every byte; what is named in neither list belongs to words."""
    table = np.zeros(256, dtype=np.uint8)
    table[list(blank)] = BLANK
    table[list(breaks)] = BREAK
    return table


@dataclass
class Tokens:
    """Words in order: ``codes`` into ``names``, with the ``text`` and the ``piece`` each is in."""

    codes: np.ndarray
    names: pa.Array
    text: np.ndarray
    piece: np.ndarray
    counts: np.ndarray  # words of every text


def tokens_of(texts: pa.Array, table: np.ndarray) -> Tokens:
    """Words of all texts; no piece reaches over the end of its text. A null text has none."""
    texts = plain(texts)
    n = len(texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), texts), "\n")
    raw = np.frombuffer(joined[0].as_buffer() or b"", dtype=np.uint8) if n else np.empty(0, np.uint8)
    table = table.copy()
    table[ord("\n")] = BREAK if table[ord("\n")] == WORD else table[ord("\n")]
    kind = table[raw]
    gaps = np.zeros(len(raw) + 2, dtype=np.int8)
    gaps[1:-1] = kind == WORD
    edges = np.flatnonzero(gaps[1:] != gaps[:-1])
    first, last = edges[0::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    letters = LOWER[raw[kind == WORD]]
    flat = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(letters))
    coded = flat.dictionary_encode()
    text = np.searchsorted(ends, first, side="right")
    breaks = np.flatnonzero(kind == BREAK)
    piece = np.searchsorted(breaks, first) + text  # a text's end parts pieces whatever its bytes are
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return Tokens(codes, coded.dictionary, text, piece, np.bincount(text, minlength=n))
