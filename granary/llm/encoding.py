"""Token ids of whole texts by the tokenizers library, with a memory of what it said about short pieces.

Both vocabularies cut a text into short pieces and encode each piece alone, so
the ids of a text are those of its pieces joined. The joined bytes of many texts are cut at once, with
array operations on the kinds of bytes, and the library's model is asked once for a piece a worker
remembers, not once for each time it is found. Texts with characters for which the cut is not
certain to be the library's own (beyond ASCII and plain Latin letters) go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from granary.llm.text import plain

MEMORY_BYTES = 40 << 20  # of pieces and their ids that a worker remembers

LATIN = "A-Za-zÀ-ÖØ-öø-įı-ſ"
CERTAIN = "\\t-\\r\\x20-\\x7eÀ-ÖØ-öø-įı-ſ"

BLANK, LETTER, DIGIT, OTHER = 0, 1, 2, 3
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[[*range(9, 14), 32]] = BLANK
KINDS[[*range(ord("0"), ord("9") + 1)]] = DIGIT
KINDS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = LETTER  # beyond ASCII only Latin letters get here


def cuts(raw: np.ndarray, offsets: np.ndarray, spaced: bool) -> np.ndarray:
    """Where pieces of texts start: text i is raw[offsets[i]:offsets[i + 1]].

    A piece is a run of letters, of digits, of blanks or of others; an apostrophe alone takes the ending of a contraction with it. With
    ``spaced`` every digit is a piece. Without, the last blank before something else is a piece of its own, or, if it is a space, the start of what follows.
    """
    n = len(raw)
    kind = np.append(KINDS[raw], [BLANK] * 3)
    byte = np.append(raw, [0] * 3)
    text = np.zeros(n + 3, dtype=bool)
    text[offsets] = True  # the end of all is the start of a text, too
    start = text.copy()
    start[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(byte[:n] == ord("'"))
    runs = runs[start[runs] & (kind[runs + 1] == LETTER) & ~text[runs + 1]]
    if spaced:
        start[:n] |= kind[:n] == DIGIT
    else:
        runs = runs[text[runs] | (byte[runs - 1] != 32)]
        last = np.flatnonzero((kind[:n] == BLANK) & start[1 : n + 1] & ~text[1 : n + 1])
        start[last] = True
        start[last[byte[last] == 32] + 1] = False
    one, two = byte[runs + 1], byte[runs + 2]
    short = np.isin(one, list(b"stmd"))
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~text[runs + 2]
    start[runs[short | long] + 1] = False
    start[runs[short] + 2] = start[runs[long] + 3] = True
    return np.flatnonzero(start[:n])


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it can be printed, else one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memory:
    """The ids of pieces in plain arrays, made by ``make`` when a piece is first asked for.

    Beyond ``limit`` bytes the pieces that were asked for in one batch only are forgotten, and all of them if the others still fill half of it.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMORY_BYTES):
        self.make, self.limit = make, limit
        self._keep(pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64))

    def _keep(self, names: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names, self.ids, self.sizes = names, ids, sizes
        self.again = np.zeros(len(names), dtype=bool)

    def _forget(self) -> None:
        stay = self.again
        self._keep(self.names.filter(pa.array(stay)), self.ids[np.repeat(stay, self.sizes)], self.sizes[stay])
        if self.nbytes() > self.limit // 2:
            self._keep(self.names[:0], self.ids[:0], self.sizes[:0])

    def nbytes(self) -> int:
        return self.names.nbytes + self.ids.nbytes + self.sizes.nbytes

    def ask(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, sizes): the ids of name i are ids[begins[i]:begins[i] + sizes[i]]; names differ."""
        if self.nbytes() > self.limit:  # a batch may add its own beyond that
            self._forget()
        place = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        unknown = names.take(pa.array(new))
        made = list(map(self.make, unknown.to_pylist()))
        place[new] = len(self.names) + np.arange(len(new))
        self.names = pa.concat_arrays([self.names, unknown])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u4")])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, made), np.int64, len(made)) // 4])
        self.again = np.concatenate([self.again, np.zeros(len(new), dtype=bool)])
        return self.ids, (np.cumsum(self.sizes) - self.sizes)[place], self.sizes[place]


class Encoder:
    """Encodes lists of texts with one vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = os.path.basename(path) == "word_bpe_49k.json"  # lower case, white space dropped
        self.apart = self.spaced or os.path.basename(path) == "byte_bpe_50k.json"
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.uncertain = "|".join([f"[^{CERTAIN}]", *map(re.escape, special)])
        self.letters = byte_letters()
        self.known = Memory(self._piece)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids by the library alone."""
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []

    def _piece(self, piece: str) -> bytes:
        if self.spaced and piece.isspace():
            return b""
        if piece.isascii() and piece.isprintable():
            written = piece.replace(" ", self.letters[32])
        else:
            written = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def _parted(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts by their pieces."""
        texts = pa.concat_arrays([pc.utf8_lower(texts) if self.spaced else texts]).cast(pa.string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        first = cuts(raw, offsets, self.spaced)
        bounds = np.append(first, len(raw)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(raw)).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        table, begins, sizes = self.known.ask(coded.dictionary)
        n = sizes[codes]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        wide = np.int32 if max(total, len(table)) < 1 << 31 else np.int64
        ids = table[np.arange(total, dtype=wide) + np.repeat((begins[codes] - (ends - n)).astype(wide), n)]
        at = np.concatenate([[0], ends])[np.searchsorted(first, offsets)].tolist()
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers."""
        texts = plain(texts)
        if not self.apart:
            return self.whole(texts.to_pylist())
        unsure = pc.match_substring_regex(texts, self.uncertain).to_numpy(zero_copy_only=False).astype(bool)
        out: list[np.ndarray | None] = [None] * len(texts)
        usual = np.flatnonzero(~unsure)
        for i, ids in zip(usual.tolist(), self._parted(texts.take(pa.array(usual))) if len(usual) else ()):
            out[i] = ids
        rest = np.flatnonzero(unsure)
        for i, ids in zip(rest.tolist(), self.whole(texts.take(pa.array(rest)).to_pylist())):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    return Encoder(path)


def encode_column(column: pa.Array, path: str) -> list[np.ndarray]:
    return encoder(path).encode(column)
