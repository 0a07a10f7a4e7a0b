"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda of symbol pairs.

A text is normalised by the library and cut wherever two neighbouring characters
stand together in no piece of the vocabulary. No merge can go across such a
place, so the cuts can be encoded alone. Within a cut, all adjacent symbols
that form a piece are on an agenda; the one with the highest score, the
leftmost at equal scores, is merged and its new neighbours join the agenda. Symbols that
are no piece at the end are spelled in byte pieces, or are unknown.

Each Arrow batch's new cuts are encoded by the sentencepiece library too, and a
difference is an error. Where the library cannot be asked for a cut alone, the whole texts that
hold it are compared. What a cut decodes to is the library's answer as well; no character is ever spelled over
two cuts, so a text decodes to what its cuts do. ``agrees`` tells for every text whether that
is the text itself (it need not be where a text holds the word mark).

A worker remembers for each cut its ids, their decimal text and what it decodes to; a batch is cut with one
array pass, and the answers for its texts are gathered by the numbers of their cuts.

Nulls: a null text is empty and has no ids. A null doc_id stays null; repeated rows and ties are encoded
each on their own. An empty table gives an empty one. Only the two columns are read, so extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import plain, slices

MARK = "▁"
MEMORY = 500_000  # cuts a worker remembers
ALPHABET = 1 << 10  # characters above, but for the word mark, are looked up one by one


class PieceModel:
    """Encodes and decodes with one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        plain_ids = [i for i in range(n) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        self.ids = {library.id_to_piece(i): i for i in plain_ids}
        self.costs = {p: -library.get_score(i) for p, i in self.ids.items()}  # the best score is the least cost
        self.bytes = {int(library.id_to_piece(i)[3:5], 16): i for i in range(n) if library.is_byte(i)}
        self.unknown = library.unk_id()
        if any(library.is_unused(i) for i in range(n)):
            raise ValueError("a vocabulary with unused pieces needs them split again")
        self.pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.together = np.zeros((ALPHABET + 1, ALPHABET + 1), dtype=bool)
        place = {chr(c): c for c in range(ALPHABET)} | {MARK: ALPHABET}
        for a, b in self.pairs:
            if a in place and b in place:
                self.together[place[a], place[b]] = True
        # A character in no piece, to put before a cut when the library is asked.
        self.apart = None if any("\n" in p for p in self.ids) else "\n"
        self.known: dict[str, tuple[bytes, bytes, bytes]] = {}  # ids, decimal text with a comma after each, decoded text
        self.unsure: set[str] = set()  # cuts that the library was not asked for alone
        self.lead = library.encode("a")
        self.lead_text = library.decode(self.lead)

    def cuts(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """The parts of all texts that no merge can join, and where each text's parts start."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width)])  # the byte at which a character starts
        place = np.where(codes == ord(MARK), ALPHABET, np.where(codes < ALPHABET, codes, ALPHABET + 1))
        high = place > ALPHABET
        place[high] = 0
        apart = np.ones(len(codes) + 1, dtype=bool)
        if len(codes) > 1:
            apart[1:-1] = ~self.together[place[:-1], place[1:]]
            for i in np.flatnonzero(high[:-1] | high[1:]).tolist():
                apart[i + 1] = joined[i : i + 2] not in self.pairs
        apart[starts] = True
        ends = np.flatnonzero(apart) if len(codes) else np.zeros(1, np.int64)
        letters = pa.py_buffer(joined.encode())
        parts = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(at[ends].astype(np.int32)), letters)
        return parts, np.searchsorted(ends, starts)

    def agenda(self, cut: str) -> list[int]:
        """The ids of one cut."""
        symbols: list[str] = list(cut)
        cost = self.costs.get
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        queue = []
        for i in range(len(symbols) - 1):
            pair = symbols[i] + symbols[i + 1]
            if (price := cost(pair)) is not None:
                queue.append((price, i, i + 1, pair))
        heapify(queue)
        end = len(symbols)
        while queue:
            _, i, j, pair = heappop(queue)
            if after[i] != j or not symbols[i] or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                longer = pair + symbols[k]
                if (price := cost(longer)) is not None:
                    heappush(queue, (price, i, k, longer))
            h = before[i]
            if h >= 0:
                longer = symbols[h] + pair
                if (price := cost(longer)) is not None:
                    heappush(queue, (price, h, i, longer))
        out: list[int] = []
        for s in filter(None, symbols):
            if (piece := self.ids.get(s)) is not None:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in s.encode()]
            else:
                out.append(self.unknown)
        return out

    def _learn(self, cuts: list[str]) -> None:
        """Encode new cuts, hold them against the library, and ask it what they decode to."""
        own = [self.agenda(cut) for cut in cuts]
        decoded = self.library.decode([self.lead + ids for ids in own], num_threads=1) if cuts else []
        for cut, ids, text in zip(cuts, own, decoded):
            decimal = "".join([f"{i}," for i in ids]).encode()
            self.known[cut] = (np.array(ids, dtype="<i4").tobytes(), decimal, text[len(self.lead_text) :].encode())
        if self.apart is None:
            asked = [(i, c[1:], 0) for i, c in enumerate(cuts) if c[0] == MARK]
            self.unsure.update(c for c in cuts if c[0] != MARK)
        else:
            skip = len(self.library.encode(self.apart))
            asked = [(i, self.apart + c, skip) for i, c in enumerate(cuts)]
        texts = [t.replace(MARK, " ") for _, t, _ in asked]
        seen = zip(asked, texts, self.library.encode(texts, num_threads=1), self.library.normalize(texts)) if asked else ()
        for (i, _, skip), text, said, normal in seen:
            if not normal.endswith(cuts[i]):
                self.unsure.add(cuts[i])
            elif said[skip:] != own[i]:
                raise ValueError(f"the library encodes {text!r} as {said}, the agenda {cuts[i]!r} as {own[i]}")

    def answers(self, texts: list[str]) -> tuple[list[np.ndarray], list[memoryview], list[bytes]]:
        """For every text its ids, their decimal text joined by commas, and the bytes that they decode to."""
        parts, starts = self.cuts(self.library.normalize(texts) if texts else [])
        coded = parts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) + len(names) > MEMORY:
            self.known.clear()
            self.unsure.clear()
        self._learn([c for c in names if c not in self.known])
        told = list(zip(*map(self.known.__getitem__, names))) or [(), (), ()]
        gathered = []
        for column in told:
            rows = pa.array(column, pa.binary()).take(coded.indices)
            ends = np.frombuffer(rows.buffers()[1], "<i4")[: len(rows) + 1] if len(rows) else np.zeros(1, np.int32)
            gathered.append((memoryview(rows.buffers()[2] or b"") if len(rows) else memoryview(b""), ends[starts].tolist()))
        (ids, at), (decimal, to), (text, of) = gathered
        numbers = [np.frombuffer(ids[a:b], "<i4") for a, b in zip(at[:-1], at[1:])]
        if self.unsure:
            self._compare(texts, starts, coded, names, numbers)
        firsts = [np.frombuffer(self.known[names[coded.indices[int(a)].as_py()]][0], "<i4").tolist() if a < b else [] for a, b in zip(starts[:-1], starts[1:])]
        opening = self.library.decode(firsts, num_threads=1) if firsts else []  # a text's first mark is no space
        decoded = []
        for first, start, a, b in zip(opening, starts.tolist(), of[:-1], of[1:]):
            skip = len(self.known[names[coded.indices[start].as_py()]][2]) if a < b else 0
            decoded.append(first.encode() + bytes(text[a + skip : b]))
        return numbers, [decimal[a : max(a, b - 1)] for a, b in zip(to[:-1], to[1:])], decoded

    def _compare(self, texts: list[str], starts: np.ndarray, coded: pa.DictionaryArray, names: list[str], ids: list[np.ndarray]) -> None:
        """Hold the whole texts with cuts that the library was not asked for against it."""
        unsure = np.fromiter((n in self.unsure for n in names), bool, len(names))[coded.indices.to_numpy(zero_copy_only=False)]
        total = np.concatenate([[0], np.cumsum(unsure)])
        at = np.flatnonzero(total[starts[1:]] > total[starts[:-1]]).tolist()
        for i, said in zip(at, self.library.encode([texts[i] for i in at], num_threads=1) if at else ()):
            if said != ids[i].tolist():
                raise ValueError(f"the library encodes {texts[i]!r} as {said}, the agenda as {ids[i].tolist()}")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [ids.tolist() for ids in self.answers(texts)[0]]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=1)
def model(path: str) -> PieceModel:
    """One model for each file and worker process."""
    return PieceModel(path)


def encode_table(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees[, ids, decoded]) of whole texts."""

    digest = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model(path)
        for part in slices(batches, limit=4 << 20):
            texts = plain(part.column("text")).to_pylist()
            ids, decimals, decoded = of.answers(texts)
            columns = [
                part.column("doc_id"),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([digest(d) for d in decimals], pa.string()),
                pa.array([digest(d) for d in decoded], pa.string()),
                pa.array(np.array([d == t.encode() for d, t in zip(decoded, texts)], dtype=bool)),
            ]
            if keep_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([d.decode() for d in decoded], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees", "ids", "decoded"]
            yield pa.record_batch(columns, names=names[: len(columns)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean" + ", ids array<int>, decoded string" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
