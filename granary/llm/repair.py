"""Token ids in binary shards, compressed with Re-Pair grammars and readable at any place.

Documents are dealt by ranges of doc_id and a hash of the text, so rows that share an id
(or have none) are many ranges, encoded in that order, and cut into shards of about ``SHARD_IDS`` ids. In each shard the most frequent pairs of
neighbouring symbols are replaced by new symbols (rules), round after round,
until none is found ``LEAST_PAIRS`` times. A round replaces many pairs at once: where
the places of two overlap, the more frequent one has them.

A shard is one row of a parquet table (written and read by Spark, so a lost
executor only repeats its rows): the rules as two symbols each, the expansion
length of every symbol's rule, the remaining symbols, and the documents' ids and starts.
With the lengths, ``decode`` finds the symbols under any range of ids and
expands those alone.

Nulls: a null text is empty and has the end id only; a null doc_id sorts first.
Different texts under one doc_id are ordered by their hash; repeated rows are kept, side by side. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.encoding import encode_column
from granary.llm.text import ids_crc, slices, text_mark
from granary.sources.workspace import scratch_path

SHARD_IDS = 1 << 20
ENCODED_BYTES = 8 << 20  # text encoded at a time
RULES_A_ROUND = 2048
LEAST_PAIRS = 16  # a pair found fewer times in a shard is no rule
SLOT_BITS = 20  # of the table that finds a pair's rank

SHARD_SCHEMA = "part int, shard int, base long, n_ids long, rules binary, lengths binary, symbols binary, doc_ids binary, starts binary, nulls binary"


def _ranks(codes: np.ndarray, wanted: np.ndarray, bits: int) -> np.ndarray:
    """For each code its place in ``wanted``; -1 if it is not there."""
    odd, keep = (np.uint32(0x9E3779B1), np.uint32(32 - SLOT_BITS)) if bits == 16 else (np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - SLOT_BITS))
    slots = np.full(1 << SLOT_BITS, -1, dtype=np.int32)
    slots[(wanted * odd) >> keep] = np.arange(len(wanted), dtype=np.int32)
    rank = slots[(codes * odd) >> keep]
    # Another code in the same slot: few places, searched for.
    other = np.flatnonzero(rank >= 0)
    other = other[wanted[rank[other]] != codes[other]]
    order = np.argsort(wanted)
    known = wanted[order]
    place = np.minimum(np.searchsorted(known, codes[other]), len(known) - 1)
    rank[other] = np.where(known[place] == codes[other], order[place], -1)
    return rank


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rule k, a pair of symbols, is symbol base + k.

    The first round counts all pairs. A pair of older symbols only gets rarer, and one with a new symbol lies where that symbol was
    put in, so every later round counts, exactly, the places of pairs that were often found and those beside new symbols.
    Symbols keep their places; ``after`` and ``before`` lead over those that are gone. Symbols have 16 bits as long as these suffice, then 32.
    """
    bits = 16 if base < 1 << 16 else 32  # of a symbol
    n = len(ids)
    x = ids.astype(np.uint16 if bits == 16 else np.uint32)
    rules: list[tuple[int, int]] = []
    here = np.ones(n, dtype=bool)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    at = np.arange(n - 1, dtype=np.int32) if n else np.empty(0, dtype=np.int32)
    while len(at):
        if bits == 16 and base + len(rules) + RULES_A_ROUND > 1 << 16:
            bits, x = 32, x.astype(np.uint32)
        pair = np.uint32 if bits == 16 else np.uint64
        most = (1 << bits) - 1
        then = after[at]
        left, right = x[at], x[then]
        codes = (left.astype(pair) << pair(bits)) | right
        live = np.ones(len(codes), dtype=bool)
        twin = np.flatnonzero(left == right)
        if len(twin):  # of a run of one symbol, every other place
            new_run = np.concatenate([[True], at[twin[1:]] != then[twin[:-1]]])
            first = np.maximum.accumulate(np.where(new_run, np.arange(len(twin)), 0))
            live[twin[(np.arange(len(twin)) - first) % 2 == 1]] = False
        ordered = np.sort(codes[live])
        # A pair found often enough equals the one LEAST_PAIRS - 1 places on; only those are counted out.
        early = ordered[: max(0, len(ordered) - LEAST_PAIRS + 1)]
        often = np.unique(early[early == ordered[LEAST_PAIRS - 1 :]])
        if not len(often):
            break
        times = np.searchsorted(ordered, often, side="right") - np.searchsorted(ordered, often)
        often = often[np.lexsort((often, -times))]
        chosen = often[:RULES_A_ROUND]
        rank = _ranks(codes, often, bits)
        waiting = at[rank >= 0]
        hit = np.flatnonzero(live & (rank >= 0) & (rank < len(chosen)))
        at, rank = at[hit], rank[hit]
        # Where places overlap, the more frequent pair has them; a rule that is left with too few waits for a later round.
        close = at[1:] == then[hit[:-1]]
        best = np.ones(len(at), dtype=bool)
        best[:-1] &= ~close | (rank[:-1] < rank[1:])
        best[1:] &= ~close | (rank[1:] < rank[:-1])
        at, rank = at[best], rank[best]
        kept = np.bincount(rank, minlength=len(chosen)) >= LEAST_PAIRS
        number = np.cumsum(kept) - 1
        at, rank = at[kept[rank]], rank[kept[rank]]
        x[at] = (base + len(rules) + number[rank]).astype(x.dtype)
        gone = after[at]
        beyond = after[gone]
        after[at], before[beyond], here[gone] = beyond, at, False
        chosen = chosen[kept]
        rules += list(zip((chosen >> pair(bits)).tolist(), (chosen & pair(most)).tolist()))
        marked = np.zeros(n + 1, dtype=bool)
        marked[waiting] = marked[at] = marked[before[at]] = True  # before the first symbol: place n, through -1
        marked[gone] = False
        at = np.flatnonzero(marked[:n]).astype(np.int32)
        at = at[after[at] < n]
    return x[here].astype("<u4"), np.array(rules, dtype="<u4").reshape(-1, 2)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for."""
    out = np.ones(len(rules), dtype="<u4")
    for k, (a, b) in enumerate(rules.tolist()):
        out[k] = (out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1)
    return out


class Shard:
    """A written shard, ready to be read at any place."""

    def __init__(self, base: int, rules: bytes, lengths: bytes, symbols: bytes):
        self.base = base
        self.rules = np.frombuffer(rules, "<u4").reshape(-1, 2)
        self.lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
        self.symbols = np.frombuffer(symbols, "<u4").astype(np.int64)
        # The ids of every rule, one after the other: a rule's two sides are older, so they are known.
        self.rule_starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.table = np.empty(int(self.rule_starts[-1]), dtype="<u4")
        for k, sides in enumerate(self.rules.tolist()):
            at = int(self.rule_starts[k])
            for s in sides:
                if s < base:
                    self.table[at] = s
                    at += 1
                else:
                    a, n = int(self.rule_starts[s - base]), int(self.lengths[s - base])
                    self.table[at : at + n] = self.table[a : a + n]
                    at += n
        is_rule = self.symbols >= base
        self.sizes = np.ones(len(self.symbols), dtype=np.int64)
        self.sizes[is_rule] = self.lengths[self.symbols[is_rule] - base]
        self.ends = np.cumsum(self.sizes)

    def decode(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the shard."""
        if stop <= start:
            return np.empty(0, "<u4")
        first = int(np.searchsorted(self.ends, start, side="right"))
        last = int(np.searchsorted(self.ends, stop, side="left")) + 1
        symbols, sizes = self.symbols[first:last], self.sizes[first:last]
        ends = np.cumsum(sizes)
        is_rule = symbols >= self.base
        out = np.empty(int(ends[-1]), dtype="<u4")
        out[(ends - 1)[~is_rule]] = symbols[~is_rule]
        n = sizes[is_rule]
        begin = (ends - sizes)[is_rule]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin, n) + inner] = self.table[np.repeat(self.rule_starts[symbols[is_rule] - self.base], n) + inner]
        skip = start - int(self.ends[first] - self.sizes[first])
        return out[skip : skip + stop - start]


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, base: int = 50_257, shard_ids: int = SHARD_IDS) -> None:
    """Encode whole texts in ascending doc_id order and write the shards to ``path``.

    ``base`` is the first symbol that is a rule; ids must be smaller.
    """

    def shard(part: int, number: int, doc_ids: list, arrays: list[np.ndarray]) -> pa.RecordBatch:
        ids = np.concatenate(arrays)
        if len(ids) and int(ids.max()) >= base:
            raise ValueError(f"an id is not below {base}")
        starts = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype("<i8")
        symbols, rules = compress(ids, base)
        known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
        row = (part, number, base, len(ids), rules.tobytes(), expansion_lengths(rules, base).tobytes(), symbols.tobytes(),
               known.tobytes(), starts.tobytes(), np.array([d is None for d in doc_ids], dtype="u1").tobytes())
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6)
        names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
        return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        arrays: list[np.ndarray] = []
        end = np.array([end_id], dtype="<u4")
        for piece in slices(batches, limit=ENCODED_BYTES):
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encode_column(piece.column("text"), tokenizer)):
                doc_ids.append(doc_id)
                arrays.append(np.concatenate([ids, end]))
                size += len(ids) + 1
                if size >= shard_ids:
                    yield shard(part, number, doc_ids, arrays)
                    number, size, doc_ids, arrays = number + 1, 0, [], []
        if arrays:
            yield shard(part, number, doc_ids, arrays)

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_mark("text").alias("mark"))
    wanted.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").drop("mark").mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from its shard."""
    shards = spark.read.parquet(path)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each range, for the only sum over all
    parts = parts.select("part", F.expr("sum(n) over (order by part) - n").alias("before"))
    inside = sizes.select("part", "shard", F.expr("sum(n_ids) over (partition by part order by shard) - n_ids").alias("ahead"))
    places = inside.join(parts, "part").select("part", "shard", (F.col("before") + F.col("ahead")).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                shard = Shard(row["base"], row["rules"], row["lengths"], row["symbols"])
                starts = np.frombuffer(row["starts"], "<i8").astype(np.int64)
                ids = shard.decode(0, row["n_ids"])
                crcs = [ids_crc(ids[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                n = len(crcs)
                doc_ids = pa.array(np.frombuffer(row["doc_ids"], "<i8").astype(np.int64), mask=np.frombuffer(row["nulls"], "u1").astype(bool))
                place = [pa.array(np.full(n, row[c], dtype=np.int32)) for c in ("part", "shard")]
                made = [pa.array(m) for m in (starts[:-1], np.diff(starts), np.array(crcs, dtype=np.int64))]
                yield pa.record_batch([*place, doc_ids, *made], names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    read = shards.mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return read.join(places, ["part", "shard"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents as shards below the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "repair")
    write_shards(docs, tokenizer, path, end_id)
    return read_documents(docs.sparkSession, path)
