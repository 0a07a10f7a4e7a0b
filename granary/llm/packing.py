"""Best-fit packing of token pieces into sequences, by bin completion with branch and bound.

Only lengths matter for packing, and there are at most ``capacity`` of them. So
the cluster counts pieces by length, the driver packs that table (never more
than ``capacity`` rows, however many pieces there are) into patterns with a
number of times each, and the cluster deals the pieces, numbered within their length, to the patterns.

Packing the table: best fit decreasing gives the first incumbent. If it needs
more sequences than the lower bound, the sequences with most waste (all of them, where they are few) are taken apart and
bin completion looks for a packing of their pieces with one sequence less: around the
largest piece left, fillings of any number of pieces are listed one after the other, least waste first. A table of
the sums that can be reached leads to each without a dead end. A filling is passed over if another dominates it: a
piece left out could take the place of some of its pieces and waste no more. A branch is cut
when its waste, or the lower bound of what is left, leaves no way to beat the incumbent, or when
the same pieces were left before. ``STEPS`` fillings bound each search,
so the result is optimal when it meets the lower bound or when the search ends before them on the whole table, and the best found otherwise.

Nulls: a null text is empty and is packed as its end id; a null doc_id stays one. Repeated rows are packed as they are, ties
of length in any order. An empty table gives an empty one. Only doc_id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.encoding import encode_column
from granary.llm.numbering import numbered
from granary.llm.text import ids_crc, slices
from granary.sources.workspace import settle

CAPACITY = 4096
ENCODED_BYTES = 8 << 20  # text encoded at a time
STEPS = 20_000  # fillings looked at in one search
TAKEN_APART = 32  # sequences at first, twice as many after a search without result
MOST_PIECES = 2048  # of the sequences taken apart, where that is not the whole table
BOUNDED = 64  # different lengths left, up to which a branch gets a lower bound

Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing over a table of lengths; equal sequences are handled as one."""
    bins: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if times:
            if room not in bins:
                bins[room] = []
                insort(rooms, room)
            bins[room].append([pattern, times])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
            else:
                room, pattern, times = capacity, (), left
            each = min(room // length, left)
            used = min(times, left // each)
            if pattern or used < times:
                put(room, pattern, times - used) if pattern else None
            put(room - each * length, pattern + (length,) * each, used)
            left -= each * used
    return [(p, n) for groups in bins.values() for p, n in groups]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing needs fewer: total size, and items that cannot share a sequence (Martello and Toth)."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[v] for v in lengths.tolist()], dtype=np.int64)
    best = -(-int((lengths * n).sum()) // capacity) if len(n) else 0
    for small in [v for v in lengths.tolist() if v <= capacity // 2]:
        alone = lengths > capacity - small
        halves = (lengths <= capacity - small) & (lengths > capacity // 2)
        rest = (lengths <= capacity // 2) & (lengths >= small)
        n_alone, n_halves = int(n[alone].sum()), int(n[halves].sum())
        over = int((lengths * n)[rest].sum()) - (n_halves * capacity - int((lengths * n)[halves].sum()))
        best = max(best, n_alone + n_halves + max(0, -(-over // capacity)))
    return best


def _spread(sums: int, by: int) -> int:
    """The set of numbers at most ``by`` above one of ``sums``; sets of numbers are the bits of an integer."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        sums |= sums << step
        done += step
    return sums


def _dominated(filling: Pattern, waste: int, rest: int) -> bool:
    """Whether one of the lengths ``rest``, a set, could stand in for some pieces of the filling: for several of up to its length, or for a shorter one."""
    single = several = 0
    for v in filling:
        several |= (several | single) << v
        single |= 1 << v
    return bool(_spread(several, waste) & rest) or bool(waste and _spread(single, waste - 1) << 1 & rest)


def fillings(counts: dict[int, int], room: int, most_waste: int) -> Iterator[Pattern]:
    """Fillings of ``room`` that waste at most ``most_waste``, least waste first; None for each that is dominated."""
    lengths = sorted(v for v, n in counts.items() if n and v <= room)
    reach, full = [1], (1 << room + 1) - 1  # reach[i]: sums of the first i lengths
    for v in lengths:
        sums, n, k = reach[-1], min(counts[v], room // v), 1
        while n:
            k = min(k, n)
            sums |= sums << k * v & full
            n, k = n - k, 2 * k
        reach.append(sums)

    def exactly(i: int, total: int) -> Iterator[Pattern]:
        if not total:
            yield ()
        for j in range(min(i, bisect_right(lengths, total)) - 1, -1, -1):
            if not reach[j + 1] >> total & 1:
                return
            v = lengths[j]
            for k in range(min(counts[v], total // v), 0, -1):
                if reach[j] >> total - k * v & 1:
                    for tail in exactly(j, total - k * v):
                        yield (v,) * k + tail

    every = sum(1 << v for v in lengths)
    for waste in range(min(room, most_waste) + 1):
        if reach[-1] >> room - waste & 1:
            for filling in exactly(len(lengths), room - waste):
                rest = every
                for v, n in Counter(filling).items():
                    if n == counts[v]:
                        rest &= ~(1 << v)
                yield None if _dominated(filling, waste, rest) else filling


def search(counts: dict[int, int], capacity: int, target: int, steps: int = STEPS) -> list[Pattern] | None:
    """A packing of at most ``target`` sequences by bin completion; None if there is none or ``steps`` are used up."""
    left = dict(sorted(counts.items()))
    allowed = target * capacity - sum(v * n for v, n in left.items())
    chosen: list[Pattern] = []
    options: list[Iterator[Pattern]] = []
    seen: dict[bytes, int] = {}  # least waste with which the same pieces were left
    waste = 0

    def undo() -> None:
        nonlocal waste
        pattern = chosen.pop()
        waste -= capacity - sum(pattern)
        for v in pattern:
            left[v] += 1

    def hopeless() -> bool:
        if waste > allowed:
            return True
        some = {v: n for v, n in left.items() if n}
        if len(some) <= BOUNDED and len(chosen) + lower_bound(some, capacity) > target:
            return True
        state = hashlib.blake2b(np.fromiter(left.values(), np.int64, len(left)).tobytes(), digest_size=16).digest()
        known = seen.get(state)
        if known is not None and known <= waste:
            return True
        seen[state] = waste
        return False

    def enter() -> bool:
        """Go on to the next sequence; true if there is none."""
        largest = next((v for v in reversed(left) if left[v]), None)
        if largest is not None:
            rest = {**left, largest: left[largest] - 1}
            options.append(((largest, *f) if f is not None else None for f in fillings(rest, capacity - largest, allowed - waste)))
        return largest is None

    if hopeless():
        return None
    if enter():
        return chosen
    for _ in range(steps):
        pattern = next(options[-1], ())
        if pattern == ():  # no filling is left here
            options.pop()
            if not options:
                return None
            undo()
        elif pattern is not None:
            chosen.append(pattern)
            waste += capacity - sum(pattern)
            for v in pattern:
                left[v] -= 1
            if hopeless():
                undo()
            elif enter():
                return chosen
    return None


def _most_wasteful(packing: list[tuple[Pattern, int]], capacity: int, n: int) -> tuple[dict[Pattern, int], dict[Pattern, int]]:
    """(some, others): ``n`` sequences with most waste, more if theirs is not a whole sequence, and the rest."""
    some, others, taken, waste = {}, {}, 0, 0
    for pattern, times in sorted(packing, key=lambda p: (sum(p[0]), p[0])):
        free = capacity - sum(pattern)
        wanted = max(n - taken, -(-(capacity - waste) // free) if free else 0, 0)
        used = min(times, wanted)
        if used:
            some[pattern] = some.get(pattern, 0) + used
        if used < times:
            others[pattern] = others.get(pattern, 0) + times - used
        taken, waste = taken + used, waste + used * free
    return some, others


def complete(counts: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[Pattern, int]]:
    """Patterns with times: best fit, then bin completion until the lower bound is met or a search has no result."""
    incumbent = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    part = TAKEN_APART
    while sum(n for _, n in incumbent) > bound:
        some, others = _most_wasteful(incumbent, capacity, part)
        n = sum(some.values())
        held = Counter()
        for pattern, times in some.items():
            for v in pattern:
                held[v] += times
        if others and held.total() > MOST_PIECES:
            break
        fewer = search(held, capacity, n - 1, steps)
        if fewer is not None:
            incumbent = [*others.items(), *Counter(fewer).items()]
            part = TAKEN_APART
        elif not others:
            break
        else:
            part = max(2 * part, n + 1)
    return incumbent


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of whole texts; only texts above ``capacity`` ids are cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4")
        for part in slices(batches, limit=ENCODED_BYTES):
            rows: list[tuple] = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode_column(part.column("text"), tokenizer)):
                ids = np.concatenate([ids, end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    cut = ids[at : at + capacity]
                    rows.append((doc_id, k, at, len(cut), ids_crc(cut), cut))
            doc, k, at, n, crc, cuts = zip(*rows) if rows else [()] * 6
            columns = [pa.array(doc, pa.int64()), pa.array(k, pa.int32()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
            if keep_ids:
                columns.append(pa.array([c.astype(np.int32) for c in cuts], pa.list_(pa.int32())))
            yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there."""
    cut = settle(pieces(docs, tokenizer, end_id, capacity, keep_ids), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    froms, firsts, offsets = _places(complete(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = (batch.column("length").to_numpy() << 48) + batch.column("rank").to_numpy()
            at = np.searchsorted(froms, key, side="right") - 1
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            made = [pa.array(firsts[at] + key - froms[at]), pa.array(offsets[at])]
            yield pa.record_batch(kept + made, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    ranked = numbered(cut, "length", ["doc_id", "piece"], "rank").select(*cut.columns, "rank")
    schema = ", ".join(f"{c} {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def _places(patterns: list[tuple[Pattern, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of pieces of one length: its first (length, rank) as one number, its first sequence, its offset."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append(((length << 48) + taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    made = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return made[:, 0].copy(), made[:, 1].copy(), made[:, 2].copy()
