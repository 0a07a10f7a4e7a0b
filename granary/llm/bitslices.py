"""Exact top-k inner products with a bit-sliced index.

Components are quantised to whole numbers. Rows are dealt into blocks by a hash of
their id; a block stores, for every dimension, its most significant bits as
bitmaps over the rows (slices), and the rows themselves for exact scores. A query adds the
slices of all dimensions, weighted by the leading bits of its own components, with
bitmap arithmetic: a number per row is a stack of bitmaps, and stacks are added
with and, or, xor. The k-th largest sum is found from the most significant
slice downward; what the dropped bits could change is bounded, so
all rows whose sum could still reach the k-th are resolved by their exact scores. Nothing is approximate.

The queries go against all rows in cells of one block and one chunk of queries,
so neither side has to fit in memory or in a broadcast. What travels is one copy of a block for every
``CHUNKS_TOGETHER`` chunks, and each chunk once for every block.

Vectors with components so large that their products could leave 64 bits ("wide") lie in the same blocks beside the slices: extended
floating point with a bound of its error tells which rows can be among the k best, and whole numbers of any size decide.
A score beyond 64 bits is returned as the end of their range, its rank is the exact one's.

Vectors that are null or hold null or non-finite components take no part; neither does a null id. Only vectors of equal
length are compared. Rows that share a vec_id are all candidates for other queries, and as queries they share one
list, the best of what any of them finds; they take no part in each other's. Ties go to the smaller vec_id.
An empty table gives an empty one. Only the two columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sources.workspace import settle

SCALE = 256
TOP = 5
EVERY = 50
BLOCK_BYTES = 4 << 20  # of a block's rows, 4 bytes a component
LEAST_ROWS = 64  # of a block, however long its vectors
CHUNK_QUERIES = 128
CHUNKS_TOGETHER = 64  # that one copy of a block is searched for
SLICES = 6
WEIGHT_BITS = 5
LEAST, MOST = -(1 << 63), (1 << 63) - 1  # of a 64-bit number


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of stacks of bitmaps: (..., bits, words) each, least significant first; one bit more comes out."""
    bits = a.shape[-2]
    out = np.empty((*a.shape[:-2], bits + 1, a.shape[-1]), dtype=np.uint64)
    carry = None
    for i in range(bits):
        x, y = a[..., i, :], b[..., i, :]
        half = x ^ y
        both = x & y
        if carry is None:
            out[..., i, :], carry = half, both
        else:
            out[..., i, :] = half ^ carry
            carry = both | (half & carry)
    out[..., bits, :] = carry
    return out


def total(stacks: np.ndarray) -> np.ndarray:
    """Sum over the first axis of (m, bits, words)."""
    while len(stacks) > 1:
        odd = stacks[-1:] if len(stacks) % 2 else None
        stacks = add(stacks[0 : len(stacks) - len(stacks) % 2 : 2], stacks[1::2])
        if odd is not None:
            stacks = np.concatenate([stacks, np.pad(odd, ((0, 0), (0, 1), (0, 0)))])
    return stacks[0]


def _widen(stack: np.ndarray, low: int, bits: int) -> np.ndarray:
    """The stack times 2^low, in ``bits`` bitmaps."""
    out = np.zeros((bits, stack.shape[-1]), dtype=np.uint64)
    n = min(len(stack), bits - low)
    out[low : low + n] = stack[:n]
    return out


def pack_bits(flags: np.ndarray) -> np.ndarray:
    """Flags along the last axis as 64-bit words."""
    pad = -flags.shape[-1] % 64
    padded = np.pad(flags.astype(np.uint8), [(0, 0)] * (flags.ndim - 1) + [(0, pad)])
    return np.ascontiguousarray(np.packbits(padded, axis=-1, bitorder="little")).view(np.uint64)


class Block:
    """Some rows with their bit slices: ``slices[d, b]`` is the bitmap of bit b of dimension d, ``shift`` the bits left out."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, slices: np.ndarray, shift: int):
        self.ids, self.rows, self.slices, self.shift = ids, rows, slices, shift
        self.dims = rows.shape[1]
        self.all = pack_bits(np.ones(len(rows), dtype=bool))

    @staticmethod
    def slice_rows(rows: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices, shift) of rows, counted from the least value of each dimension."""
        raised = rows - rows.min(axis=0)
        shift = max(0, int(raised.max(initial=0)).bit_length() - SLICES)
        bits = [pack_bits(((raised >> (shift + b)) & 1).T) for b in range(SLICES)]
        return np.stack(bits, axis=1), shift

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the rows among which the k best are; the query's own id takes no part."""
        others = self.all.copy()
        own = np.flatnonzero(self.ids == query_id)
        for i in own.tolist():
            others[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        size = np.abs(query)
        drop = max(0, int(size.max()).bit_length() - WEIGHT_BITS) if self.dims else 0
        weights = size >> drop
        if len(self.ids) - len(own) > k and weights.any():
            sums = self._sums(query < 0, weights)
            # What the dropped bits of rows and weights can add to a score, in units of the sums.
            loose = int((size * ((1 << self.shift) - 1)).sum()) + int(((size & ((1 << drop) - 1)) * (((1 << SLICES) - 1) << self.shift)).sum())
            at_least = self._kth(sums, others, k) - (loose >> (self.shift + drop)) - 1
            others = self._reaching(sums, others, at_least)
        found = np.flatnonzero(np.unpackbits(others.view(np.uint8), bitorder="little")[: len(self.ids)])
        return self.ids[found], self.rows[found] @ query

    def _sums(self, negative: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Weighted sum of the slices; for negative components, of their complements."""
        bits = max(1, int(weights.sum() * ((1 << SLICES) - 1)).bit_length())
        out = np.zeros((bits, self.slices.shape[-1]), dtype=np.uint64)
        for j in range(int(weights.max()).bit_length()):
            dims = np.flatnonzero((weights >> j) & 1)
            if len(dims):
                chosen = self.slices[dims]
                flip = negative[dims]
                chosen[flip] = ~chosen[flip]
                out = add(out, _widen(total(chosen), j, bits))[:bits]
        return out

    @staticmethod
    def _count(bitmap: np.ndarray) -> int:
        return int(np.bitwise_count(bitmap).sum())

    def _kth(self, sums: np.ndarray, among: np.ndarray, k: int) -> int:
        """The k-th largest sum, decided slice by slice from the most significant one."""
        value, above, level = 0, 0, among
        for i in range(len(sums) - 1, -1, -1):
            ones = level & sums[i]
            n = self._count(ones)
            if above + n >= k:
                value += 1 << i
                level = ones
            else:
                above += n
                level = level & ~sums[i]
        return value

    @staticmethod
    def _reaching(sums: np.ndarray, among: np.ndarray, least: int) -> np.ndarray:
        """Rows whose sum is at least ``least``."""
        if least <= 0:
            return among
        more, level = np.zeros_like(among), among
        for i in range(len(sums) - 1, -1, -1):
            if least >> i & 1:
                level = level & sums[i]
            else:
                more = more | (level & sums[i])
                level = level & ~sums[i]
        return more | level


def order_key(score: int) -> bytes:
    """Orders scores beyond 64 bits among themselves; empty for others."""
    if LEAST < score <= MOST:
        return b""
    size = (abs(score).bit_length() + 7) // 8
    key = size.to_bytes(2) + abs(score).to_bytes(size)
    return key if score > 0 else bytes(255 - b for b in key)


def exact_top(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(id, score) of the rows among which the k best are, for whole numbers of any size given as extended floats."""
    others = np.flatnonzero(ids != query_id)
    rows = rows[others]
    about = rows @ query
    loose = 2 * (rows.shape[1] + 1) * np.finfo(np.longdouble).eps * (np.abs(rows) @ np.abs(query))
    if len(others) > k:
        near = about + loose >= np.sort(about - loose)[-k]
        others, rows = others[near], rows[near]
    whole = [int(x) for x in query]
    return [(int(ids[i]), sum(int(a) * b for a, b in zip(row, whole))) for i, row in zip(others.tolist(), rows)]


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dims, codes, wide) of the vectors that take part: whole numbers, or the components themselves for wide vectors."""
    embedding, dims = F.col("embedding").cast("array<double>"), F.size("embedding")
    x = F.transform(embedding, lambda v: F.floor(v * scale * 1.0))
    fine = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    small = F.least(F.lit(float(1 << 31)), F.sqrt(F.lit(float(1 << 60)) / F.greatest(dims, F.lit(1))))
    narrow = F.forall(embedding, lambda v: F.abs(v * scale) < small)
    taken = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    return taken.select(
        F.col("vec_id").cast("long").alias("vec_id"), dims.alias("dims"), F.when(narrow, x.cast("array<long>")).alias("codes"), F.when(~narrow, embedding).alias("wide")
    )


def _gather(rows: DataFrame, per: Column, name: str) -> DataFrame:
    """One row (dims, name, number of such, ids, codes, ids and components of wide vectors) for about ``per`` vectors of equal length."""
    counts = rows.groupBy("dims").agg((1 + F.floor((F.count(F.lit(1)) - 1) / F.first(per))).cast("int").alias(f"{name}s"))
    dealt = rows.join(counts, "dims").withColumn(name, F.pmod(F.xxhash64("vec_id", "codes", "wide"), F.col(f"{name}s")).cast("int"))

    def sides(group: pd.DataFrame, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
        held = group[group[column].notna()]
        ids = held["vec_id"].to_numpy(dtype=np.int64)
        codes = np.array(held[column].tolist(), dtype=kind).reshape(len(ids), int(group["dims"].iloc[0]))
        order = np.lexsort((*codes.T[::-1], ids))
        return ids[order], codes[order]

    def build(group: pd.DataFrame) -> pd.DataFrame:
        ids, codes = sides(group, "codes", np.int64)
        wide_ids, wide = sides(group, "wide", np.float64)
        row = {"dims": int(group["dims"].iloc[0]), name: group[name].iloc[0], f"{name}s": group[f"{name}s"].iloc[0], f"{name}_ids": ids.tobytes(),
               f"{name}_rows": codes.astype("<i4").tobytes(), f"{name}_wide_ids": wide_ids.tobytes(), f"{name}_wide": wide.tobytes()}
        return pd.DataFrame([row])

    schema = f"dims int, {name} int, {name}s int, {name}_ids binary, {name}_rows binary, {name}_wide_ids binary, {name}_wide binary"
    return settle(dealt.groupBy("dims", name).applyInPandas(build, schema), name)


def sliced(blocks: DataFrame) -> DataFrame:
    """The written index: blocks with their slices."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for ids, rows, dims in zip(batch["block_ids"], batch["block_rows"], batch["dims"]):
                rows = np.frombuffer(rows, "<i4").reshape(len(ids) // 8, dims).astype(np.int64)
                slices, shift = Block.slice_rows(rows) if len(rows) else (np.empty(0, np.uint64), 0)
                made.append((slices.tobytes(), shift))
            yield batch.assign(slices=[m[0] for m in made], shift=[m[1] for m in made])

    return settle(blocks.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in blocks.dtypes) + ", slices binary, shift int"), "index")


def search(vectors: DataFrame, every: int = EVERY, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by ``every``."""
    rows = quantised(vectors, scale)
    blocks = sliced(_gather(rows, F.greatest(F.lit(LEAST_ROWS), F.floor(F.lit(BLOCK_BYTES) / (4 * F.col("dims") + 1))), "block"))
    chunks = _gather(rows.filter(F.col("vec_id") % every == 0), F.lit(CHUNK_QUERIES), "chunk")
    # A block goes once to a task that looks for many chunks in it; the queries are what is copied.
    chunks = chunks.withColumn("part", F.floor(F.col("chunk") / CHUNKS_TOGETHER).cast("int"))
    part_counts = chunks.select("dims", F.ceil(F.col("chunks") / CHUNKS_TOGETHER).cast("int").alias("parts")).distinct()
    block_counts = blocks.select("dims", "blocks").distinct()
    left = blocks.join(part_counts, "dims").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = chunks.drop("chunks").join(block_counts, "dims").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    cells = left.join(right, ["dims", "block", "part"])

    def components(ids: bytes, wide: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
        values = np.frombuffer(wide, np.float64).reshape(len(ids) // 8, dims)
        return np.frombuffer(ids, np.int64), np.floor(values.astype(np.longdouble) * scale)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, at = None, None
        for batch in batches:
            for cell in batch.itertuples():
                if at != (cell.dims, cell.block):
                    ids = np.frombuffer(cell.block_ids, np.int64)
                    codes = np.frombuffer(cell.block_rows, "<i4").reshape(len(ids), cell.dims).astype(np.int64)
                    slices = np.frombuffer(cell.slices, np.uint64).reshape(cell.dims, SLICES, -1) if cell.dims and len(ids) else None
                    at, known = (cell.dims, cell.block), Block(ids, codes, slices, cell.shift) if len(ids) else None
                    wide_ids, wide = components(cell.block_wide_ids, cell.block_wide, cell.dims)
                ids = np.frombuffer(cell.chunk_ids, np.int64)
                queries = np.frombuffer(cell.chunk_rows, "<i4").reshape(len(ids), cell.dims).astype(np.int64)
                found = []
                for query_id, query in zip(ids.tolist(), queries):
                    near, scores = known.top(query_id, query, k) if known else ((), ())
                    best = np.lexsort((near, -scores))[:k] if known else np.empty(0, np.int64)
                    found += [(query_id, int(near[i]), int(scores[i])) for i in best.tolist()]
                    if len(wide_ids):
                        found += [(query_id, *pair) for pair in exact_top(wide_ids, wide, query_id, query.astype(np.longdouble), k)]
                for query_id, query in zip(*components(cell.chunk_wide_ids, cell.chunk_wide, cell.dims)):
                    if known:
                        found += [(int(query_id), *pair) for pair in exact_top(known.ids, known.rows.astype(np.longdouble), query_id, query, k)]
                    found += [(int(query_id), *pair) for pair in exact_top(wide_ids, wide, query_id, query, k)]
                made = [(q, i, min(max(s, LEAST), MOST), order_key(s)) for q, i, s in found]
                made = pd.DataFrame(made, columns=["query_id", "vec_id", "score", "beyond"])
                yield made.astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})

    wanted = ["dims", "block", "chunk", "block_ids", "block_rows", "block_wide_ids", "block_wide", "slices", "shift", "chunk_ids", "chunk_rows", "chunk_wide_ids", "chunk_wide"]
    found = cells.select(*wanted).mapInPandas(run, "query_id long, vec_id long, score long, beyond binary")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SEARCH_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= {TOP}
"""
