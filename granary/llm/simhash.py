"""Near duplicates by SimHash fingerprints, found with BK-trees.

A fingerprint has 64 bits; two documents are linked when theirs differ in at
most ``RADIUS`` bits, and a component is what links reach.

Equal fingerprints are folded into one row first, so copies never meet in a
group. With radius 2, two of the four 16-bit quarters of linked fingerprints
agree, so each fingerprint enters six shards, one for each pair of quarters.
Every shard with two or more members has a BK-tree: children are keyed by their
integer distance to the parent, and a search follows only edges within the
radius. A shard's tree is asked for that shard's members alone, so it is built
in the task that holds them instead of being broadcast, which would grow with
the data. Shards above ``SHARD_ROWS`` are cut again by the thirds of their other
32 bits, one of which linked members share. A shard reports one link per member
and component, never all its pairs.

``near_copies`` is for pipelines: texts are linked when the Jaccard similarity of their sets of ``COPY_SHINGLE`` lower-case words in
a row is ``COPY_SIMILARITY`` or more. Such texts are some ten bits apart, too many for quarters, so shards are the texts with
equal MinHash bands. BK-trees with the wide radius propose links within a shard, and the shingles of the texts
decide each of them. Equal sets are folded first, and equal groups of several shards are examined once.

Nulls: a null text is an empty one, with fingerprint zero. A null doc_id stands for no number;
a component without any other id has a null component_id. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.graphs import components
from granary.llm.text import slices, text_mark, word_lists
from granary.sources.workspace import settle

SHINGLE = 3
SEED = 42
RADIUS = 2
SHARD_ROWS = 20_000
COPY_SHINGLE = 5
COPY_SIMILARITY = 0.8
COPY_RADIUS = 20  # fingerprints of sets with similarity 0.8 are 9.7 bits apart on average
BANDS = 12
BAND_HASHES = 3  # least hashes in a band; a pair of similarity 0.8 has a band in common with a chance of 1 - (1 - 0.8^3)^12 = 0.9998
QUARTERS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's shingles of ``width`` words with repeats, in order, and how many each text has."""
    flat, starts = word_lists(texts, lower=True)
    if not len(flat):
        return np.empty(0, dtype=np.uint64), np.zeros(len(starts) - 1, dtype=np.int64)
    data = " ".join(flat.to_pylist()).encode()
    ends = np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    counts = np.diff(starts)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    offset = np.concatenate([[0], np.cumsum(shingles)])
    owner = np.repeat(np.arange(len(counts)), shingles)
    first = np.arange(offset[-1]) - offset[owner] + starts[owner]
    last = np.minimum(first + width, starts[owner + 1]) - 1
    of = xxhash.xxh64_intdigest
    hashes = np.fromiter((of(data[a:b], SEED) for a, b in zip(begins[first].tolist(), ends[last].tolist())), np.uint64, len(first))
    return hashes, shingles


def fingerprints(texts: pa.Array, width: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of every text, over shingles of ``width`` words with repeats."""
    return _majority(*shingle_hashes(texts, width))


def _majority(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    out = np.zeros(len(shingles), dtype=np.uint64)
    if not len(hashes):
        return out
    offset = np.concatenate([[0], np.cumsum(shingles)])
    full = np.flatnonzero(shingles)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, offset[full], axis=0, dtype=np.int32)
    major = (2 * ones > shingles[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp): a hash of the text, and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            made = fingerprints(part.column("text")).view(np.int64)
            yield pa.record_batch([part.column("doc_id"), part.column("mark"), pa.array(made)], names=["doc_id", "mark", "fp"])

    wanted = docs.select(F.col("doc_id").cast("long"), text_mark("text").alias("mark"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, "doc_id long, mark long, fp long")


class BKTree:
    """Integers under Hamming distance; the children of a node are keyed by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        at = 0
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at most ``radius`` away."""
        return list(self.nearby(value, radius))

    def nearby(self, value: int, radius: int) -> Iterator[int]:
        """Places of the values at most ``radius`` away, as the search meets them."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                yield at
            kids = self.children[at]
            for edge in range(max(0, distance - radius), distance + radius + 1):
                if edge in kids:
                    todo.append(kids[edge])


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """One link from each member to the first of its component within the shard."""
    tree, parent = BKTree(), list(range(len(members)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    parts = 0
    for i, value in enumerate(members):
        parts += 1
        for j in tree.nearby(value, radius):
            a, b = top(i), top(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                parts -= 1
            if parts == 1:
                break  # all seen so far are connected
        tree.add(value)
    return [(members[i], members[top(i)]) for i in range(len(members)) if top(i) != i]


def _quarter_keys(fp: str) -> list:
    quarters = [F.shiftrightunsigned(F.col(fp), 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    return [
        F.struct(
            (F.lit(n << 32) + quarters[a] * 65536 + quarters[b]).alias("shard"),
            *(quarters[c].alias(f"rest{i}") for i, c in enumerate(sorted({0, 1, 2, 3} - {a, b}))),
        )
        for n, (a, b) in enumerate(QUARTERS)
    ]


def links(classes: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b) links between the distinct fingerprints ``fp``, enough to connect every component."""
    if not 0 <= radius <= 2:
        raise ValueError("four quarters serve a radius of 0 to 2")
    keyed = classes.select("fp", F.explode(F.array(*_quarter_keys("fp"))).alias("k")).select("fp", "k.*")
    crowded = keyed.groupBy("shard").count().filter("count > 1")
    keyed = keyed.join(crowded, "shard")
    rest = F.col("rest0") * 65536 + F.col("rest1")
    thirds = F.array(
        F.shiftright(rest, 21), F.lit(1 << 12) + F.shiftright(rest, 10).bitwiseAND(F.lit(0x7FF)), F.lit(1 << 13) + rest.bitwiseAND(F.lit(0x3FF))
    )
    keyed = keyed.withColumn("third", F.explode(F.when(F.col("count") > shard_rows, thirds).otherwise(F.array(F.lit(-1).cast("long")))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def flush(found):
            if len(members) > 1:
                found += shard_links(members, radius)

        for batch in batches:
            found: list[tuple[int, int]] = []
            for shard, third, fp in zip(*(batch.column(c).to_pylist() for c in ("shard", "third", "fp"))):
                if (shard, third) != key:
                    flush(found)
                    key, members = (shard, third), []
                members.append(fp & 0xFFFFFFFFFFFFFFFF)
            yield _pairs(found)
        found = []
        flush(found)
        yield _pairs(found)

    return (
        keyed.repartition("shard", "third").sortWithinPartitions("shard", "third", "fp").select("shard", "third", "fp")
        .mapInArrow(run, "a long, b long").distinct()
    )


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    made = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.record_batch([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id, mark, root) for every row of documents.

    ``mark`` is a hash of the text, ``root`` one fingerprint of the component, which tells components apart where ids repeat.
    """
    prints = settle(fingerprint_table(docs), "fingerprints")
    classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined = components(links(classes, radius))
    roots = classes.join(joined.withColumnRenamed("node", "fp"), "fp")
    smallest = roots.groupBy("root").agg(F.min("first").alias("least"))
    moved = roots.join(smallest, "root").select("fp", "least", "root")
    alone = F.col("root").isNull()
    owner = classes.join(moved, "fp", "left").select(
        "fp", F.when(alone, F.col("first")).otherwise(F.col("least")).alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return prints.join(owner, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "mark", "root"
    )


def shingle_sets(texts: pa.Array, width: int = COPY_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of every text's shingles in ascending order, and how many each text has."""
    hashes, counts = shingle_hashes(texts, width)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(counts))


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    mixed = hashes ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def copy_prints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every text: a hash of its set of shingles, the set's SimHash, and its MinHash bands as rows."""
    hashes, counts = shingle_sets(texts)
    same, bands = np.zeros(len(counts), dtype=np.uint64), np.zeros((len(counts), BANDS), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        at = np.concatenate([[0], np.cumsum(counts)])[full]
        same[full] = np.add.reduceat(_mixed(hashes, 0), at)
        for b in range(BANDS):
            key = np.full(len(full), b, dtype=np.uint64)
            for i in range(BAND_HASHES):
                key = _mixed(key, 1) + np.minimum.reduceat(_mixed(hashes, 2 + b * BAND_HASHES + i), at)
            bands[full, b] = key
    return same, _majority(hashes, counts), bands


def _copy_table(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, same, fp, bands) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            same, fp, bands = copy_prints(part.column("text"))
            lists = pa.ListArray.from_arrays(np.arange(len(same) + 1, dtype=np.int32) * BANDS, pa.array(bands.view(np.int64).ravel()))
            made = [pa.array(same.view(np.int64)), pa.array(fp.view(np.int64)), lists]
            yield pa.record_batch([part.column("doc_id"), part.column("mark"), *made], names=["doc_id", "mark", "same", "fp", "bands"])

    wanted = docs.select(F.col("doc_id").cast("long"), text_mark("text").alias("mark"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, "doc_id long, mark long, same long, fp long, bands array<long>")


def _proposed(classes: DataFrame) -> DataFrame:
    """(grp, same): the groups of two or more that BK-trees connect within a shard; equal groups of several shards are one."""
    keyed = classes.select("same", "fp", F.explode("bands").alias("shard"))
    keyed = keyed.join(keyed.groupBy("shard").count().filter("count > 1").select("shard"), "shard")

    def groups(members: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        prints = sorted({fp for fp, _ in members})
        first = dict(shard_links(prints, COPY_RADIUS))
        found: dict[int, list[int]] = {}
        for fp, same in members:
            found.setdefault(first.get(fp, fp), []).append(same)
        for part in found.values():
            if len(part) > 1:
                name = xxhash.xxh64_intdigest(np.sort(np.array(part, dtype=np.int64)).tobytes(), SEED)
                yield from ((name, same) for same in part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for shard, fp, same in zip(*(batch.column(c).to_pylist() for c in ("shard", "fp", "same"))):
                if shard != key:
                    found += groups(members)
                    key, members = shard, []
                members.append((fp & 0xFFFFFFFFFFFFFFFF, same))
            yield _grouped(found)
        yield _grouped(list(groups(members)))

    dealt = keyed.repartition("shard").sortWithinPartitions("shard", "fp").select("shard", "fp", "same")
    return dealt.mapInArrow(run, "grp long, same long").distinct()


def _grouped(found: list[tuple[int, int]]) -> pa.RecordBatch:
    names = np.array([g for g, _ in found], dtype=np.uint64).view(np.int64)
    return pa.record_batch([pa.array(names), pa.array([s for _, s in found], pa.int64())], names=["grp", "same"])


def similar_links(members: list[tuple[int, int, np.ndarray]], least: float = COPY_SIMILARITY) -> list[tuple[int, int]]:
    """Links between (name, fingerprint, shingles) of similarity ``least`` or more, enough to connect what they connect.

    Every proposal of the tree is decided by the shingles, except between members that are connected already.
    """
    tree, at_print, parent = BKTree(), {}, list(range(len(members)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out, parts = [], 0
    for i, (name, fp, mine) in enumerate(members):
        parts += 1
        alone = parts == 1
        for place in () if alone else tree.nearby(fp, COPY_RADIUS):
            for j in at_print[tree.values[place]]:
                a, b = top(i), top(j)
                if a != b:
                    theirs = members[j][2]
                    both = min(len(mine), len(theirs))
                    if both >= least * max(len(mine), len(theirs)):
                        common = len(np.intersect1d(mine, theirs, assume_unique=True))
                        if common >= least * (len(mine) + len(theirs) - common):
                            parent[max(a, b)] = min(a, b)
                            out.append((name, members[j][0]))
                            parts -= 1
            if parts == 1:
                break  # all seen so far are connected
        if fp not in at_print:
            at_print[fp] = []
            tree.add(fp)
        at_print[fp].append(i)
    return out


def _decided(docs: DataFrame, proposed: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the links of every proposed group that the texts' shingles bear out."""
    wanted = proposed.select("same").distinct().join(classes.select("same", "fp", "mark"), "same")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(text_mark("text").alias("mark"), text.alias("text")).join(wanted.select("mark"), "mark", "left_semi")
    texts = texts.groupBy("mark").agg(F.first("text").alias("text"))
    rows = proposed.join(wanted.join(texts, "mark").select("same", "fp", "text"), "same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for part in slices(batches):
            found: list[tuple[int, int]] = []
            hashes, counts = shingle_sets(part.column("text"))
            sets = np.split(hashes, np.cumsum(counts)[:-1])
            for grp, fp, same, mine in zip(*(part.column(c).to_pylist() for c in ("grp", "fp", "same")), sets):
                if grp != key:
                    found += similar_links(members)
                    key, members = grp, []
                members.append((same, fp & 0xFFFFFFFFFFFFFFFF, mine.copy()))
            yield _linked(found)
        yield _linked(similar_links(members))

    dealt = rows.repartition("grp").sortWithinPartitions("grp", "fp", "same").select("grp", "fp", "same", "text")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _linked(found: list[tuple[int, int]]) -> pa.RecordBatch:
    made = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, component_id, root) for every row: components of texts of similarity ``COPY_SIMILARITY``, the ids as in ``near_duplicates``."""
    prints = settle(_copy_table(docs), "copy-prints")
    same = prints.groupBy("same").agg(F.min("doc_id").alias("first"), F.min(F.struct("mark", "fp", "bands")).alias("one"))
    classes = settle(same.select("same", "first", "one.*"), "copy-classes")
    shingled = classes.filter("same <> 0")
    proposed = settle(_proposed(shingled), "copy-groups")
    joined = components(_decided(docs, proposed, shingled))
    roots = classes.select("same", "first").join(joined.withColumnRenamed("node", "same"), "same", "left").withColumn("root", F.coalesce("root", "same"))
    owner = roots.join(roots.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("same", "root", "component_id")
    return prints.select("doc_id", "mark", "same").join(owner, "same").select("doc_id", "mark", "component_id", "root")
