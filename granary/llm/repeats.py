"""Substring de-duplication with prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words of one document; a word goes when a window over
it also starts earlier (smaller doc_id, or earlier in the same document).

Suffixes are dealt into groups small enough for memory, so that all suffixes that
share ``WINDOW`` words are in one group:

1. Every window has an anchor, the least hash among its ``PREFIX``-word runs;
   neighbouring windows mostly share theirs. Equal windows have equal anchors, so
   anchors are the prefixes that groups are made of, about one for eight words.
   Anchors found once in all documents are leaves, and are dropped.
2. For every other anchor, the words of its windows go to its group. There the
   suffixes are sorted to their ends by doubling prefixes (1, 2, 4, ... words), and the words that
   neighbours in that order share are the depths of the subtree's inner nodes. From the deepest node up to the
   depth of a window, a node hands its earliest suffix to its parent; every other suffix repeats the node's
   words, the longest run it shares with an earlier one. Runs of a segment that overlap go on as one span.
3. Groups of more than ``CROWDED`` anchors take the longest prefix instead, the whole
   window. Their windows are folded within each block first, so a passage that a third of
   the documents share sends one row for each block and window, to groups of their own.

Documents are handled in blocks of about ``BLOCK_BYTES``, ranges of a hash of doc_id and text, so
rows under one doc_id (or none) are spread over all blocks; texts move compressed.

Nulls: a null text has no words; a null doc_id comes before all others. Rows that repeat a
document whole (doc_id and text) are judged as one and all get its result; different
texts under one doc_id are ordered by a hash of both. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import Words, plain, slices, words_of
from granary.sources.workspace import settle

WINDOW = 20
PREFIX = 6
CROWDED = 50_000
BLOCK_BYTES = 4 << 20
REACH = 2 * WINDOW - PREFIX  # words of an anchor's segment, at most: windows that all hold the anchor
GROUP_WORDS = 400_000  # words sorted at a time
FIRST = -(1 << 63)  # stands for a null doc_id in the order of documents

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
if len(ODD) != PREFIX:
    raise ValueError("one multiplier for each word of a prefix")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(w, seed) for w in words.names.to_pylist()), np.uint64, len(words.names))[words.codes]


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first window, windows, text) of every run of windows with one anchor; windows are places in ``words``."""
    n = len(words.codes)
    if n < WINDOW:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    hashes = word_hashes(words)
    m = n - PREFIX + 1
    runs = np.zeros(m, dtype=np.uint64)
    for j in range(PREFIX):
        runs += hashes[j : j + m] * ODD[j]
    runs = _mixed(runs)
    span = WINDOW - PREFIX + 1
    best, at, width = runs, np.arange(m), 1
    while width < span:  # the leftmost least of twice as many, or of as many as are still missing
        step = min(width, span - width)
        left, right = best[: len(best) - step], best[step:]
        later = right < left
        best, at = np.where(later, right, left), np.where(later, at[step:], at[: len(at) - step])
        width += step
    owner = words.owners()
    whole = owner[: n - WINDOW + 1] == owner[WINDOW - 1 :]
    starts = np.flatnonzero(whole)
    at, text = at[starts], owner[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]) if len(starts) else np.empty(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(starts)]]))
    return runs[at[first]], starts[first], count, text[first]


def _in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """With ``mark``, 32 bits of a hash of doc_id and text, and ``block``, one of so many ranges of it: texts under one id have the same order for any number of blocks."""
    hashed = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    marked = docs.withColumn("mark", F.shiftrightunsigned(hashed, 32))
    return marked.withColumn("block", F.shiftright(F.col("mark") * F.lit(blocks).cast("long"), 32).cast("int"))


def _anchor_rows(blocks: DataFrame) -> DataFrame:
    """(key, block, n) of all anchors, folded within a slice."""

    def run(batches):
        for part in slices(batches):
            keys, _, _, text = anchors(words_of(part.column("text")))
            block = part.column("block").to_numpy()[text].astype(np.int64)
            order = np.lexsort((block, keys))
            keys, block = keys[order].view(np.int64), block[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (block[1:] != block[:-1])])) if len(keys) else np.empty(0, np.int64)
            n = np.diff(np.concatenate([first, [len(keys)]]))
            yield pa.record_batch([pa.array(keys[first]), pa.array(block[first].astype(np.int32)), pa.array(n.astype(np.int32))], names=["key", "block", "n"])

    return blocks.select("text", "block").mapInArrow(run, "key long, block int, n int")


def _packed(blocks: DataFrame) -> DataFrame:
    """(doc_id, mark, block, packed): the texts compressed for the way to their block."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for part in slices(batches):
            packed = [None if t is None else squeeze(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.record_batch([*(part.column(c) for c in ("doc_id", "mark", "block")), pa.array(packed, pa.binary())], names=["doc_id", "mark", "block", "packed"])

    return blocks.select("doc_id", "mark", "block", "text").mapInArrow(run, "doc_id long, mark long, block int, packed binary")


def _unpacked(table: pa.Table) -> list[tuple[int, int, list[int], str]]:
    """(doc_id, number among the texts of that id, rows, text) of the different documents of a block."""
    spread = zstandard.ZstdDecompressor()
    seen: dict[tuple, list[int]] = {}
    for i, (doc_id, mark, packed) in enumerate(zip(*(table.column(c).to_pylist() for c in ("doc_id", "mark", "packed")))):
        text = "" if packed is None else spread.decompress(packed).decode()
        seen.setdefault((FIRST if doc_id is None else doc_id, mark, text), []).append(i)
    numbers: dict[int, int] = {}
    out = []
    for doc, mark, text in sorted(seen):
        out.append((doc, numbers.setdefault(doc, 0), seen[doc, mark, text], text))
        numbers[doc] += 1
    return out


def _slices(documents: list[tuple[int, int, list[int], str]]):
    """Documents with their words, some at a time."""
    at = 0
    while at < len(documents):
        to, size = at, 0
        while to < len(documents) and (to == at or size < 1 << 20):
            size += len(documents[to][3])
            to += 1
        part = documents[at:to]
        yield part, words_of(pa.array([d[3] for d in part], pa.string()))
        at = to


SEGMENTS = "key long, doc long, block int, number int, start int, words string, end int"
PLACES = ("doc", "block", "number", "start")  # in the order of documents


def _segments(packed: DataFrame, kept: DataFrame) -> DataFrame:
    """What goes to the groups, for the anchors (block, key, crowded) in ``kept``.

    Usual anchors send the words of their windows. Windows of crowded ones are folded within the block first: those that
    are found earlier in the block are repeats at once (rows with ``end`` and no words), the others go alone, by their own hash.
    """
    kinds = {"key": pa.int64(), "doc": pa.int64(), "block": pa.int32(), "number": pa.int32(), "start": pa.int32(), "words": pa.string(), "end": pa.int32()}

    def run(key, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        keys = wanted.column("key").to_numpy()
        order = np.argsort(keys)
        keys, crowded = keys[order], wanted.column("crowded").to_numpy(zero_copy_only=False)[order]
        out, seen = [], set()
        for part, words in _slices(_unpacked(docs)) if len(keys) else ():
            found, start, count, text = anchors(words)
            found = found.view(np.int64)
            place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = keys[place] == found
            found, start, count, text, many = found[hit], start[hit], count[hit], text[hit], crowded[place[hit]]
            doc = np.array([d[0] for d in part], dtype=np.int64)[text]
            number = np.array([d[1] for d in part], dtype=np.int32)[text]
            block = np.full(len(doc), key[0].as_py(), dtype=np.int32)
            inside = (start - words.starts[text]).astype(np.int32)
            few = np.flatnonzero(~many)
            length = count[few] + WINDOW - 1
            ends = np.cumsum(length)
            at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[few] - (ends - length), length)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), words.names.take(pa.array(words.codes[at])))
            columns = [pa.array(c[few]) for c in (found, doc, block, number, inside)] + [pc.binary_join(lists, " "), pa.nulls(len(few), pa.int32())]
            out.append(pa.table(columns, names=list(kinds)))
            crowd = np.flatnonzero(many)
            if len(crowd):
                rows = _folded(words, seen, *(c[crowd].tolist() for c in (doc, block, number, inside, start, count)))
                out.append(pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds)))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in kinds.values()], names=list(kinds))

    return packed.groupBy("block").cogroup(kept.groupBy("block")).applyInArrow(run, SEGMENTS)


def _folded(words: Words, seen: set[str], *runs: list) -> list[tuple]:
    """Rows of crowded anchors' windows, in the order of documents; ``seen`` holds the block's windows so far."""
    names = words.names.to_pylist()
    rows: list[tuple] = []
    for doc, block, number, inside, start, count in zip(*runs):
        named = [names[c] for c in words.codes[start : start + count + WINDOW - 1].tolist()]
        since = None
        for j in range(count + 1):
            window = " ".join(named[j : j + WINDOW]) if j < count else None
            if window is not None and window in seen:
                since = j if since is None else since
                continue
            if since is not None:
                rows.append((hash((doc, block, number, inside)), doc, block, number, inside + since, None, inside + j - 1 + WINDOW))
                since = None
            if window is not None:
                seen.add(window)
                rows.append((xxhash.xxh64_intdigest(window) - (1 << 63), doc, block, number, inside + j, window, None))
    return rows


def prefix_ranks(codes: np.ndarray, depths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Ranks, in the order of codes, of the suffixes at every place by their first words, for every depth of ``depths``, by doubling; places too near the end get what is there."""

    def pair(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        moved = np.zeros_like(right)
        moved[: len(right) - shift] = right[shift:] + 1 if shift < len(right) else 0
        return np.unique(left * (int(right.max(initial=0)) + 2) + moved, return_inverse=True)[1].ravel()

    powers = {1: np.unique(codes, return_inverse=True)[1].ravel().astype(np.int64)}
    width = 1
    while width * 2 <= max(depths):
        powers[width * 2] = pair(powers[width], powers[width], width)
        width *= 2
    out = {}
    for depth in depths:
        have = max(w for w in powers if w <= depth)
        ranks = powers[have]
        while have < depth:
            more = max(w for w in powers if w <= depth - have)
            ranks = pair(ranks, powers[more], have)
            have += more
        out[depth] = ranks
    return out


def shared_with_earlier(codes: np.ndarray, places: np.ndarray, age: np.ndarray) -> np.ndarray:
    """For each suffix at ``places`` how many words (none if below ``WINDOW``) it shares with an earlier one, one of less ``age``; at most ``REACH``.

    Each string in ``codes`` must end with a code of its own, found nowhere else; ages differ.
    """
    out = np.zeros(len(places), dtype=np.int64)
    if not len(places):
        return out
    ranks = prefix_ranks(codes, (4, 16, WINDOW))
    top = ranks[WINDOW][places]
    met = np.flatnonzero(np.bincount(top)[top] > 1)  # the others are leaves above the depth of a window
    beyond = len(codes) - 1
    order = met[np.lexsort((ranks[4][np.minimum(places[met] + 32, beyond)], ranks[16][np.minimum(places[met] + 16, beyond)], top[met]))]
    # Words shared with the next suffix in order: the depth of the lowest node above both.
    left, right = places[order[:-1]], places[order[1:]]
    same = np.flatnonzero(top[order[:-1]] == top[order[1:]])
    depth = np.zeros(len(left), dtype=np.int64)
    depth[same] = WINDOW
    for j in range(WINDOW, REACH):
        inside = same[np.maximum(left[same], right[same]) + j <= beyond]
        same = inside[codes[left[inside] + j] == codes[right[inside] + j]]
        if not len(same):
            break
        depth[same] += 1
    # Nodes from the deepest up: below each, all but the earliest suffix are settled, and that one stands for the node.
    for d in np.unique(depth[depth >= WINDOW])[::-1].tolist():
        first = np.concatenate([[0], np.flatnonzero(depth < d) + 1])
        sizes = np.diff(np.concatenate([first, [len(order)]]))
        years = age[order]
        stays = years == np.repeat(np.minimum.reduceat(years, first), sizes)
        out[order[~stays]] = d
        order, depth = order[stays], depth[first[1:] - 1]
    return out


def _tree_repeats(segments: DataFrame) -> DataFrame:
    """(doc, block, number, start, end): the words of repeats that are not the earliest below their node."""

    def judge(rows: pa.Table) -> pa.RecordBatch:
        words = words_of(rows.column("words").combine_chunks())
        n = len(words.starts) - 1
        ends = words.starts[1:] + np.arange(n)  # each segment gets an end of its own
        codes = np.empty(len(words.codes) + n, dtype=np.int64)
        is_end = np.zeros(len(codes), dtype=bool)
        is_end[ends] = True
        codes[~is_end], codes[ends] = words.codes, len(words.names) + np.arange(n)
        starts = words.starts[:-1] + np.arange(n)
        sizes = ends - starts - WINDOW + 1
        owner = np.repeat(np.arange(n), sizes)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        doc, block, number, start = (rows.column(c).to_numpy() for c in PLACES)
        age = np.empty(len(owner), dtype=np.int64)
        age[np.lexsort((start[owner] + step, number[owner], block[owner], doc[owner]))] = np.arange(len(owner))
        shared = shared_with_earlier(codes, starts[owner] + step, age)
        at = np.flatnonzero(shared)
        begin, owner = (starts[owner] + step)[at], owner[at]
        end = np.maximum.accumulate(begin + shared[at])  # never past a segment's own end
        new = np.concatenate([[True], begin[1:] > end[:-1]]) if len(at) else np.empty(0, bool)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1 if len(first) else first
        mine = owner[first]
        ahead = start[mine] - starts[mine]
        made = (doc[mine], block[mine], number[mine], (begin[first] + ahead).astype(np.int32), (end[last] + ahead).astype(np.int32))
        return pa.record_batch([pa.array(m) for m in made], names=[*PLACES, "end"])

    def run(batches):
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            known = pc.is_valid(table.column("end"))
            if pc.any(known).as_py():
                direct = table.filter(known).select([*PLACES, "end"])
                yield from direct.combine_chunks().to_batches()
                table = table.filter(pc.invert(known))
            if not table.num_rows:
                continue
            held.append(table)
            size += 27 * table.num_rows
            if size < GROUP_WORDS:
                continue
            whole = pa.concat_tables(held)
            keys = whole.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], side="left"))  # the last key may go on in the next batch
            if cut:
                at = 0
                while at < cut:  # whole keys, some at a time
                    to = min(cut, at + GROUP_WORDS // 27)
                    to = int(np.searchsorted(keys, keys[to - 1], side="right"))
                    yield judge(whole.slice(at, to - at))
                    at = to
            held, size = [whole.slice(cut)], 27 * (len(keys) - cut)
        if held:
            yield judge(pa.concat_tables(held))

    grouped = segments.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(run, "doc long, block int, number int, start int, end int")


def _cut(packed: DataFrame, spans: DataFrame, keep_text: bool) -> DataFrame:
    """Every row without the words under its document's spans."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "mark", "text"][: 6 if keep_text else 4]

    def run(key, docs: pa.Table, found: pa.Table) -> pa.Table:
        by: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for doc, number, start, end in zip(*(found.column(c).to_pylist() for c in ("doc", "number", "start", "end"))):
            by.setdefault((doc, number), []).append((start, end))
        out: list[tuple] = []
        for part, words in _slices(_unpacked(docs)):
            edge = np.zeros(len(words.codes) + 1, dtype=np.int64)
            for (doc, number, _, _), at in zip(part, words.starts.tolist()):
                for start, end in by.get((doc, number), ()):
                    edge[at + start] += 1
                    edge[at + end] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            removed = words.per_text(gone)
            left = np.diff(words.starts) - removed
            offsets = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            texts = pc.binary_join(pa.ListArray.from_arrays(offsets, words.names.take(pa.array(words.codes[~gone]))), " ").to_pylist()
            for (doc, _, rows, old), n, cut, text in zip(part, np.diff(words.starts).tolist(), removed.tolist(), texts):
                row = (None if doc == FIRST else doc, n, cut, hashlib.sha256(text.encode()).hexdigest())
                out += [(*row, xxhash.xxh64_intdigest(old, 42), text if cut else old) if keep_text else row] * len(rows)
        columns = list(zip(*out)) if out else [()] * len(names)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.uint64(), pa.string())
        made = [pa.array(c, t) for c, t in zip(columns, kinds)]
        if keep_text:
            made[4] = made[4].view(pa.int64())
        return pa.table(made, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", mark long, text string" * keep_text
    return packed.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, keep_text: bool = False, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, mark, text]) for every row.

    ``mark`` is a hash of the old text; ``text`` is the old text where no word went, else the words kept, joined by one space.
    """
    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_blocks = 1 + (wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    blocks = _in_blocks(wanted, n_blocks)
    rows, packed = _anchor_rows(blocks), _packed(blocks)
    again = rows.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key", (F.col("n") > crowded).alias("crowded"))
    kept = rows.select("key", "block").join(settle(again, "anchors"), "key").distinct()
    spans = _tree_repeats(_segments(packed, kept))
    return _cut(packed, spans, keep_text)


def _sql_words(text: str) -> str:
    return rf"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


REPEATS_SQL = f"""
WITH d AS (
  SELECT doc_id, {_sql_words("text")} AS w FROM documents
), p AS (
  SELECT doc_id, CAST(i AS BIGINT) AS i, sha256(array_to_string(w[i : i + {WINDOW - 1}], ' ')) AS h
  FROM d, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS t(i) WHERE len(w) >= {WINDOW}
), r AS (
  SELECT doc_id, i FROM p QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS j FROM r, generate_series(0, {WINDOW - 1}) AS t(k)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM d
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.j) AS text, count(*) AS n
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.j = words.j WHERE gone.j IS NULL GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
