"""Benchmark decontamination with a distributed positional inverted index.

The index is a written table. Documents are taken in slices of a few megabytes, and
every slice stores, for each term, the ascending places of its occurrences, and one row
with its documents. Places count the words of a slice, with one place left free after
each document, so that no phrase reaches over a document's end.

A search for phrases (windows of an item's words):

1. Counts of the phrases' terms are added up over the index; a phrase's rarest term
   decides in which slices it can be, by a join on the term. A phrase with a term found nowhere goes.
2. The lists of the phrases' terms meet the items' segments slice by slice. There
   each list is moved by the term's place in the phrase, and the lists are intersected from
   the rarest on: all phrases of a slice at once, as a search in one sorted array of (term, place).
3. Proximity: the words in order with up to ``slop`` others among them. The same search, with
   ranges in place of places, leaves the starts that a walk from word to next word confirms.

No list of a hot term is ever whole: it is cut by slices, as is the work. Items are cut in
segments of ``SEGMENT`` phrases. Nothing is gathered on the driver.

Nulls: a null text has no words and is not hit; every row, null or repeated doc_id included, has a row of its
own in the result. A null item_id is written ``null``; rows with one item_id are one item. Equal phrases of
several items count for each. An empty table of documents gives an empty result, an empty benchmark one without hits.
Only the named columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import slices
from granary.llm.tokens import kinds, tokens_of
from granary.sources.workspace import settle

WINDOW = 10
SLOP = 2
SEGMENT = 64  # phrases of an item that travel together
SLICE_BYTES = 8 << 20
SEEDS = 1 << 20  # places looked at together
LETTERS = kinds(blank=[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LETTERS[ord("A") : ord("Z") + 1] = 0  # they are lowered

INDEX = "slice long, term string, n int, places binary"
DOCUMENTS = pa.schema([("key", pa.string()), ("start", pa.int32()), ("words", pa.int32())])


def _sent(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The written index: rows (slice, term, n, places) and, with a null term, the documents of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, limit=slice_bytes):
            found = tokens_of(part.column("text"), LETTERS)
            start = np.cumsum(found.counts + 1) - found.counts - 1
            table = pa.record_batch([part.column("key"), pa.array(start.astype(np.int32)), pa.array(found.counts.astype(np.int32))], schema=DOCUMENTS)
            yield pa.record_batch([pa.array([number]), pa.nulls(1, pa.string()), pa.array([len(part)], pa.int32()), pa.array([_sent(table)], pa.binary())], names=["slice", "term", "n", "places"])
            if len(found.codes):
                order = np.argsort(found.codes, kind="stable")
                places = (np.arange(len(order)) + found.text).astype("<i4")[order]
                n = np.bincount(found.codes, minlength=len(found.names)).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(n) * 4]).astype(np.int32)
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(places)])
                yield pa.record_batch([pa.array(np.full(len(n), number)), found.names, pa.array(n), lists], names=["slice", "term", "n", "places"])
            number += 1

    wanted = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return settle(wanted.mapInArrow(run, INDEX), "index")


def segments(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, words) of every part of an item with up to ``SEGMENT`` phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = tokens_of(part.column("text"), LETTERS)
            names, ends = found.names.take(pa.array(found.codes)).to_pylist(), np.cumsum(found.counts)
            keys, lists = [], []
            for item, n, end in zip(part.column("item").to_pylist(), found.counts.tolist(), ends.tolist()):
                for at in range(0, max(1, n - window + 1), SEGMENT) if n else ():
                    keys.append(item)
                    lists.append(names[end - n + at : min(end, end - n + at + SEGMENT + window - 1)])
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(lists, pa.list_(pa.string()))], names=["item", "words"])

    wanted = items.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").alias("text"))
    return settle(wanted.distinct().mapInArrow(run, "item string, words array<string>"), "segments")


def _where(index: DataFrame, parts: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The terms of all phrases, and (slice, item, words) of the segments that may occur in a slice."""
    terms = settle(parts.select(F.explode("words").alias("term")).distinct(), "terms")
    lists = index.where("term is not null").select("slice", "term", "n").join(terms, "term")
    counts = lists.groupBy("term").agg(F.sum("n").alias("n"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    phrases = parts.select("item", "words", F.explode(starts).alias("at"))
    phrases = phrases.select("item", "words", F.slice("words", F.col("at") + 1, window).alias("phrase"))
    one = phrases.select("phrase").distinct()
    known = one.select("phrase", F.explode(F.array_distinct("phrase")).alias("term")).join(counts, "term", "left")
    rarest = known.groupBy("phrase").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("least"))
    rarest = rarest.where("least.n > 0").select("phrase", F.col("least.term").alias("term"))
    asked = phrases.join(rarest, "phrase").select("item", "words", "term").distinct()
    return terms, asked.join(lists.select("slice", "term"), "term").select("slice", "item", "words").distinct()


class Lists:
    """Posting lists of one slice as a sorted array of (term, place)."""

    def __init__(self, terms: list[str], n: np.ndarray, places: np.ndarray):
        self.codes = {t: i for i, t in enumerate(terms)}
        self.n = n
        self.begins = np.cumsum(n) - n
        self.keys = (np.repeat(np.arange(len(n), dtype=np.int64), n) << 32) | places

    def next(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The first occurrence of each term at or after a place; far away if there is none."""
        at = np.searchsorted(self.keys, (codes << 32) | places)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        there = (at < len(self.keys)) & (found >> 32 == codes)
        return np.where(there, found & 0xFFFFFFFF, 1 << 40)

    def seeds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) of every occurrence of the term of each row."""
        n = self.n[codes]
        rows = np.repeat(np.arange(len(codes)), n)
        step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        return rows, self.keys[self.begins[codes][rows] + step] & 0xFFFFFFFF

    def matches(self, phrases: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first place, last place) where a phrase's words come in order among at most ``slop`` others."""
        length = phrases.shape[1]
        counts = self.n[phrases]
        order = np.argsort(counts, axis=1, kind="stable")
        ends = np.cumsum(np.take_along_axis(counts, order[:, :1], 1).ravel())
        out = []
        at = 0
        while at < len(phrases):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SEEDS // (slop + 1), side="right")))
            first = order[at:to, 0]
            row, place = self.seeds(phrases[np.arange(at, to), first])
            start = place - first[row]
            row += at
            if slop:  # the seed may stand up to slop places later than in the phrase itself
                row, start = np.repeat(row, slop + 1), (start[:, None] - np.arange(slop + 1)).ravel()
            keep = start >= 0
            row, start = row[keep], start[keep]
            for r in range(0 if slop else 1, length):  # offset-adjusted lists, from the rarest on
                shift = order[row, r]
                there = self.next(phrases[row, shift], start + shift) <= start + shift + slop
                row, start = row[there], start[there]
            last = start
            if slop:
                row, start = np.unique(np.stack([row, start]), axis=1)
                last, right = start, self.next(phrases[row, 0], start) == start
                row, start, last = row[right], start[right], last[right]
                for r in range(1, length):
                    last = self.next(phrases[row, r], last + 1)
                    near = last - start < length + slop
                    row, start, last = row[near], start[near], last[near]
            else:
                last = start + length - 1
            out.append((row, start, last))
            at = to
        return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.empty(0, np.int64) for _ in range(3))


FOUND = {"key": pa.string(), "n_words": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "items": pa.list_(pa.string()), "near": pa.list_(pa.string())}


def _pairs(text: np.ndarray, row: np.ndarray, owners: list[np.ndarray], items: np.ndarray) -> dict[int, list[str]]:
    """The items of every document, from the phrases found in it."""
    out: dict[int, set] = {}
    for doc, phrase in np.unique(np.stack([text, row]), axis=1).T.tolist():
        out.setdefault(doc, set()).update(owners[phrase].tolist())
    return {doc: sorted(items[list(found)].tolist()) for doc, found in out.items()}


def _search_slice(lists: Lists, docs: pa.Table, parts: pa.Table, window: int, slop: int) -> pa.Table:
    start, n = docs.column("start").to_numpy().astype(np.int64), docs.column("words").to_numpy().astype(np.int64)
    covered = np.zeros(int((start + n).max(initial=0)) + 2, dtype=np.int64)
    names = parts.column("item").to_numpy(zero_copy_only=False)
    items, owner = np.unique(names, return_inverse=True) if len(names) else (np.empty(0, object), np.empty(0, np.int64))
    exact: dict[int, list[str]] = {}
    near: dict[int, list[str]] = {}
    by_length: dict[int, list[tuple[list[int], int]]] = {}
    for item, words in zip(owner.tolist(), parts.column("words").to_pylist()):
        codes = [lists.codes.get(w, -1) for w in words]
        length = min(window, len(codes))
        for i in range(len(codes) - length + 1):
            phrase = codes[i : i + length]
            if min(phrase) >= 0:
                by_length.setdefault(length, []).append((phrase, item))

    def collect(into: dict[int, list[str]], more: dict[int, list[str]]) -> None:
        for doc, found in more.items():
            into[doc] = sorted({*into.get(doc, ()), *found})

    for length, rows in by_length.items():
        phrases, which = np.unique(np.array([p for p, _ in rows], dtype=np.int64), axis=0, return_inverse=True)
        which = which.ravel()
        order = np.argsort(which, kind="stable")
        owners = np.split(np.array([i for _, i in rows])[order], np.cumsum(np.bincount(which))[:-1])
        row, first, last = lists.matches(phrases, 0)
        np.add.at(covered, first, 1)
        np.add.at(covered, last + 1, -1)
        collect(exact, _pairs(np.searchsorted(start, first, side="right") - 1, row, owners, items))
        if slop:
            row, first, last = lists.matches(phrases, slop)
            text = np.searchsorted(start, first, side="right") - 1
            inside = last < (start + n)[text]
            collect(near, _pairs(text[inside], row[inside], owners, items))
    hit = np.zeros(len(covered) + 1, dtype=np.int8)
    hit[1:] = np.cumsum(covered) > 0
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    left, right = edges[0::2], edges[1::2]
    text = np.searchsorted(start, left, side="right") - 1
    spans: dict[int, list[dict]] = {}
    for doc, a, b in zip(text.tolist(), (left - start[text]).tolist() if len(text) else (), (right - start[text]).tolist() if len(text) else ()):
        spans.setdefault(doc, []).append({"start": a, "end": b})
    every = range(len(n))
    made = (docs.column("key"), pa.array(n), [spans.get(i, []) for i in every], [exact.get(i, []) for i in every], [near.get(i, []) for i in every])
    return pa.table([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t) for c, t in zip(made, FOUND.values())], names=list(FOUND))


def find_phrases(index: DataFrame, parts: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """(key, n_words, spans, items, near) of every document of an index.

    ``spans`` are the words inside exact matches; ``items`` have an exact match there, ``near`` one with up to ``slop`` other words in it.
    """
    terms, asked = _where(index, parts, window)
    lists = index.where("term is not null").join(terms, "term").unionByName(index.where("term is null"))

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        is_docs = np.array(left.column("term").is_null())
        if not is_docs.any():
            return pa.table([pa.array([], t) for t in FOUND.values()], names=list(FOUND))
        docs = pa.ipc.open_stream(left.column("places")[int(np.flatnonzero(is_docs)[0])].as_py()).read_all()
        rows = left.filter(pa.array(~is_docs))
        places = np.frombuffer(b"".join(rows.column("places").to_pylist()), dtype="<i4").astype(np.int64)
        found = Lists(rows.column("term").to_pylist(), rows.column("n").to_numpy().astype(np.int64), places)
        return _search_slice(found, docs, right, window, slop)

    schema = "key string, n_words long, spans array<struct<start: int, end: int>>, items array<string>, near array<string>"
    return lists.groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(run, schema)


def contaminated(docs: DataFrame, items: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) for every document.

    ``n_near`` counts the items with a phrase within ``slop`` other words, exact ones included.
    """
    found = find_phrases(build_index(docs), segments(items), slop=slop)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("key").cast("long").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


def _sql_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


CONTAMINATED_SQL = f"""
WITH d AS (
  SELECT doc_id, {_sql_words("text")} AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words("text")} AS w FROM benchmark
), phrases AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS phrase,
    w[i] AS a, w[least(len(w), i + {WINDOW - 1})] AS z, array_to_string(w[i : i + {WINDOW - 1}], '( [^ ]+)*? ') AS pattern
  FROM b, unnest(generate_series(1, greatest(len(w) - {WINDOW - 1}, 1))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM phrases
), windows AS (
  SELECT doc_id, n, CAST(i AS BIGINT) AS i, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(i) WHERE len(w) >= n
), found AS (
  SELECT doc_id, n, i, item FROM windows JOIN phrases USING (n, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM found), unnest(generate_series(0, n - 1)) AS t(k) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
), stretches AS (
  SELECT doc_id, n, w[i] AS a, w[i + n - 1 + s] AS z, array_to_string(w[i : i + n - 1 + s], ' ') AS stretch
  FROM d, sizes, unnest(generate_series(0, {SLOP})) AS u(s), unnest(generate_series(1, len(w) - n + 1 - s)) AS t(i) WHERE len(w) >= n + s
), near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near FROM stretches JOIN phrases USING (n, a, z) WHERE regexp_full_match(stretch, pattern) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""
