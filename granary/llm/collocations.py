"""Phrase collocations from mergeable Misra-Gries summaries and an exact second pass.

Every phrase of 1 to 5 words is counted within its language. Documents are written once as
blocks of a few megabytes, and then:

1. A block counts the hashes of its phrases and deals them to hash partitions. A partition merges
   the blocks' counts in a Misra-Gries summary whose capacity exceeds the partition's
   mass (phrases counted there) divided by the threshold: what is subtracted from a counter in all merges together stays
   below the threshold, so every phrase that is frequent enough is still there at the end.
   Equal hashes of different phrases only add up; they can let a rare phrase through, never lose a frequent one.
2. Each block learns which of its own hashes survived, and counts those phrases exactly, by their
   words. The counts go packed to the phrase's hash partition, where the blocks' counts add up to f, and phrases below the
   threshold go.

Then phrases are cut, scored, and folded into longer ones by joins on (lang, phrase). No count of
survivors is broadcast or held whole: a summary holds ``COUNTERS`` entries, a block what is found in it, and the
number of partitions and the bits of a hash follow the bytes of the table. A frequent phrase sends one count for each block; a
frequent language is many blocks and many partitions.

Nulls: a null text is empty and has no words; a null language is ``und``, and counts together with a language so named. Ids are not read;
repeated rows count as often as they occur. An empty table, or one without a frequent phrase, gives an empty result.
Only the two columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.text import slices
from granary.llm.tokens import Tokens, kinds, tokens_of
from granary.sources.workspace import settle

LONGEST = 5
THRESHOLD = 100
TOP = 2000
PARTS = 64  # of a language, ranked apart
BLOCK_BYTES = 4 << 20
COUNTERS = 1 << 18  # capacity of a partition's summary, about
HELD = 1 << 21  # entries merged into a summary at a time
SPARE_BITS = 12  # of a hash, beyond those that number every phrase of the table
PARTED = kinds(blank=b" \t", breaks=b".,;:!?\n\x0b\x0c\r")

BLOCKS = "block long, packed binary"
COUNTS = "part int, block long, mass long, entries binary"


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> tuple[Tokens, np.ndarray, list[str]]:
    """Words of a block, the number of each word's language, and the languages."""
    table = pa.ipc.open_stream(packed).read_all().combine_chunks()
    found = tokens_of(table.column("text").combine_chunks(), PARTED)
    langs = table.column("lang").combine_chunks().dictionary_encode()
    return found, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[found.text], langs.dictionary.to_pylist()


def write_blocks(docs: DataFrame, text: str, lang: str, block_bytes: int) -> DataFrame:
    """The written table of blocks (block, packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, limit=block_bytes):
            yield pa.record_batch([pa.array([number]), pa.array([_pack(part)], pa.binary())], names=["block", "packed"])
            number += 1

    named = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    return settle(docs.select(named, F.col(text).cast("string").alias("text")).where("text <> ''").mapInArrow(run, BLOCKS), "blocks")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def phrase_hashes(found: Tokens, lang: np.ndarray, langs: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``LONGEST`` words: (places, hashes of ``bits`` bits) of the phrases that start there and stay in their piece."""
    of = xxhash.xxh64_intdigest
    words = np.fromiter((of(w) for w in found.names.to_pylist()), np.uint64, len(found.names))[found.codes]
    seeds = np.fromiter((of(name, 1) for name in langs), np.uint64, len(langs))
    whole = _mixed(words ^ seeds[lang])
    at = np.arange(len(words))
    yield at, whole >> np.uint64(64 - bits)
    for n in range(2, LONGEST + 1):
        inside = at + n - 1 < len(words)
        at, whole = at[inside], whole[inside]
        inside = found.piece[at] == found.piece[at + n - 1]
        at, whole = at[inside], whole[inside]
        whole = _mixed(whole + words[at + n - 1] * np.uint64(0xC2B2AE3D27D4EB4F))
        yield at, whole >> np.uint64(64 - bits)


def _squeezed(values: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending hashes and their counts: gaps and counts by planes of bytes, compressed."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    counts = n.astype("<u4").view(np.uint8).reshape(-1, 4).T
    planes = np.concatenate([gaps, counts]) if len(values) else np.empty((12, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _spread(entries: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(entries), np.uint8).reshape(12, -1)
    gaps = np.ascontiguousarray(planes[:8].T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(planes[8:].T).view("<u4").ravel().astype(np.int64)


def _block_counts(blocks: DataFrame, bits: int, parts: int) -> DataFrame:
    """(part, block, mass, entries): the phrases of every block, dealt to partitions by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("packed")):
                found, lang, langs = _unpack(packed.as_py())
                hashes = np.sort(np.concatenate([h for _, h in phrase_hashes(found, lang, langs, bits)]))
                new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, np.int64)
                n = np.diff(np.append(new, len(hashes)))
                values = hashes[new]
                cuts = np.searchsorted(values, edges(bits, parts))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    here = slice(cuts[p], cuts[p + 1])
                    row = [[p], [block], [int(n[here].sum())], [_squeezed(values[here], n[here])]]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "block", "mass", "entries"])

    return blocks.mapInArrow(run, COUNTS)


def edges(bits: int, parts: int) -> np.ndarray:
    """Where each hash partition begins; the last one ends after all hashes."""
    return np.array([min((1 << 64) - 1, -(-(i << bits) // parts)) for i in range(parts + 1)], dtype=np.uint64)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by ``taken`` at most.

    Counts given to ``add`` may themselves come from a summary of the same capacity; what was taken there is added with ``lose``.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)
        self.taken = 0

    def lose(self, taken: int) -> None:
        self.taken += taken

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        keys, counts = keys[new], np.add.reduceat(counts, new) if len(new) else counts
        if len(keys) > self.capacity:
            rank = len(keys) - self.capacity - 1
            least = int(np.partition(counts, rank)[rank])  # the largest count that does not fit is taken from all
            self.taken += least
            kept = counts > least
            keys, counts = keys[kept], counts[kept] - least
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """All keys whose count may be ``threshold`` or more, among them every one that has it."""
        return self.keys[self.counts + self.taken >= threshold]


def _survivors(counts: DataFrame, threshold: int) -> DataFrame:
    """(block, hashes): for every block, those of its hashes that may be frequent enough."""

    def run(group: pa.Table) -> pa.Table:
        mass = sum(group.column("mass").to_pylist())
        summary = Summary(mass // threshold + 1)
        rows = group.column("entries")
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(len(rows)):
            held.append(_spread(rows[i].as_py()))
            if i == len(rows) - 1 or sum(len(k) for k, _ in held) > HELD:
                summary.add(*(np.concatenate(c) for c in zip(*held)))
                held = []
        kept = summary.at_least(threshold)
        found = []
        for i in range(len(rows)):
            keys = _spread(rows[i].as_py())[0]
            at = np.minimum(np.searchsorted(kept, keys), max(0, len(kept) - 1))
            found.append(keys[kept[at] == keys].astype("<u8").tobytes() if len(kept) else b"")
        return pa.table([group.column("block"), pa.array(found, pa.binary())], names=["block", "hashes"])

    return counts.groupBy("part").applyInArrow(run, "block long, hashes binary")


def _known(values: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ``kept``: most of those that are not fall to a table of bits."""
    slots = np.zeros(1 << 24, dtype=bool)
    spot = lambda v: (v & np.uint64((1 << 24) - 1)).astype(np.int64)
    slots[spot(kept)] = True
    hit = np.flatnonzero(slots[spot(values)])
    at = np.minimum(np.searchsorted(kept, values[hit]), max(0, len(kept) - 1))
    return hit[kept[at] == values[hit]] if len(kept) else hit[:0]


EXACT = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _exact(packed: bytes, kept: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Hashes and (lang, words, phrase, f) of the block's surviving phrases, told apart by their words; 0 words: all words of the language."""
    found, lang, langs = _unpack(packed)
    total = np.bincount(lang, minlength=len(langs))
    whole = [pa.array(langs, pa.string()), pa.array([0] * len(langs), pa.int32()), pa.array([""] * len(langs)), pa.array(total)]
    yield np.zeros(len(langs), np.uint64), pa.Table.from_arrays(whole, schema=EXACT)
    known = np.full(len(found.codes) + 1, -1, dtype=np.int64)  # the number of the shorter phrase that starts at a place
    for n, (at, hashes) in enumerate(phrase_hashes(found, lang, langs, bits), 1):
        hit = _known(hashes, kept)
        at, hashes = at[hit], hashes[hit]
        if n == 1:
            pair = lang[at] * len(found.names) + found.codes[at]
        else:  # both shorter phrases inside a frequent one are frequent, so they have survived
            whole = (known[at] >= 0) & (known[at + 1] >= 0)
            at, hashes = at[whole], hashes[whole]
            pair = known[at] * len(found.names) + found.codes[at + n - 1]
        _, first, number, f = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        known = np.full(len(known), -1, dtype=np.int64)
        known[at] = number.ravel()
        if not len(at):
            return
        codes = found.codes[at[first][:, None] + np.arange(n)].ravel()
        lists = pa.ListArray.from_arrays(np.arange(0, len(codes) + 1, n, dtype=np.int32), found.names.take(pa.array(codes)))
        names = pa.array(langs, pa.string()).take(pa.array(lang[at[first]]))
        columns = [names, pa.array(np.full(len(first), n, np.int32)), pc.binary_join(lists, " "), pa.array(f.astype(np.int64))]
        yield hashes[first], pa.Table.from_arrays(columns, schema=EXACT)


def _block_phrases(blocks: DataFrame, survivors: DataFrame, bits: int, parts: int) -> DataFrame:
    """(part, packed): the phrase counts of every block, dealt to partitions by hash."""

    def run(key, held: pa.Table, lists: pa.Table) -> pa.Table:
        kept = np.sort(np.frombuffer(b"".join(lists.column("hashes").to_pylist()), dtype="<u8"))
        to, sent = [], []
        for packed in held.column("packed"):
            found = list(_exact(packed.as_py(), kept, bits))
            part = np.searchsorted(edges(bits, parts), np.concatenate([h for h, _ in found]), side="right") - 1
            order = np.argsort(part, kind="stable")
            table = pa.concat_tables([t for _, t in found]).take(pa.array(order)).combine_chunks()
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                to.append(p)
                sent.append(_pack(table.slice(cuts[p], cuts[p + 1] - cuts[p]).combine_chunks().to_batches()[0]))
        return pa.table([pa.array(to, pa.int32()), pa.array(sent, pa.binary())], names=["part", "packed"])

    return blocks.groupBy("block").cogroup(survivors.groupBy("block")).applyInArrow(run, "part int, packed binary")


def _added(counts: DataFrame, threshold: int) -> DataFrame:
    """(lang, words, phrase, f) of the frequent phrases, and the words of each language."""

    def run(group: pa.Table) -> pa.Table:
        held: list[pa.Table] = []
        rows = group.column("packed")
        for i in range(len(rows)):
            held.append(pa.ipc.open_stream(rows[i].as_py()).read_all())
            if i == len(rows) - 1 or sum(t.num_rows for t in held) > HELD:
                whole = pa.concat_tables(held).group_by(["lang", "words", "phrase"]).aggregate([("f", "sum")])
                held = [whole.rename_columns({"f_sum": "f"}).select(EXACT.names)]
        f, words = held[0].column("f"), held[0].column("words")
        return held[0].filter(pc.or_(pc.greater_equal(f, threshold), pc.equal(words, 0)))

    return counts.groupBy("part").applyInArrow(run, "lang string, words int, phrase string, f long")


def frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES, counters: int = COUNTERS
) -> DataFrame:
    """The written table (lang, words, phrase, f) of all phrases found ``threshold`` times or more.

    Rows with 0 words and an empty phrase have the number of all words of a language.
    """
    blocks = write_blocks(docs, text, lang, block_bytes)
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    most = LONGEST * (size // 2 + 1)  # every word takes two bytes, with what follows it
    parts = 1 + most // (threshold * counters)
    bits = min(64, most.bit_length() + SPARE_BITS)
    survivors = settle(_survivors(_block_counts(blocks, bits, parts), threshold), "survivors")
    return settle(_added(_block_phrases(blocks, survivors, bits, parts), threshold), "phrases")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (l * r)) in whole numbers of 38 digits."""
    wide = lambda c, digits: c.cast(f"decimal({digits}, 0)")
    over = wide(F.lit(1000), 4) * (wide(a, 16) * wide(n, 16))
    under = wide(left, 16) * wide(right, 16)
    return F.call_function("div", over, under)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` phrases of every language."""
    phrases = frequent_phrases(docs, threshold, **how)
    counts = phrases.where("words > 0").select("lang", "phrase", "f")
    whole = phrases.where("words = 0").select("lang", F.col("f").alias("n"))
    long = phrases.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    # A phrase goes if a longer one that holds it is as frequent. The phrases between the two are as frequent then, so one more word will do.
    shorter = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    inside = long.where("words > 2").select("lang", F.explode(shorter).alias("phrase"), "a")
    covered = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    open_ones = long.join(covered, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a").drop("longer")
    cuts = open_ones.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(whole, "lang").withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), least)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    flat = scored.select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")
    # first within parts of a language, so that the last ranking has at most PARTS * top rows for each
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    first = flat.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_GRAMS = " UNION ALL ".join(f"SELECT lang, {n} AS words, array_to_string(w[i : i + {n - 1}], ' ') AS phrase FROM s WHERE i + {n - 1} <= len(w)" for n in range(1, LONGEST + 1))

COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), s AS (
  SELECT lang, w, CAST(i AS BIGINT) AS i FROM p, unnest(generate_series(1, len(w))) AS t(i)
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1
), g AS (
  SELECT lang, words, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM ({_GRAMS}) GROUP BY 1, 2, 3 HAVING count(*) >= {THRESHOLD}
), inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM g, unnest(generate_series(2, {LONGEST - 1})) AS u(m), unnest(generate_series(1, words - m + 1)) AS t(i) WHERE m < words GROUP BY 1, 2
), cuts AS (
  SELECT g.lang, g.phrase, g.f AS a, x.f AS l, y.f AS r, n, k, 1000::HUGEINT * g.f * n // (x.f::HUGEINT * y.f) AS score
  FROM g JOIN total ON total.lang = g.lang, unnest(generate_series(1, g.words - 1)) AS t(k)
  JOIN g x ON x.lang = g.lang AND x.phrase = array_to_string(g.w[1 : k], ' ')
  JOIN g y ON y.lang = g.lang AND y.phrase = array_to_string(g.w[k + 1 : g.words], ' ') WHERE g.words > 1
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank, best.phrase, a, l, r, n, score
  FROM best LEFT JOIN inner_phrases q ON q.lang = best.lang AND q.phrase = best.phrase WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}
"""
