"""Brown class-based bigrams: words in classes by exchange clustering, and texts scored by class transitions and word emissions.

Training documents are those whose crc32(doc_id as text) mod 5 is not 1.

* The ``HEAD`` most frequent words are clustered into ``CLASSES`` by exchange: each sweep
  takes, for one word in ``PARTS``, its counts of neighbouring classes (counted by Spark over
  all bigrams), and moves it to the class that raises the likelihood of the
  class bigrams most. Sweeps go on until none of the last ``PARTS`` has raised it by more than ``SETTLED`` of itself; the
  best state stays. What reaches the driver is bounded by HEAD x CLASSES, whatever the corpus.
* Every other word seen twice or more begins in the class of words found mostly beside the same head class (ties go to
  the lower class) and is then exchanged by Spark among all classes, over its bigrams with head words, ends and each other: a sweep
  moves each word, against the table of class bigrams as it was before the sweep, to the class that raises the likelihood most; a class takes in no more than about what it holds. A sweep that lowers it
  is undone and from then on half as many words move at once (one in ``MOST_PARTS`` at least); sweeps go on until every word has had its turn without
  raising it by more than ``SETTLED`` of itself. Classes of these words are a table; the driver sees class bigrams only.
* With ``CORE`` set to a number only that many words are exchanged, the others stay where they begin.
* Words seen once and unseen words share a class; its mass is split by Good and Turing's estimate.

P(word | previous) = P(class | previous class) * P(word | class), transitions drawn
towards the classes' own frequencies; it sums to one over the training words and one unseen word.

The vocabulary grows with the corpus and is never broadcast. Texts are split once, in blocks of
about ``BLOCK_BYTES``; a block asks for the words it holds (one row for each block and word),
a join by word answers with counts and numbers, and from then on a block is a row of word numbers. No score depends on how texts are dealt.
Words outside the core are dealt into parts of about ``PART_WORDS`` by a hash and numbered there. A part is a row with its words' neighbours;
in a sweep each part sends others the classes of the words they need, one row for every two parts. Classes come back to the blocks likewise.

Nulls: a null text is empty (its end alone is scored); a null doc_id is a training document.
Repeated rows count and are scored each. Without training documents every token is unseen. An empty table gives an
empty one. Words of equal count are taken in order of their bytes. Only doc_id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.text import Words, slices, words_of
from granary.sources.workspace import discard, drop_shuffles, settle

CORE: int | None = None  # how many words are exchanged; None: every word seen twice or more
HEAD = 4096  # the words exchanged one after another
CLASSES = 32
SETTLED = 1e-4
PARTS = 3  # words that are each other's neighbours are mostly not moved in one sweep
MOST_PARTS = 16
PULL = 20.0  # how strongly transitions are drawn towards class frequencies
CHUNK_WORDS = 1024
PART_WORDS = 16384
BLOCK_BYTES = 8 << 20
SLICE = 8 << 20

END = CLASSES  # the class of the end of a document
ALONE = CLASSES + 1  # context of a word without a core neighbour
RARE = CLASSES + 1  # class RARE + context: words outside the core seen twice or more
ONCE = RARE + ALONE + 1  # words seen once, and unseen words
ALL = ONCE + 1


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest needs, compressed."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return kind.char.encode() + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _spread(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=data[:1].decode()).astype(np.int64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _one(values: pa.Array) -> pa.Array:
    """A list of all the values, as a column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def split_texts(texts: DataFrame) -> DataFrame:
    """A row for each block: its distinct words with their counts in training documents, and its documents as numbers of those words."""
    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, part in enumerate(slices(batches, limit=limit)):
            words = words_of(part.column("text"), lower=True)
            sizes, held = np.diff(words.starts), part.column("held_out").to_numpy(zero_copy_only=False)
            n = np.bincount(words.codes[np.repeat(~held, sizes)], minlength=len(words.names))
            spelt = zstandard.ZstdCompressor(level=1).compress("".join(words.names.to_pylist()).encode())
            lengths = pc.binary_length(words.names).to_numpy(zero_copy_only=False)
            block = pa.array([(TaskContext.get().partitionId() << 32) + k])
            packed = [pa.array([x], pa.binary()) for x in (spelt, _pack(lengths), _pack(n), _pack(words.codes), _pack(sizes))]
            yield pa.record_batch([block, *packed, _one(part.column("doc_id")), _one(part.column("held_out"))], names=["block", "spelt", "lengths", "ns", "codes", "sizes", "doc_id", "held_out"])

    return texts.mapInArrow(run, "block long, spelt binary, lengths binary, ns binary, codes binary, sizes binary, doc_id array<long>, held_out array<boolean>")


def _names(spelt: bytes, lengths: bytes) -> pa.Array:
    starts = _starts(_spread(lengths)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(zstandard.ZstdDecompressor().decompress(spelt)))


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, c) over training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = _spread(row["ns"])
                full = np.flatnonzero(n)
                yield pa.record_batch([_names(row["spelt"], row["lengths"]).take(pa.array(full)), pa.array(n[full])], names=["word", "n"])

    counted = blocks.select("spelt", "lengths", "ns").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` words with the highest counts, ties by word.

    Words are first counted by an eighth of an octave of their count, at most some 500 rows; only those in the classes that can hold
    one of the ``n`` are sorted, so the last task does not get ``n`` rows from each task before it.
    """
    level = F.floor(F.log2("c") * 8)
    least, seen = 0, 0
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        least, seen = r["level"], seen + r["n"]
        if seen >= n:
            break
    return counts.filter(level >= least).orderBy(F.desc("c"), "word").limit(n)


def _core_places(names: pa.Array, core: pa.Array) -> np.ndarray:
    """The place of each name in the core; -1 outside it."""
    return pc.fill_null(pc.index_in(names, value_set=core), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _neighbours(values: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word the value before and after it; ``end`` beyond a text's first and last word."""
    before = np.concatenate([[end], values[:-1]]) if len(values) else values
    after = np.concatenate([values[1:], [end]]) if len(values) else values
    full = starts[:-1] < starts[1:]
    before[starts[:-1][full]] = end
    after[starts[1:][full] - 1] = end
    return before, after


def _learnt(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a block's training documents, and where each document starts."""
    sizes, held = _spread(row["sizes"]), np.array(row["held_out"], dtype=bool)
    return _spread(row["ids"])[np.repeat(~held, sizes)], _starts(sizes[~held])


def core_bigrams(encoded: DataFrame, core: int) -> DataFrame:
    """(a, b, n): neighbours that are both core words or ends, over training documents; an end is number ``core``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = core + 1
        for batch in batches:
            for row in batch.to_pylist():
                ids, starts = _learnt(row)
                at = np.where(ids < size, ids - 1, -1)
                before, after = _neighbours(at, starts, core)
                last = after == core
                a = np.concatenate([before, at[last]])
                b = np.concatenate([at, np.full(int(last.sum()), core)])
                both = (a >= 0) & (b >= 0)
                pairs, n = np.unique(a[both] * size + b[both], return_counts=True)
                yield pa.record_batch([pa.array(pairs // size), pa.array(pairs % size), pa.array(n)], names=["a", "b", "n"])

    found = encoded.select("ids", "sizes", "held_out").mapInArrow(run, "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of class bigrams, up to a constant of the words."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def sweep(classes: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, table: np.ndarray, turn: int = 0) -> np.ndarray:
    """One exchange of the core words whose turn it is, most frequent first.

    ``left[w, c]`` counts class c before word w, ``right[w, c]`` after it, ``own[w]``
    the word after itself; ``table[c, d]`` counts class d after class c.
    """
    classes, n = classes.copy(), table.astype(float).copy()
    k = CLASSES
    diagonal = np.arange(k)
    for w in range(turn % PARTS, len(classes), PARTS):
        a, s = classes[w], float(own[w])
        before, after = left[w].astype(float), right[w].astype(float)
        before[a] -= s
        after[a] -= s
        n[:, a] -= before
        n[a, :] -= after
        n[a, a] -= s
        np.maximum(n, 0, out=n)  # neighbours that have moved in this sweep are counted anew in the next
        come, go = n[:, :k], n[:k, :].T
        gain = _xlogx(come + before[:, None]) - _xlogx(come) + _xlogx(go + after[:, None]) - _xlogx(go)
        total = gain.sum(axis=0) - gain[diagonal, diagonal]
        inner = n[diagonal, diagonal]
        total += _xlogx(inner + before[:k] + after[:k] + s) - _xlogx(inner)
        # The word's neighbours end and begin bigrams wherever the word itself goes.
        ends, begins = n.sum(axis=0)[:k] + after[:k], n.sum(axis=1)[:k] + before[:k]
        total -= _xlogx(ends + before.sum() + s) - _xlogx(ends) + _xlogx(begins + after.sum() + s) - _xlogx(begins)
        b = int(np.argmax(total))
        classes[w] = b
        n[:, b] += before
        n[b, :] += after
        n[b, b] += s
    return classes


def beside_core(bigrams: DataFrame, classes: np.ndarray) -> np.ndarray:
    """[0, w, c] counts class c before core word w, [1, w, c] after it."""
    size, every = len(classes), np.concatenate([classes, [END]])
    shape = 2, size + 1, CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            one, two, n = (batch.column(c).to_numpy() for c in ("a", "b", "n"))
            np.add.at(counts, (0, two, every[one]), n)
            np.add.at(counts, (1, one, every[two]), n)
        full = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(full), pa.array(counts.ravel()[full])], names=["cell", "n"])

    rows = bigrams.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most 2 x CORE x CLASSES rows
    counts = np.zeros(shape, dtype=np.int64)
    counts.ravel()[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return counts


def exchange(bigrams: DataFrame, size: int, settled: float = SETTLED) -> np.ndarray:
    """The class of every core word."""
    classes = np.arange(size) % CLASSES
    own = np.zeros(size, dtype=np.int64)
    for r in bigrams.filter((F.col("a") == F.col("b")) & (F.col("a") < size)).collect():  # at most CORE rows
        own[r["a"]] = r["n"]
    best, best_value, base, turn, last = classes, -np.inf, -np.inf, 0, 0
    while turn - last <= PARTS:
        left, right = beside_core(bigrams, classes)
        every = np.concatenate([classes, [END]])
        table = np.zeros((CLASSES + 1, CLASSES + 1))
        np.add.at(table, every, right)  # row: class of the word, column: class after it
        value = likelihood(table)
        if value > best_value:
            best, best_value = classes, value
        if value > base + settled * abs(value):
            base, last = value, turn
        classes = sweep(classes, left[:size], right[:size], own, table, turn)
        turn += 1
    return best


def _context_classes(of: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The core class before each word, else the one after it, else ``ALONE``."""
    before, after = _neighbours(of, starts, END)
    return np.where(before >= 0, before, np.where(after >= 0, after, ALONE))


def other_words(texts: DataFrame, core: list[str], classes: np.ndarray) -> DataFrame:
    """(word, c, class) of the words of training documents outside the core, by their contexts in the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = pa.array(core, pa.string()), ALONE + 1
        for part in slices(batches, limit=SLICE):
            words = words_of(part.column("text"), lower=True)
            of = np.append(classes, -1)[_core_places(words.names, known)][words.codes]
            context = _context_classes(of, words.starts)
            outside = of < 0
            cells, n = np.unique(words.codes[outside].astype(np.int64) * size + context[outside], return_counts=True)
            yield pa.record_batch([words.names.take(pa.array(cells // size)), pa.array((cells % size).astype(np.int32)), pa.array(n)], names=["word", "context", "n"])

    found = texts.filter(~F.col("held_out")).select("text").mapInArrow(run, "word string, context int, n long")
    cells = found.groupBy("word", "context").agg(F.sum("n").alias("n"))
    words = cells.groupBy("word").agg(F.sum("n").alias("c"), F.max(F.struct("n", (-F.col("context")).alias("context"))).alias("most"))
    rare = F.when(F.col("c") > 1, F.lit(RARE) - F.col("most.context")).otherwise(ONCE)
    return words.select("word", "c", rare.cast("int").alias("class"))


def numbered(rest: DataFrame) -> DataFrame:
    """(word, c, drawn, part, place): the words dealt into parts by a hash, numbered in each by their order."""
    parts = 1 + rest.count() // PART_WORDS

    def run(words: pa.Table) -> pa.Table:
        words = words.sort_by("word")
        return words.append_column("place", pa.array(np.arange(words.num_rows)))

    drawn = F.xxhash64("word")
    dealt = rest.select("word", "c", drawn.alias("drawn"), F.pmod(drawn, F.lit(parts)).cast("int").alias("part"))
    return dealt.groupBy("part").applyInArrow(run, "word string, c long, drawn long, part int, place long")


def contexts(encoded: DataFrame, core: int, classes: np.ndarray, parts: int, room: int) -> DataFrame:
    """(part, place, near, n), packed: what stands beside the words outside the core in training documents, a row for each block and part.

    ``near`` is the class of a core word or end before the word, or ``ONCE`` + the class after it; from 2 * ``ONCE`` on it is twice the number
    of a word outside the core, part * ``room`` + place, and one more if that word comes after.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, most = np.concatenate([[-1], classes]), 2 * (ONCE + parts * room)
        for batch in batches:
            for row in batch.to_pylist():
                ids, starts = _learnt(row)
                values = np.where(ids <= core, of[np.minimum(ids, core)], ids + (END - core))
                before, after = _neighbours(values, starts, END)
                cells = []
                for side, beside in enumerate((before, after)):
                    at = (values > END) & (beside >= 0)
                    beside = beside[at]
                    near = np.where(beside <= END, side * ONCE + beside, 2 * (ONCE + beside - END - 1) + side)
                    cells.append((values[at] - END - 1) * most + near)
                cells, n = np.unique(np.concatenate(cells), return_counts=True)
                word, near = np.divmod(cells, most)
                part, place = np.divmod(word, room)
                firsts = np.flatnonzero(np.diff(part, prepend=-1))
                made = [[_pack(x[a:b]) for a, b in zip(firsts, [*firsts[1:], len(part)])] for x in (place, near, n)]
                yield pa.record_batch([pa.array(part[firsts].astype(np.int32)), *(pa.array(x, pa.binary()) for x in made)], names=["part", "place", "near", "n"])

    return encoded.select("ids", "sizes", "held_out").mapInArrow(run, "part int, place binary, near binary, n binary")


def neighbourhoods(words: DataFrame, found: DataFrame, room: int) -> DataFrame:
    """A row for each part: its words' counts, first classes and neighbours, and the places that it asks of each part (``need``)."""

    def run(key, words: pa.Table, found: pa.Table) -> pa.Table:
        words = words.sort_by("place")
        size, part = words.num_rows, key[0].as_py()
        place, near, n = (np.concatenate([_spread(x) for x in found.column(c).to_pylist()] or [np.zeros(0, np.int64)]) for c in ("place", "near", "n"))
        order = np.lexsort((near, place))
        place, near, n = place[order], near[order], n[order]
        firsts = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(near, prepend=-1) != 0))
        place, near, n = place[firsts], near[firsts], np.add.reduceat(n, firsts) if len(firsts) else n
        fixed = near < 2 * ONCE
        # A word begins in the class mostly found before it, else after it; ties go to the lower class.
        at, cell, times = place[fixed], near[fixed], n[fixed]
        order = np.lexsort((-cell, times, cell < ONCE, at))
        begun = np.full(size, RARE + ALONE, dtype=np.uint8)
        begun[at[order]] = RARE + cell[order] % ONCE  # the last of a word stays
        side, other = near[~fixed] & 1, (near[~fixed] >> 1) - ONCE
        self = (side == 1) & (other == part * room + place[~fixed])
        own = np.zeros(size, dtype=np.int64)
        own[place[~fixed][self]] = n[~fixed][self]
        need, source = np.unique(other, return_inverse=True)
        asked = need // room
        bounds = np.flatnonzero(np.diff(asked, prepend=-1))
        needs = [{"of": int(asked[a]), "places": _pack(need[a:b] % room)} for a, b in zip(bounds, [*bounds[1:], len(need)])]
        packed = [_pack(x) for x in (own, words.column("c").to_numpy(), at * (2 * ONCE) + cell, times, place[~fixed] * 2 + side, source, n[~fixed])]
        made = {c: pa.array([x], pa.binary()) for c, x in zip(("own", "c", "cells", "ns", "links", "sources", "times"), packed)}
        made |= {"classes": pa.array([begun.tobytes()], pa.binary()), "drawn": pa.array([words.column("drawn").to_numpy().tobytes()], pa.binary())}
        return pa.table({"part": pa.array([part], pa.int32())} | made | {"need": pa.array([needs], pa.list_(pa.struct([("of", pa.int32()), ("places", pa.binary())])))})

    schema = "part int, own binary, c binary, cells binary, ns binary, links binary, sources binary, times binary, classes binary, drawn binary, need array<struct<of int, places binary>>"
    return words.select("part", "place", "c", "drawn").groupBy("part").cogroup(found.groupBy("part")).applyInArrow(run, schema)


def moved(table: np.ndarray, classes: np.ndarray, own: np.ndarray, word: np.ndarray, cell: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class in use that raises the likelihood of ``table`` most for every word, were it the only one to move.

    ``word``, ``cell`` and ``n`` count the classes before each word, and, from len(table) on, after it; ``own`` the word after itself.
    """
    k, size = len(table), len(classes)
    every = np.arange(size)
    sides = np.zeros((2, size, k))
    np.add.at(sides, (cell // k, word, cell % k), n)
    sides[:, every, classes] -= own
    total = np.zeros((size, k))
    for (these, those), t in zip((sides, sides[::-1]), (table, table.T)):
        i, c = np.nonzero(these)
        if not len(i):
            continue
        # Most gains depend on the neighbour's class and its count alone, and most counts are small.
        at, count, a, known = np.arange(len(i)), these[i, c], classes[i], _xlogx(t)
        pairs, pair = np.unique(count * k + c, return_inverse=True)
        counts, cs = np.divmod(pairs, k)
        cs = cs.astype(np.int64)
        gain = (_xlogx(t[cs] + counts[:, None]) - known[cs])[pair]
        # Counts without the word itself: those of its class with others change.
        rest = t[c, a] - count
        gain[at, a] = _xlogx(rest + count) - _xlogx(rest)
        same = np.flatnonzero(c == a)
        rest = t[c[same]]
        rest[np.arange(len(same)), a[same]] -= count[same]
        rest -= those[i[same]]
        rest[np.arange(len(same)), a[same]] -= own[i[same]]
        gain[same] = _xlogx(rest + count[same, None]) - _xlogx(rest)
        gain[at, c] = 0.0  # counted below, with both sides
        firsts = np.flatnonzero(np.diff(i, prepend=-1))
        total[i[firsts]] += np.add.reduceat(gain, firsts, axis=0)
    both = sides.sum(axis=0) + own[:, None]
    i, c = np.nonzero(both)
    inner = table.diagonal()[c] - np.where(c == classes[i], both[i, c], 0)
    total[i, c] += _xlogx(inner + both[i, c]) - _xlogx(inner)
    for side, margin in zip(sides, (table.sum(axis=0), table.sum(axis=1))):
        mass = side.sum(axis=1) + own
        masses, which = np.unique(mass, return_inverse=True)
        loss = (_xlogx(margin + masses[:, None]) - _xlogx(margin))[which]
        rest = margin[classes] - mass
        loss[every, classes] = _xlogx(rest + mass) - _xlogx(rest)
        total -= loss
    stay = total[every, classes]
    total[:, (table.sum(axis=0) + table.sum(axis=1) == 0) | (np.arange(k) == END)] = -np.inf  # each word alone would gain by an empty class, all at once would lose
    best = total.argmax(axis=1)
    return np.where(total[every, best] > stay + 1e-9 * np.abs(stay), best, classes)


def class_table(bigrams: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class after class among core words and ends."""
    of = bigrams.sparkSession.createDataFrame([(i, int(c)) for i, c in enumerate([*classes, END])], "word long, class int")
    one, two = (F.broadcast(of.select(F.col("word").alias(w), F.col("class").alias(c))) for w, c in (("a", "from"), ("b", "to")))
    table = np.zeros((ONCE, ONCE))
    for r in bigrams.join(one, "a").join(two, "b").groupBy("from", "to").agg(F.sum("n").alias("n")).collect():  # at most ONCE x ONCE rows
        table[r["from"], r["to"]] = r["n"]
    return table


def classes_seen(states: DataFrame, requests: DataFrame, of: DataFrame) -> DataFrame:
    """A row for each part: its words' classes, the classes beside them and their share in the table, when ``of`` are the classes of all parts."""

    def send(key, requests: pa.Table, of: pa.Table) -> pa.Table:
        classes = of.column("classes")[0].as_py()
        known = np.frombuffer(classes, np.uint8)
        sent = [known[_spread(p)].tobytes() for p in requests.column("places").to_pylist()]
        part = pa.array([key[0].as_py(), *requests.column("part").to_pylist()], pa.int32())
        source = pa.array([-1, *requests.column("of").to_pylist()], pa.int32())
        return pa.table([part, source, pa.array([classes, *sent], pa.binary())], names=["part", "source", "classes"])

    def take(key, state: pa.Table, sent: pa.Table) -> pa.Table:
        classes, *got = sent.sort_by("source").column("classes").to_pylist()
        own, near = np.frombuffer(classes, np.uint8).astype(np.int64), np.frombuffer(b"".join(got), np.uint8)
        cells, ns, links, sources, times = (_spread(state.column(c)[0].as_py()) for c in ("cells", "ns", "links", "sources", "times"))
        table = np.zeros(ONCE * ONCE)
        word, cell = np.divmod(cells, 2 * ONCE)
        a, b = np.where(cell < ONCE, cell, own[word]), np.where(cell < ONCE, own[word], cell - ONCE)
        table += np.bincount(a * ONCE + b, ns, minlength=ONCE * ONCE)
        (word, side), beside = np.divmod(links, 2), near[sources].astype(np.int64)
        second = side == 0  # two words outside the core are counted by the second of them
        table += np.bincount(beside[second] * ONCE + own[word[second]], times[second], minlength=ONCE * ONCE)
        found = np.concatenate([cells, word * (2 * ONCE) + side * ONCE + beside])
        seen = np.bincount(found, np.concatenate([ns, times]), minlength=len(own) * 2 * ONCE)
        full = np.flatnonzero(seen)
        made = [_pack(full), _pack(seen[full].astype(np.int64)), _pack(table.astype(np.int64)), classes]
        columns = [state.column("part"), *(state.column(c) for c in ("own", "c", "drawn")), *(pa.array([x], pa.binary()) for x in made)]
        return pa.table(columns, names=["part", "own", "c", "drawn", "cells", "ns", "table", "classes"])

    sent = requests.groupBy("of").cogroup(of.groupBy("part")).applyInArrow(send, "part int, source int, classes binary")
    known = states.select("part", "own", "c", "drawn", "cells", "ns", "links", "sources", "times")
    schema = "part int, own binary, c binary, drawn binary, cells binary, ns binary, table binary, classes binary"
    return known.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(take, schema)


def others_table(seen: DataFrame) -> np.ndarray:
    """Counts of class after class where a word outside the core takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(ONCE * ONCE, dtype=np.int64)
        for batch in batches:
            for data in batch.column("table").to_pylist():
                table += _spread(data)
        full = np.flatnonzero(table)
        yield pa.record_batch([pa.array(full), pa.array(table[full])], names=["cell", "n"])

    table = np.zeros(ONCE * ONCE)
    for r in seen.select("table").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most ONCE x ONCE rows
        table[r["cell"]] = r["n"]
    return table.reshape(ONCE, ONCE)


def hashed_again(hashes: np.ndarray, turn: int) -> np.ndarray:
    """xxhash64(word, turn) as Spark has it, from the words' own xxhash64."""
    x = hashes.astype(np.uint64) + np.uint64(0x27D4EB2F165667C5 + 4)
    x ^= np.uint64(turn * 0x9E3779B185EBCA87 % (1 << 64))
    x = (x << np.uint64(23) | x >> np.uint64(41)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return (x ^ x >> np.uint64(32)).astype(np.int64)


def _moves(seen: DataFrame, table: np.ndarray, parts: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """(part, classes) after a sweep of one word in ``parts``, and what was written for it; a class takes in no more than about what it holds, words drawn by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                before = np.frombuffer(row["classes"], np.uint8).astype(np.int64)
                after, own, ns = before.copy(), _spread(row["own"]), _spread(row["ns"])
                word, cell = np.divmod(_spread(row["cells"]), 2 * ONCE)
                chosen = np.flatnonzero(np.frombuffer(row["drawn"], np.int64) % parts == turn % parts)
                for at in range(0, len(chosen), CHUNK_WORDS):
                    some = chosen[at : at + CHUNK_WORDS]
                    a, b = np.searchsorted(word, [some[0], some[-1] + 1])
                    place = np.minimum(np.searchsorted(some, word[a:b]), len(some) - 1)
                    kept = some[place] == word[a:b]
                    after[some] = moved(table, before[some], own[some], place[kept], cell[a:b][kept], ns[a:b][kept])
                mass = np.bincount(after, _spread(row["c"]) * (after != before), minlength=ONCE).astype(np.int64)
                columns = [pa.array([row["part"]], pa.int32()), *(pa.array([x], pa.binary()) for x in (row["drawn"], row["classes"], after.astype(np.uint8).tobytes(), mass.tobytes()))]
                yield pa.record_batch(columns, names=["part", "drawn", "classes", "to", "mass"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(ONCE, dtype=np.int64)
        for batch in batches:
            for data in batch.column("mass").to_pylist():
                mass += np.frombuffer(data, np.int64)
        yield pa.record_batch([pa.array(np.arange(ONCE)), pa.array(mass)], names=["to", "n"])

    moves = settle(seen.select("part", "own", "c", "drawn", "cells", "ns", "classes").mapInArrow(run, "part int, drawn binary, classes binary, to binary, mass binary"), "moved")
    held, share = table.sum(axis=0), np.ones(ONCE)
    for r in moves.select("mass").mapInArrow(gather, "to long, n long").groupBy("to").agg(F.sum("n").alias("n")).filter("n > 0").collect():  # at most ONCE rows
        share[r["to"]] = min(1.0, held[r["to"]] / r["n"])
    limits = (1e6 * share).astype(np.int64)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                before, to = (np.frombuffer(row[c], np.uint8) for c in ("classes", "to"))
                drawn = hashed_again(np.frombuffer(row["drawn"], np.int64), turn) % 1_000_000 < limits[to]
                made.append(np.where(drawn, to, before).astype(np.uint8).tobytes())
            yield pa.record_batch([batch.column("part"), pa.array(made, pa.binary())], names=["part", "classes"])

    return moves.select("part", "drawn", "classes", "to").mapInArrow(draw, "part int, classes binary"), moves


def exchange_others(words: DataFrame, found: DataFrame, core_table: np.ndarray, room: int, settled: float = SETTLED) -> DataFrame:
    """(word, c, part, place, class) of the ``numbered`` words outside the core; ``found`` are their ``contexts``.

    Each sweep sends every word's class to the parts with its neighbours outside the core, where it meets the core neighbours.
    """
    states = settle(neighbourhoods(words, found, room), "others")
    requests = settle(states.select("part", F.inline("need")), "requests")
    drop_shuffles(words.sparkSession)
    of, written = states.select("part", "classes"), []
    best, best_table, best_value, base = None, None, -np.inf, -np.inf
    parts, turn, still = 1, 0, 0
    while True:
        seen = settle(classes_seen(states, requests, of), "seen")
        table = core_table + others_table(seen)
        value = likelihood(table)
        if turn:
            discard(*written, seen if value <= best_value else best)
        drop_shuffles(words.sparkSession)
        base, still = (value, 0) if value > base + settled * abs(value) else (base, still + 1)
        if value < best_value:
            parts, still = 2 * parts, 0
        elif value > best_value:
            best, best_table, best_value = seen, table, value
        if still >= parts or parts > MOST_PARTS:
            discard(states, requests)
            break
        of, moves = _moves(best, best_table, parts, turn)
        written = [moves]
        turn += 1

    def run(key, words: pa.Table, of: pa.Table) -> pa.Table:
        classes = np.frombuffer(of.column("classes")[0].as_py(), np.uint8).astype(np.int32)
        return words.append_column("class", pa.array(classes[words.column("place").to_numpy()]))

    named = words.select("word", "c", "part", "place").groupBy("part").cogroup(best.select("part", "classes").groupBy("part"))
    return named.applyInArrow(run, "word string, c long, part int, place long, class int")


def _asked(blocks: DataFrame) -> DataFrame:
    """(word, block, at): the words of each block, and their numbers there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = _names(row["spelt"], row["lengths"])
                yield pa.record_batch([names, pa.array(np.full(len(names), row["block"])), pa.array(np.arange(len(names), dtype=np.int32))], names=["word", "block", "at"])

    return blocks.select("block", "spelt", "lengths").mapInArrow(run, "word string, block long, at int")


def encode(blocks: DataFrame, answered: DataFrame, n: int, v: int, ends: int) -> DataFrame:
    """A row for each block: its documents as word numbers (0: a word seen once or never), and sums over each one's words' counts."""
    sums = ["n_known", "base_score", "log_counts", "n_once", "n_unseen"]

    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        codes, size = _spread(block.column("codes")[0].as_py()), _spread(block.column("sizes")[0].as_py())
        words = Words(codes, pa.nulls(0), _starts(size))
        at = answers.column("at").to_numpy()
        counts, ids = np.zeros((2, int(codes.max()) + 1 if len(codes) else 0), dtype=np.int64)
        counts[at], ids[at] = answers.column("c").to_numpy(), answers.column("id").to_numpy()
        scale = np.log10(n + 0.5 * (v + 1))
        c = counts[codes]
        known = words.per_text((c > 0).astype(np.int64)) + int(ends > 0)
        base = words.per_text(np.log10(counts + 0.5)[codes]) + np.log10(ends + 0.5) - (size + 1) * scale
        counted = words.per_text(np.log10(np.maximum(counts, 1))[codes])
        made = [known, base, counted, words.per_text((c == 1).astype(np.int64)), words.per_text((c == 0).astype(np.int64))]
        columns = [block.column("block"), pa.array([_pack(ids[codes])], pa.binary()), *(block.column(x) for x in ("sizes", "doc_id", "held_out")), *(_one(pa.array(x)) for x in made)]
        return pa.table(columns, names=["block", "ids", "sizes", "doc_id", "held_out", *sums])

    schema = "block long, ids binary, sizes binary, doc_id array<long>, held_out array<boolean>, n_known array<long>, base_score array<double>, log_counts array<double>, n_once array<long>, n_unseen array<long>"
    return blocks.select("block", "codes", "sizes", "doc_id", "held_out").groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, schema)


def _classes_told(encoded: DataFrame, others: DataFrame, core: int, room: int) -> DataFrame:
    """(block, part, classes): the classes of a block's words outside the core, in order of their places."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.unique(_spread(row["ids"]))
                part, place = np.divmod(ids[ids > core] - core - 1, room)
                firsts = np.flatnonzero(np.diff(part, prepend=-1))
                packed = pa.array([_pack(place[a:b]) for a, b in zip(firsts, [*firsts[1:], len(part)])], pa.binary())
                yield pa.record_batch([pa.array(part[firsts].astype(np.int32)), pa.array(np.full(len(firsts), row["block"])), packed], names=["part", "block", "places"])

    def tell(key, asked: pa.Table, others: pa.Table) -> pa.Table:
        classes = np.full(room, ONCE, dtype=np.uint8)
        classes[others.column("place").to_numpy()] = others.column("class").to_numpy()
        told = pa.array([classes[_spread(p)].tobytes() for p in asked.column("places").to_pylist()], pa.binary())
        return pa.table([asked.column("block"), asked.column("part"), told], names=["block", "part", "classes"])

    asked = encoded.select("block", "ids").mapInArrow(ask, "part int, block long, places binary")
    return asked.groupBy("part").cogroup(others.select("part", "place", "class").groupBy("part")).applyInArrow(tell, "block long, part int, classes binary")


def _sequences(encoded: DataFrame, told: DataFrame, classes: np.ndarray) -> DataFrame:
    """Per document its classes in order and sums over its words' counts."""
    sums = ["n_known", "base_score", "log_counts", "n_once", "n_unseen"]

    def run(key, block: pa.Table, told: pa.Table) -> pa.Table:
        core, size = len(classes), _spread(block.column("sizes")[0].as_py())
        names, codes = np.unique(_spread(block.column("ids")[0].as_py()), return_inverse=True)
        of = np.concatenate([[ONCE], classes])[np.minimum(names, core)].astype(np.uint8)
        of[names > core] = np.frombuffer(b"".join(told.sort_by("part").column("classes").to_pylist()), np.uint8)
        data, starts = of[codes].tobytes(), _starts(size).tolist()
        lists = {x: block.column(x).combine_chunks().flatten() for x in ("doc_id", "held_out", *sums)}
        made = {"doc_id": lists["doc_id"], "held_out": lists["held_out"], "n_tokens": pa.array(size + 1)} | {x: lists[x] for x in sums}
        return pa.table(made | {"classes": pa.array([data[a:b] for a, b in zip(starts[:-1], starts[1:])], pa.binary())})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, log_counts double, n_once long, n_unseen long, classes binary"
    return encoded.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def _transitions(data: bytes) -> np.ndarray:
    """Cells (previous class, class) of a document from its end before to its own end."""
    path = np.concatenate([[END], np.frombuffer(data, np.uint8), [END]]).astype(np.int64)
    return path[:-1] * ALL + path[1:]


def transition_table(sequences: DataFrame) -> np.ndarray:
    """Counts of class after class over training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(ALL * ALL, dtype=np.int64)
        for batch in batches:
            for data in batch.column("classes").to_pylist():
                seen += np.bincount(_transitions(data), minlength=ALL * ALL)
        full = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(full), pa.array(seen[full])], names=["cell", "n"])

    rows = sequences.filter(~F.col("held_out")).select("classes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(ALL * ALL, dtype=np.int64)
    for r in rows.collect():  # at most ALL x ALL rows
        table[r["cell"]] = r["n"]
    return table.reshape(ALL, ALL)


def log_transitions(table: np.ndarray, pull: float = PULL) -> np.ndarray:
    """log10 P(class | previous class); every row sums to one."""
    share = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * ALL)
    return np.log10((table + pull * share) / (table.sum(axis=1, keepdims=True) + pull))


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every whole text."""
    texts, spark = _texts(docs), docs.sparkSession
    blocks = settle(split_texts(texts), "blocks")
    counts = settle(word_counts(blocks), "words")
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))
    ).first()
    ends = texts.filter(~F.col("held_out")).count()
    n, v, once, twice = sums[0] + ends, sums[1] + int(ends > 0), sums[2] or 0, sums[3] or 0
    size = HEAD if CORE is None else CORE
    top = most_frequent(counts.filter("c > 1"), size).collect()
    core = [r["word"] for r in top]
    # Numbers: 0 for words seen once, from 1 on the core, then the other words by part and place.
    rest = counts.filter("c > 1")
    if core:
        rest = rest.filter((F.col("c") < top[-1]["c"]) | ((F.col("c") == top[-1]["c"]) & (F.col("word") > core[-1])))
    words = settle(numbered(rest), "numbered")
    parts, room = (x + 1 for x in words.agg(F.coalesce(F.max("part"), F.lit(0)), F.coalesce(F.max("place"), F.lit(0))).first())
    known = words.select("word", "c", (F.col("part").cast("long") * room + F.col("place") + (1 + len(core))).alias("id"))
    known = known.unionAll(counts.filter("c = 1").select("word", "c", F.lit(0).cast("long").alias("id")))
    known = known.unionAll(spark.createDataFrame([(r["word"], r["c"], k) for k, r in enumerate(top, 1)], "word string, c long, id long"))
    # A word without an answer is in no training document.
    answered = _asked(blocks).join(known.hint("shuffle_hash"), "word").select("block", "at", "c", "id")
    encoded = settle(encode(blocks, answered, n, v, ends), "encoded")
    discard(blocks)
    drop_shuffles(spark)
    bigrams = settle(core_bigrams(encoded, len(core)), "bigrams") if core else None
    classes = exchange(bigrams, len(core)) if core else np.empty(0, dtype=np.int64)
    if CORE is not None:
        others = words.drop("c").join(other_words(texts, core, classes), "word")
    elif words.isEmpty():
        others = words.withColumn("class", F.lit(ONCE))
    else:
        found = settle(contexts(encoded, len(core), classes, parts, room), "contexts")
        drop_shuffles(spark)
        others = exchange_others(words, found, class_table(bigrams, classes), room)
        discard(found, bigrams)
    sequences = settle(_sequences(encoded, _classes_told(encoded, others, len(core), room), classes), "classes")
    table = transition_table(sequences)
    steps = log_transitions(table).ravel()
    # A word's share of its class is its count over the class'; an end is alone in its class.
    emitted = -np.log10(np.maximum(table.sum(axis=0), 1))
    emitted[[END, ONCE]] = 0.0
    unseen = once / (once + 2 * twice) if once else 1.0
    unseen = min(unseen, 0.99) if once else 1.0
    once_share = np.log10((1 - unseen) / once) if once else 0.0
    per_step = steps + np.tile(emitted, ALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names) if c not in ("classes", "doc_id")}
            paths = np.array([per_step[_transitions(d)].sum() for d in batch.column("classes").to_pylist()], dtype=float)
            score = paths + col["log_counts"] + col["n_once"] * once_share + col["n_unseen"] * np.log10(unseen)
            made = [col[c] for c in ("held_out", "n_tokens", "n_known")] + [np.full(len(score), n, dtype=np.int64), col["base_score"], score, 10 ** (-score / col["n_tokens"])]
            yield pa.record_batch(
                [batch.column("doc_id"), *map(pa.array, made)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    return sequences.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    )
