"""Language model, Re-Pair shards, packing and sentence pieces against plain versions."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, empty, odd, prose  # noqa: F401

from granary.llm import brown, encoding, packing, repair
from granary.llm.encoding import Encoder
from granary.llm.pieces import PieceModel, encode_table

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("abZé. ,'\n\t19-") + ["  ", "'s", "\r\n", "İ", "ß", "🙂", "\x00", "\xa0", "<|endoftext|>", "▁"]
ALPHABET = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def base_scores(rows):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    counts = collections.Counter(t for d, x in rows if not held[d] for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    score = lambda x: sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))
    return sorted((held[d], len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n, round(score(x), 6)) for d, x in rows)


def test_base_scores_and_counts(odd):
    got = brown.score_documents(odd).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert sorted((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == base_scores(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    draw = random.Random(3)
    tongues = [["".join(draw.choice(letters) for _ in range(4)) for _ in range(60)] for letters in ("abcd", "wxyz")]
    rows = [(i, " ".join(draw.choice(tongues[i % 2]) for _ in range(60))) for i in range(300)]
    got = [r for r in brown.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.2 * sum(r["n_tokens"] for r in got)


def plain_scores(rows, size):
    """log10 probabilities by the same model, with counts in dicts; exchange by the tested sweep."""
    words = [(d, x, [t.decode() for t in tokens(x)[:-1]], d is not None and zlib.crc32(str(d).encode()) % 5 == 1) for d, x in rows]
    learnt = [w for *_, w, held in words if not held]
    counts = collections.Counter(t for w in learnt for t in w)
    core = [w for w, _ in sorted(((w, c) for w, c in counts.items() if c > 1), key=lambda p: (-p[1], p[0].encode()))[:size]]
    place = {w: i for i, w in enumerate(core)}
    n = len(core)
    pairs = np.zeros((n + 1, n + 1), dtype=np.int64)
    for w in learnt:
        at = [n, *(place.get(t, -1) for t in w), n]
        for a, b in zip(at, at[1:]):
            if a >= 0 and b >= 0:
                pairs[a, b] += 1
    classes, best, best_value, base, turn, last = np.arange(n) % brown.CLASSES, None, -math.inf, -math.inf, 0, 0
    while turn - last <= brown.PARTS:
        every = np.concatenate([classes, [brown.END]])
        left, right = np.zeros((n + 1, brown.CLASSES + 1)), np.zeros((n + 1, brown.CLASSES + 1))
        np.add.at(left.T, every, pairs)
        np.add.at(right.T, every, pairs.T)
        table = np.zeros((brown.CLASSES + 1, brown.CLASSES + 1))
        np.add.at(table, every, right)
        value = brown.likelihood(table)
        if value > best_value:
            best, best_value = classes, value
        if value > base + brown.SETTLED * abs(value):
            base, last = value, turn
        classes = brown.sweep(classes, left[:n], right[:n], np.diag(pairs)[:n], table, turn)
        turn += 1
    of = {w: int(best[i]) for w, i in place.items()}
    votes = collections.defaultdict(collections.Counter)
    for w in learnt:
        for i, t in enumerate(w):
            if t not in of:
                before = brown.END if i == 0 else of.get(w[i - 1])
                after = brown.END if i + 1 == len(w) else of.get(w[i + 1])
                votes[t][before if before is not None else after if after is not None else brown.ALONE] += 1
    for t, seen in votes.items():
        of[t] = brown.RARE + min(seen, key=lambda c: (-seen[c], c)) if counts[t] > 1 else brown.ONCE
    steps = collections.Counter()
    for w in learnt:
        path = [brown.END, *(of[t] for t in w), brown.END]
        steps.update(zip(path, path[1:]))
    into, out = collections.Counter(), collections.Counter()
    for (a, b), c in steps.items():
        out[a] += c
        into[b] += c
    once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
    unseen = min(once / (once + 2 * twice), 0.99) if once else 1.0
    total = sum(into.values())

    def score(w):
        path, value = [brown.END, *(of.get(t, brown.ONCE) for t in w), brown.END], 0.0
        for a, b in zip(path, path[1:]):
            share = (into[b] + 0.5) / (total + 0.5 * brown.ALL)
            value += math.log10((steps[a, b] + brown.PULL * share) / (out[a] + brown.PULL))
        for t in w:
            if of.get(t, brown.ONCE) == brown.ONCE:
                value += math.log10((1 - unseen) / once if t in counts else unseen)
            else:
                value += math.log10(counts[t] / into[of[t]])
        return round(value, 6)

    return sorted((str(d), len(w) + 1, score(w)) for d, _, w, _ in words)


@pytest.mark.parametrize("block", [1 << 10, 8 << 20])
def test_scores_are_those_of_a_plain_model_however_texts_are_dealt(spark, odd, monkeypatch, block):
    draw = random.Random(4)
    made = [(100 + i, " ".join(f"w{min(int(draw.paretovariate(0.7)), 400)}" for _ in range(draw.randint(1, 60)))) for i in range(150)]
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()] + made
    monkeypatch.setattr(brown, "BLOCK_BYTES", block)
    monkeypatch.setattr(brown, "CORE", 100)
    got = brown.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    for (d, n, value), (e, m, wanted) in zip(sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in got), plain_scores(rows, 100), strict=True):
        assert (d, n) == (e, m) and value == pytest.approx(wanted, abs=1e-5, rel=1e-9)


def test_most_frequent_words(spark):
    draw = random.Random(7)
    rows = [(f"w{i}", int(2 ** draw.uniform(1, 9))) for i in range(500)]
    counts = spark.createDataFrame(rows, "word string, c long")
    for n in (1, 37, 499, 600):
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:n]
        assert [tuple(r) for r in brown.most_frequent(counts, n).collect()] == want


def test_transitions_are_a_distribution():
    table = np.random.default_rng(0).integers(0, 50, (brown.ALL, brown.ALL))
    assert np.allclose((10 ** brown.log_transitions(table)).sum(axis=1), 1)


def test_exchange_raises_the_likelihood():
    draw = np.random.default_rng(1)
    size = 400
    kind = draw.integers(0, 4, size)  # a word is mostly followed by words of the next kind
    words = np.zeros((size + 1, size + 1), dtype=np.int64)
    for a in range(size):
        words[a, draw.choice(np.flatnonzero(kind == (kind[a] + 1) % 4), 60)] += draw.integers(1, 9, 60)
    own, before = np.diag(words)[:size], np.arange(size) % brown.CLASSES

    def tables(classes):
        every = np.concatenate([classes, [brown.END]])
        left, right = np.zeros((size + 1, brown.CLASSES + 1)), np.zeros((size + 1, brown.CLASSES + 1))
        for w in range(size + 1):
            np.add.at(left[w], every, words[:, w])
            np.add.at(right[w], every, words[w])
        table = np.zeros((brown.CLASSES + 1, brown.CLASSES + 1))
        np.add.at(table, every, right)
        return left, right, table

    classes, values = before, [brown.likelihood(tables(before)[2])]
    for turn in range(9):
        left, right, table = tables(classes)
        classes = brown.sweep(classes, left[:size], right[:size], own, table, turn)
        values.append(brown.likelihood(tables(classes)[2]))
    assert max(values[1:]) > values[0] + 0.02 * abs(values[0]) and max(values) > values[1]


def test_exchange_of_one_word_is_exact():
    draw = np.random.default_rng(2)
    size = 6
    words = draw.integers(0, 9, (size + 1, size + 1))

    def table_of(classes):
        every = np.concatenate([classes, [brown.END]])
        table = np.zeros((brown.CLASSES + 1, brown.CLASSES + 1))
        np.add.at(table, (every[:, None], every[None, :]), words)
        return table

    classes = np.array([0, 0, 1, 1, 2, 2])
    every = np.concatenate([classes, [brown.END]])
    left, right = np.zeros((size, brown.CLASSES + 1)), np.zeros((size, brown.CLASSES + 1))
    for w in range(size):
        np.add.at(left[w], every, words[:, w])
        np.add.at(right[w], every, words[w])
    moved = brown.sweep(classes[:1].copy(), left[:1], right[:1], np.diag(words)[:1], table_of(classes))
    options = [brown.likelihood(table_of(np.concatenate([[c], classes[1:]]))) for c in range(brown.CLASSES)]
    assert options[moved[0]] == max(options)


def test_a_word_moves_where_the_likelihood_is_highest():
    draw = np.random.default_rng(5)
    size = 40
    words = draw.poisson(0.6, (size, size))
    classes = draw.choice([0, 1, 2, 3, brown.RARE, brown.RARE + 5], size)
    classes[0] = brown.END

    def table_of(classes):
        table = np.zeros((brown.ONCE, brown.ONCE))
        np.add.at(table, (classes[:, None], classes[None, :]), words)
        return table

    rest = np.arange(10, size)
    parts = [(i, side * brown.ONCE + classes[v], c) for i, w in enumerate(rest) for side, line in ((0, words[:, w]), (1, words[w])) for v, c in enumerate(line) if c]
    got = brown.moved(table_of(classes), classes[rest], words[rest, rest], *(np.array(p) for p in zip(*parts)))
    for w, b in zip(rest, got):
        options = {c: brown.likelihood(table_of(np.where(np.arange(size) == w, c, classes))) for c in {*classes.tolist()} - {brown.END}}
        assert options[b] >= max(options.values()) - 1e-6
    assert (got != classes[rest]).any()


def test_words_outside_the_head_are_exchanged_too(spark, monkeypatch):
    draw = random.Random(6)  # after a frequent word come two rare ones, the second of the kind of the first
    kinds = [[f"{k}{i}" for i in range(60)] for k in "abcd"]
    made = [[(f"h{draw.randrange(8)}", draw.choice(kinds[k]), draw.choice(kinds[(k + 1) % 4])) for k in (draw.randrange(4) for _ in range(20))] for _ in range(300)]
    rows = [(i, " ".join(" ".join(three) for three in x)) for i, x in enumerate(made)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    values, chosen, heads, plain, outer, inner = [], [], [], brown.likelihood, brown.exchange_others, brown.exchange
    monkeypatch.setattr(brown, "exchange", lambda *given: heads.append(inner(*given)) or heads[-1])
    monkeypatch.setattr(brown, "likelihood", lambda table: values.append((len(table), plain(table))) or values[-1][1])
    monkeypatch.setattr(brown, "exchange_others", lambda *given: chosen.append(outer(*given)) or chosen[-1])
    monkeypatch.setattr(brown, "HEAD", 8)
    whole = sum(r["score"] for r in brown.score_documents(docs).collect() if r["held_out"])
    of = {r["word"]: r["class"] for r in chosen[0].collect()}
    learnt = [x.split() for d, x in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    counts = collections.Counter(t for x in learnt for t in x)
    assert of.keys() == {t for t, c in counts.items() if c > 1 and t[0] != "h"} and chosen[0].count() == len(of)
    # The likelihood is that of all bigrams of words seen twice or more, and the exchange has raised it.
    core = [w for w, _ in sorted(((w, c) for w, c in counts.items()), key=lambda p: (-p[1], p[0].encode()))[:8]]
    of |= dict(zip(core, heads[0].tolist()))
    table = np.zeros((brown.ONCE, brown.ONCE))
    for x in learnt:
        path = [brown.END, *(of.get(t, -1) for t in x), brown.END]
        for a, b in zip(path, path[1:]):
            table[a, b] += a >= 0 and b >= 0
    found = [v for n, v in values if n == brown.ONCE]
    assert max(found) == pytest.approx(plain(table), rel=1e-9) and max(found) > found[0] + 0.01 * abs(found[0])
    monkeypatch.setattr(brown, "CORE", 8)
    capped = brown.score_documents(docs)
    assert whole > sum(r["score"] for r in capped.collect() if r["held_out"]) + 100


def test_a_sweep_sends_one_row_for_two_parts_and_scores_do_not_depend_on_parts(spark, monkeypatch):
    draw = random.Random(8)
    texts = [" ".join(f"w{int(draw.paretovariate(0.5)) % 300}" for _ in range(40)) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sent, inner = [], brown.classes_seen
    monkeypatch.setattr(brown, "classes_seen", lambda states, requests, of: sent.append((states.count(), requests.count())) or inner(states, requests, of))
    monkeypatch.setattr(brown, "HEAD", 20)
    monkeypatch.setattr(brown, "MOST_PARTS", 1)
    scores = []
    for words in (1 << 14, 20):
        monkeypatch.setattr(brown, "PART_WORDS", words)
        scores.append(sorted((r["doc_id"], r["score"]) for r in brown.score_documents(docs).collect()))
    assert scores[0] == scores[1]
    assert sent[0][0] == 1 and sent[-1][0] > 2 and all(rows <= parts * parts for parts, rows in sent)


def test_words_are_drawn_as_spark_hashes_them(spark):
    rows = spark.createDataFrame([("a",), ("déf",), ("x" * 50,)], "word string")
    for turn in (0, 7):
        got = rows.select(brown.F.xxhash64("word").alias("one"), brown.F.xxhash64("word", brown.F.lit(turn)).alias("two")).collect()
        assert brown.hashed_again(np.array([r["one"] for r in got]), turn).tolist() == [r["two"] for r in got]


def test_empty_tables(empty):
    for made in (brown.score_documents(empty), repair.round_trip(empty, BYTE), packing.pack(empty, WORD), encode_table(empty, PIECE)):
        assert made.count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(ALPHABET, max_size=6))
def test_encoder_is_the_library(texts):
    for path in (BYTE, WORD):
        encoder = Encoder(path)
        for _ in range(2):
            got = encoder.encode(pa.array(texts, pa.string()))
            assert [g.tolist() for g in got] == [w.tolist() for w in encoder.whole(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=list("'srevlmdtLxAé7-. \t\n"), max_size=14), max_size=6))
def test_pieces_cut_by_kinds_of_bytes(texts):
    """Apostrophes, blanks, digits and ends of texts in any order, against the library."""
    for path in (BYTE, WORD):
        encoder = encoding.encoder(path)
        got = encoder.encode(pa.array(["", *texts], pa.string()))
        assert [g.tolist() for g in got] == [w.tolist() for w in encoder.whole(["", *texts])]


def test_memory_keeps_what_is_asked_for():
    made = []

    def make(name):
        made.append(name)
        return np.array([ord(c) for c in name], "<u4").tobytes()

    memory = encoding.Memory(make, limit=2_000)
    for turn in range(40):
        names = ["often", "", *(f"{turn} {i}" for i in range(turn % 7))]
        ids, begins, sizes = memory.ask(pa.array(names, pa.string()))
        assert ["".join(map(chr, ids[b : b + n])) for b, n in zip(begins, sizes)] == names
        assert memory.nbytes() < 3_000
    assert made.count("often") == 1 and len(made) == len(set(made))
    memory = encoding.Memory(make, limit=50)  # too small even for what is found again
    for _ in range(5):
        ids, begins, sizes = memory.ask(pa.array(["x" * 40, "often"], pa.string()))
        assert sizes.tolist() == [40, 5]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_grammar_gives_back_any_range(ids, a, b):
    ids = np.array(ids * 5, dtype="<u4")
    for base in (10, 100_000):
        symbols, rules = repair.compress(ids, base)
        shard = repair.Shard(base, rules.tobytes(), repair.expansion_lengths(rules, base).tobytes(), symbols.tobytes())
        a, b = sorted((min(a, len(ids)), min(b, len(ids))))
        assert shard.decode(a, b).tolist() == ids[a:b].tolist()


def test_grammar_compresses():
    ids = np.tile(np.arange(40, dtype="<u4"), 500)
    symbols, rules = repair.compress(ids, 1000)
    assert len(symbols) + 2 * len(rules) < len(ids) / 10


@pytest.mark.parametrize("base", [50_257, 65_000, 100_000])
def test_grammar_leaves_no_pair_found_often(base):
    draw = np.random.default_rng(3)
    phrases = [draw.integers(0, 50_000, 6) for _ in range(4000)]
    ids = np.concatenate([phrases[i] for i in np.minimum(draw.zipf(1.3, 40_000), 4000) - 1]).astype("<u4")
    symbols, rules = repair.compress(ids, base)
    pairs, times = np.unique(np.stack([symbols[:-1], symbols[1:]], 1)[symbols[:-1] != symbols[1:]], axis=0, return_counts=True)
    assert times.max() < repair.LEAST_PAIRS and (base < 65_000 or base + len(rules) > 1 << 16)
    shard = repair.Shard(base, rules.tobytes(), repair.expansion_lengths(rules, base).tobytes(), symbols.tobytes())
    assert (shard.decode(0, len(ids)) == ids).all()


def test_shards_give_back_every_document(odd, spark):
    got = [tuple(r) for r in repair.round_trip(odd, BYTE).orderBy("start").collect()]
    rows = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    library = Encoder(BYTE)
    want = sorted((d is not None, d or 0, len(i) + 1, zlib.crc32(np.append(i, 0).astype("<u4").tobytes())) for (d, _), i in zip(rows, library.whole([t for _, t in rows])))
    assert sorted((d is not None, d or 0, n, c) for d, _, n, c in got) == want
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()[:-1]]
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda d: (d is not None, d or 0))


def test_rows_without_an_id_are_many_ranges(spark, tmp_path):
    rows = [(None if d % 3 else d, prose(d, 30)) for d in range(300)]
    path = str(tmp_path / "s")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put so few rows together again
    try:
        repair.write_shards(documents(spark, rows), BYTE, path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    held = [len(r["nulls"]) for r in spark.read.parquet(path).collect()]
    assert len(held) > 3 and max(held) <= 3 * sorted(held)[len(held) // 2]
    got = repair.read_documents(spark, path).orderBy("start").collect()
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got]).tolist()[:-1]]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))


def test_small_shards(odd, spark, tmp_path):
    repair.write_shards(odd, BYTE, str(tmp_path / "s"), shard_ids=50)
    got = repair.read_documents(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, got.select("doc_id", "n_tokens", "ids_crc32").collect()), key=str) == sorted(
        map(tuple, repair.round_trip(odd, BYTE).select("doc_id", "n_tokens", "ids_crc32").collect()), key=str)


def fewest(sizes, capacity):
    """The smallest number of sequences, by trying all."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[i]}:
            rest = list(rooms)
            rest[rest.index(r)] -= sizes[i]
            place(i + 1, rest)
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bin_completion_is_optimal_on_small_cases(sizes):
    counts = collections.Counter(sizes)
    patterns = packing.complete(counts, 20)
    used = collections.Counter(v for p, n in patterns for v in p for _ in range(n))
    assert used == counts and all(sum(p) <= 20 for p, _ in patterns)
    assert sum(n for _, n in patterns) == fewest(sizes, 20) >= packing.lower_bound(counts, 20)


def fits(sizes, capacity, n):
    """Whether ``n`` sequences are enough, by trying all places of every piece."""
    sizes, rooms, failed = sorted(sizes, reverse=True), [capacity] * n, set()

    def place(i):
        if i == len(sizes):
            return True
        state = (i, tuple(sorted(rooms)))
        if state not in failed:
            for r in {room: r for r, room in enumerate(rooms) if room >= sizes[i]}.values():
                rooms[r] -= sizes[i]
                if place(i + 1):
                    return True
                rooms[r] += sizes[i]
            failed.add(state)
        return False

    return place(0)


@pytest.mark.parametrize("low, high, capacity", [(7, 30, 60), (1, 20, 20), (5, 25, 50), (10, 40, 100)])
def test_bin_completion_is_optimal_on_more_pieces(low, high, capacity):
    draw = random.Random(low)
    for _ in range(60):
        sizes = [draw.randint(low, high) for _ in range(draw.randint(12, 20))]
        patterns = packing.complete(collections.Counter(sizes), capacity)
        n = sum(times for _, times in patterns)
        assert sorted(v for p, times in patterns for v in p * times) == sorted(sizes)
        assert all(sum(p) <= capacity for p, _ in patterns) and not fits(sizes, capacity, n - 1)


@pytest.mark.parametrize("n", [10, 50, 200])
def test_bin_completion_finds_full_sequences(n):
    draw = random.Random(n)
    for _ in range(5):
        counts = collections.Counter()
        for _ in range(n):
            cuts = sorted(draw.sample(range(1, 4096), draw.randint(5, 9)))
            counts.update(b - a for a, b in zip([0, *cuts], [*cuts, 4096]))
        assert sum(times for _, times in packing.complete(counts, 4096)) == n < sum(times for _, times in packing.best_fit(counts, 4096))


def test_bin_completion_takes_apart_what_wastes_most():
    """Of a large table only some sequences are searched; the rest stays as best fit has it."""
    draw = random.Random(8)
    counts = collections.Counter(draw.randint(350, 420) for _ in range(6000))
    patterns = packing.complete(counts, 4096)
    used = collections.Counter()
    for p, times in patterns:
        assert sum(p) <= 4096
        for v in p:
            used[v] += times
    assert used == counts and packing.lower_bound(counts, 4096) <= sum(n for _, n in patterns) < sum(n for _, n in packing.best_fit(counts, 4096))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 20), st.integers(0, 4))
def test_fillings_are_those_no_other_dominates(counts, room, most):
    """Every filling that is passed over is dominated by one that is not: its pieces go into that one's, group by group."""
    given_ = list(packing.fillings(counts, room, most))
    shown = [f for f in given_ if f is not None]
    assert [room - sum(f) for f in shown] == sorted(room - sum(f) for f in shown) and len(set(shown)) == len(shown)
    pieces = sorted(counts.items())
    every = [()]
    for v, n in pieces:
        every = [f + (v,) * k for f in every for k in range(n + 1) if sum(f) + v * k <= room]
    every = [f for f in every if room - sum(f) <= most]
    assert len(given_) == len(every)

    def goes_into(small, large):
        if not small:
            return True
        return any(goes_into(small[1:], (*large[:i], large[i] - small[0], *large[i + 1 :])) for i in range(len(large)) if large[i] >= small[0])

    assert all(any(goes_into(tuple(sorted(f, reverse=True)), s) for s in shown) for f in every)


def test_packing_keeps_every_piece_once(odd):
    got = packing.pack(odd, WORD, capacity=64, keep_ids=True).collect()
    library = Encoder(WORD)
    want = []
    for r in odd.select("doc_id", "text").collect():
        ids = [*library.whole([r["text"] or ""])[0].tolist(), 1]
        want += [(r["doc_id"], k, a, ids[a : a + 64]) for k, a in enumerate(range(0, len(ids), 64))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["ids"]) for r in got), key=str) == sorted(want, key=str)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans]).tolist()[:-1]] and sum(n for _, n in spans) <= 64


@settings(max_examples=60, deadline=None)
@given(st.lists(ALPHABET, max_size=6))
def test_agenda_is_the_library(texts):
    model = PieceModel(PIECE)
    assert model.encode(texts) == (model.library.encode(texts) if texts else [])


def test_pieces_of_odd_documents(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = encode_table(odd, PIECE).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
