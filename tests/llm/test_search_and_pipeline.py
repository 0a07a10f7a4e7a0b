"""Bit-sliced search and the pipeline against brute force; the queries against DuckDB."""

from __future__ import annotations

import math
import random

import corpus_pipeline
import numpy as np
import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, empty, odd, prose  # noqa: F401
from test_documents import cut_plainly, groups_of, plain_fingerprint

from granary.llm import bitslices, queries


def plain_search(rows, every=50, k=5):
    fine = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, tuple(math.floor(256 * x) for x in v)))
    out = []
    for q in {i for i, _ in fine if i % every == 0}:
        pairs = [(-sum(a * b for a, b in zip(own, v)), i) for j, own in fine if j == q for i, v in fine if i != q and len(v) == len(own)]
        out += [(q, n + 1, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for n, (s, i) in enumerate(sorted(pairs)[:k])]
    return sorted(out)


def test_search_is_exact(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(12)]) for i in range(400)]
    rows += [(i, list(rows[i - 400][1])) for i in range(400, 460)]  # ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 10), (502, [math.nan] * 12), (550, [math.inf] * 12), (600, [1.0, 2.0]), (601, [3.0, -1.0]),
             (650, []), (651, []), (None, [0.1] * 12), (700, [0.0] * 12), (750, [1e300] * 12), (751, [-1e300] + [2e300] * 11), (752, [1e300] * 11 + [1.5e300]), (850, [9e6] + [0.3] * 11), (851, [9e6, -9e6] + [1e-3] * 10),
             (900, [3e9] * 12), (901, [3e9] * 11 + [3e9 + 1 / 256]), (902, [-3e9] * 12), (904, [3e9] * 12), (800, [0.5] * 12), (800, [-0.5] * 12), (3, list(rows[3][1]))]
    got = bitslices.search(spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, dims string, block int"))
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == plain_search(rows)


def test_search_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(bitslices, "BLOCK_BYTES", 30 * 21)
    monkeypatch.setattr(bitslices, "LEAST_ROWS", 1)
    monkeypatch.setattr(bitslices, "CHUNK_QUERIES", 3)
    monkeypatch.setattr(bitslices, "CHUNKS_TOGETHER", 2)
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-2, 2) for _ in range(5)]) for i in range(250)]
    got = bitslices.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=10)
    want = plain_search([(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows], every=10)
    assert sorted(map(tuple, got.collect())) == want


def test_search_among_wide_vectors_only(spark):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1, 1]) * 2.0 ** draw.randint(20, 70) for _ in range(3)]) for i in range(120)]
    got = bitslices.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20)
    assert sorted(map(tuple, got.collect())) == plain_search(rows, every=20)


def test_search_of_an_empty_table(spark):
    assert bitslices.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=4, max_size=4), min_size=8, max_size=150), st.lists(st.integers(-300, 300), min_size=4, max_size=4))
def test_block_holds_the_best(rows, query):
    rows, query = np.array(rows), np.array(query)
    slices, shift = bitslices.Block.slice_rows(rows)
    ids, scores = bitslices.Block(np.arange(len(rows)), rows, slices, shift).top(-1, query, 5)
    assert sorted(scores.tolist(), reverse=True)[:5] == sorted((rows @ query).tolist(), reverse=True)[:5]


def corpus(spark):
    draw = random.Random(9)
    passage = prose(900, 70)
    rows = [(i, prose(i, draw.randint(60, 200))) for i in range(60)]
    rows += [(100, prose(3, 150)), (101, prose(3, 150)), (102, prose(4, 90) + " " + passage), (103, passage + " " + prose(5, 80)), (104, "short"), (105, None),
             (106, "again and again and again we go on " * 20), (107, prose(6, 60) + " mail bob@example.com now"), (108, prose(7, 200).replace(" ", "%%% "))]
    return rows, documents(spark, rows)


def test_stages_against_brute_force(spark, sf=None):
    rows, docs = corpus(spark)
    kept = corpus_pipeline.quality(spark, docs, "")
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and ids == {d for d, _ in rows} - {104, 105, 106, 108}
    single = corpus_pipeline.near_copies(spark, docs, "")
    prints = {d: plain_fingerprint(t) for d, t in rows}
    group = groups_of(set(prints.values()))
    firsts = {}
    for d, _ in sorted(rows):
        firsts.setdefault(group[prints[d]], d)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(firsts.values()) and 101 not in firsts.values()
    cut = {r["doc_id"]: r for r in corpus_pipeline.passages(spark, docs, "").collect()}
    want = {d: (n, gone) for d, n, gone, _ in cut_plainly(rows)}
    assert set(cut) == {d for d, _ in rows if not (want[d][1] and want[d][0] == want[d][1])}
    for d, t in rows:
        if d in cut:
            left = cut[d]["text"]
            assert (left == t) if not want[d][1] else len(left.split()) == want[d][0] - want[d][1]
            assert t is None or cut[d]["n_chars"] == len(left)
    hidden = {r["doc_id"]: r["text"] for r in corpus_pipeline.private(spark, docs, "").collect()}
    assert hidden[107].endswith("mail [EMAIL] now") and all(hidden[d] == t for d, t in rows if d != 107)
    assert {r["doc_id"] for r in corpus_pipeline.packing(spark, docs, "").collect()} == {d for d, _ in rows}


def test_stages_on_odd_and_empty_documents(spark, odd, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
        assert stage(spark, odd, "").count() > 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, "").columns == odd.columns


def test_repeated_rows_are_one_near_copy(spark):
    rows = [(7, prose(1, 50))] * 3 + [(7, prose(2, 50)), (8, prose(1, 50)), (None, prose(3, 50)), (None, prose(3, 50))]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies(spark, documents(spark, rows), "").collect()]
    assert sorted(got, key=str) == sorted([(7, prose(1, 50)), (7, prose(2, 50)), (None, prose(3, 50))], key=str)


def test_near_copies_are_texts_that_share_four_fifths_of_their_shingles(spark):
    draw = random.Random(12)
    rows = []
    for i in range(40):
        words = prose(i, draw.randint(100, 600)).split()
        rows.append((10 * i, " ".join(words)))
        for k in range(1, draw.randint(1, 5)):
            for _ in range(max(1, len(words) // draw.choice([25, 50, 100, 200]))):
                words[draw.randrange(len(words))] = "new" + str(draw.randrange(10**6))
            rows.append((10 * i + k, " ".join(words)))
    rows += [(1000 + i, prose(900, 150) + " " + prose(901 + i, 100)) for i in range(10)]  # a passage in common is no copy
    shingles = {d: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)} for d, t in rows}
    least = {d: d for d in shingles}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    far = 0
    for a in shingles:
        for b in shingles:
            common = len(shingles[a] & shingles[b])
            if a < b and common >= 0.8 * (len(shingles[a]) + len(shingles[b]) - common):
                x, y = top(a), top(b)
                least[max(x, y)] = min(x, y)
                far += (plain_fingerprint(dict(rows)[a]) ^ plain_fingerprint(dict(rows)[b])).bit_count() > 2
    got = corpus_pipeline.near_copies(spark, documents(spark, rows).repartition(4), "")
    assert far > 20 and sorted(r["doc_id"] for r in got.collect()) == sorted({top(d) for d in shingles})


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries(name, spark, folder, duck):
    made = queries.queries()[name](spark, folder)
    sql = queries.oracle_sql().get(name)
    if sql:
        assert difference(made, duck, sql) is None
    else:
        assert made.count() > 0
