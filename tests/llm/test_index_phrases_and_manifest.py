"""The positional index, collocations and the Merkle manifest against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import documents, empty, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from granary.llm import collocations, manifest, positions

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# positional index


def runs_in_order(words, phrase, slop):
    """Whether the phrase's words come in order among at most ``slop`` others."""
    for start, word in enumerate(words):
        if word == phrase[0]:
            at = start
            for wanted in phrase[1:]:
                at = next((i for i in range(at + 1, min(len(words), start + len(phrase) + slop)) if words[i] == wanted), None)
                if at is None:
                    break
            if at is not None:
                return True
    return False


def plain_contaminated(docs, items, window=10, slop=2):
    phrases = collections.defaultdict(set)
    for item, text in items:
        words = alnum(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases[tuple(words[i : i + window])].add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        words = alnum(text)
        hit, found, near = set(), set(), set()
        for phrase, owners in phrases.items():
            n = len(phrase)
            at = [i for i in range(len(words) - n + 1) if tuple(words[i : i + n]) == phrase]
            hit.update(i + j for i in at for j in range(n))
            found |= owners if at else set()
            near |= owners if runs_in_order(words, phrase, slop) else set()
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit), len(near)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def bench(spark):
    passage = prose(2, 60)
    rows = [
        (1, " ".join(passage.split()[5:40])), (2, "A a a a A A A a a a a"), (3, "one"), (None, "line ONE, is"), (4, None), (5, ""), (6, " ... "),
        (7, prose(3, 80)), (8, " ".join(passage.split()[20:33])), (8, "你好"), (9, prose(900, 200)), (10, "line one here"),
        (11, " ".join(w for i, w in enumerate(prose(3, 80).split()[:14]) if i not in (3, 9))),
    ]
    return spark.createDataFrame([(*r, "slice", 1, "term") for r in rows], "item_id long, text string, slice string, n int, key string")


@pytest.mark.parametrize("slice_bytes", [1, 4000, 8 << 20])
def test_phrases_are_those_of_brute_force(odd, bench, slice_bytes):
    docs = odd.where("doc_id <> 14 or doc_id is null")
    index = positions.build_index(docs, slice_bytes=slice_bytes)
    rows = positions.find_phrases(index, positions.segments(bench)).collect()
    assert len(rows) == docs.count()
    want = plain_contaminated([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    found = [
        (None if r["key"] is None else int(r["key"]), r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["items"]), sha(",".join(r["items"])), bool(r["spans"]), len(r["near"]))
        for r in rows
    ]
    assert sorted(found, key=str) == want
    assert any(w[6] > w[3] for w in want)


def test_long_text_and_random_phrases(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 300))) for _ in range(40)]
    items = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(1, 14)))) for i in range(60)] + [(100, texts[3][:150])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, positions.contaminated(docs, bench).collect()), key=str) == plain_contaminated(list(enumerate(texts)), items)


def test_index_without_documents_or_items(odd, empty, bench):
    assert positions.contaminated(empty, bench).count() == 0
    rows = positions.contaminated(odd, bench.limit(0)).collect()
    assert len(rows) == odd.count() and not any(r["contaminated"] or r["n_items"] or r["n_near"] for r in rows)


# collocations


def plain_collocations(rows, threshold, top):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        long = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        kept = []
        for p, a in long.items():
            inside = [q for q in long if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * long[q] >= 100 * a for q in inside):
                cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 2000, "counters": 40}])
def test_collocations_are_those_of_brute_force(spark, odd, how):
    draw = random.Random(3)
    rows = [(draw.choice(["en", "de", None, "und"]), prose(i, 60).replace(" this", "\tThis,").replace(" be", "  be\n")) for i in range(60)]
    rows += [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()] + [("en", "very common line of words. " * 40)] * 8
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "lang string, text string, phrase string, block int").repartition(3)
    for top in (2000, 3):
        got = sorted(map(tuple, collocations.collocations(docs, threshold=6, top=top, **how).collect()))
        assert got == plain_collocations(rows, 6, top) and got


def test_collocations_of_nothing(empty, odd):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(odd.where("text is null")).count() == 0


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_999_999_999_999
    row = spark.createDataFrame([(big, 9 * big, big + 1, big + 2)], "a long, n long, l long, r long")
    got = row.select(collocations._score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1000 * big * 9 * big // ((big + 1) * (big + 2))


@pytest.mark.parametrize("seed", range(6))
def test_merged_summaries_keep_every_frequent_key(seed):
    """Summaries of parts, some of them merged before, lose no key found threshold times and stay within their capacity."""
    draw = np.random.default_rng(seed)
    stream = draw.zipf(1.2, 60_000).astype(np.uint64) % np.uint64(20_000)
    threshold = 50
    capacity = len(stream) // threshold + 1
    one = lambda keys: np.unique(keys, return_counts=True)
    parts = [collocations.Summary(capacity) for _ in range(3)]
    for i, piece in enumerate(np.array_split(stream, 30)):
        parts[i % 3].add(*one(piece))
    merged = collocations.Summary(capacity)
    for part in parts:
        merged.add(part.keys, part.counts)
        merged.lose(part.taken)
    keys, n = one(stream)
    assert len(merged.keys) <= capacity and merged.taken < threshold
    assert set(keys[n >= threshold].tolist()) <= set(merged.at_least(threshold).tolist())
    small = collocations.Summary(64)
    small.add(*one(stream))
    assert small.taken > 0 and len(small.keys) <= 64 and small.taken <= len(stream) // 65


# manifest


def plain_tree(nodes):
    """(root, siblings of every node from the lowest level up)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            beside = p ^ 1
            paths[i].append((nodes[beside] if beside < len(nodes) else "", beside < p))
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], paths


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_manifest(rows):
    by = collections.defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        by[lang].append((doc_id, plain_leaf(doc_id, source, lang, n_chars, text), plain_leaf(doc_id, source, lang, n_chars + tampered if n_chars is not None else None, text)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        by[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    low = {lang: plain_tree([x[1] for x in by[lang]]) for lang in langs}
    root, above = plain_tree([low[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, upper in zip(langs, above):
        for (doc_id, first, shown), path in zip(by[lang], low[lang][1]):
            node = shown
            for sibling, left in path + upper:
                node = sha(sibling + node if left else node + sibling)
            out.append((doc_id, first, low[lang][0], root, sha("".join(s for s, _ in path + upper)), node, node == root))
    return sorted(out, key=str)


FIVE = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_manifest_is_that_of_brute_force(spark, odd, bits):
    more = [(i, prose(i, 20), ["en", "de", "fr", None, "日本"][i % 5 if i % 3 else 0], None if i % 4 else "s") for i in range(100, 175)]
    docs = odd.unionByName(documents(spark, more)).withColumn("n_chars", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("n_chars")))
    docs = docs.withColumn("leaf", F.lit("x")).withColumn("level", F.lit(1)).withColumn("node", F.lit("n"))
    want = plain_manifest([tuple(r) for r in docs.select(*FIVE).collect()])
    got = sorted(map(tuple, manifest.verified(docs, bits).collect()), key=str)
    assert got == want
    assert {True, False} == {r[-1] for r in got}


def test_manifest_of_one_row_one_language_and_nothing(spark, odd, empty):
    assert manifest.verified(empty).count() == 0
    for docs in (odd.where("doc_id = 12"), odd.where("doc_id in (1, 2, 12)"), odd.where("doc_id is null")):
        assert sorted(map(tuple, manifest.verified(docs).collect()), key=str) == plain_manifest([tuple(r) for r in docs.select(*FIVE).collect()])


def test_a_third_of_equal_rows_keeps_ranges_even(spark):
    rows = documents(spark, [(None, "the same text") for _ in range(200)] + [(i, prose(i, 5)) for i in range(400)])
    leaves = manifest.settle(rows.select("lang", "doc_id", F.monotonically_increasing_id().alias("nr")), "leaves")
    got = manifest.placed(leaves, "lang", ["doc_id", "nr"])
    assert sorted(r["place"] for r in got.collect()) == list(range(600))
    assert [tuple(r) for r in manifest.verified(rows).agg(F.count("*"), F.countDistinct("root")).collect()] == [(600, 1)]
