"""Quality, repeats, near duplicates, personal data and sharding against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from llm_cases import documents, empty, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from granary.llm import outliers, private, repeats, sharding, simhash
from granary.llm.graphs import components
from granary.llm.text import text_mark

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def by_key(rows):
    return sorted(rows, key=str)


# quality


def plain_counts(text):
    words, lines = SPACE.findall(text or ""), (text or "").split("\n")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    full = [x for x in lines if SPACE.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(covered)


def test_counts(odd):
    got = outliers.judge(odd).collect()
    want = []
    for d, t in pairs(odd):
        c = plain_counts(t)
        want.append((d, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert by_key([(r["doc_id"], *(r[c] for c in outliers.COUNTS), r["base_failed"]) for r in got]) == by_key(want)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_symbol_junk_is_rejected_and_prose_is_kept(spark):
    draw = random.Random(2)
    rows = [(i, prose(i, draw.randint(30, 600)), "en" if i % 3 else None, f"s{i % 2}") for i in range(200)]
    rows += [(1000 + i, re.sub(r"(\w) ", r"\1%%% ", prose(500 + i, 100)), "en", "s0") for i in range(8)]
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(documents(spark, rows)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(8))


def test_a_few_far_rows_do_not_move_the_estimate(spark):
    draw = np.random.default_rng(0)
    near = draw.normal(size=(400, outliers.P)) * 0.5
    far = draw.normal(size=(80, outliers.P)) * 0.5 + 20
    sums = []
    for part in (near, far):
        sums += [tuple(int(v * outliers.UNIT) for v in row) for row in part]
    rows = spark.createDataFrame([("c", *r) for r in sums], "cell string, " + ", ".join(f"x{i} long" for i in range(outliers.P)))
    estimates = outliers._estimates(outliers._with_prior(outliers._starts(rows)), 1.0)
    for _ in range(outliers.STEPS):
        estimates = outliers._estimates(outliers._with_prior(outliers._concentrate(rows, estimates)), outliers.core_widening())
    best = min(estimates.collect(), key=lambda r: r["logdet"])
    assert all(abs(best[f"m{i}"]) < 0.2 for i in range(outliers.P))


def test_a_third_of_copies_is_rejected_and_hides_nothing(spark):
    draw = random.Random(7)
    junk = re.sub(r"(\w) ", r"\1%%% ", prose(500, 100))
    rows = [(i, prose(i, draw.randint(100, 400))) for i in range(200)]
    rows += [(1000 + i, junk) for i in range(50)]
    rows += [(1100 + i, f"{junk} {i}") for i in range(50)]
    rows += [(2000, re.sub(r"(\w) ", r"\1## ", prose(900, 200)))]
    got = {r["doc_id"]: r["kept"] for r in outliers.judge(documents(spark, rows)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[i] for i in got if i >= 1000)


def test_core_is_half_of_the_rows(spark):
    columns = ", ".join(f"x{i} long" for i in range(outliers.P))
    rows = spark.createDataFrame([("c", *([v * outliers.UNIT] * outliers.P)) for v in [0] * 60 + [30] * 40], "cell string, " + columns)
    estimates = outliers._estimates(outliers._with_prior(outliers._starts(rows)), 1.0)
    assert {r["n"] for r in outliers._concentrate(rows, estimates).collect()} == {53}


def test_chi_square():
    assert outliers.chi2_share(outliers.chi2_point(0.95, 5), 5) == pytest.approx(0.95)
    assert outliers.chi2_point(0.95, 5) == pytest.approx(11.0705, abs=1e-3)


# repeats


def id_and_text_hash(doc, text):
    seed = 42 if doc is None else xxhash.xxh64_intdigest(doc.to_bytes(8, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(text or "", seed) >> 32


def cut_plainly(rows):
    """What is left of distinct (doc_id, text), by the definition."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, id_and_text_hash(*r), r[1] or ""))
    seen, out = set(), {}
    for d, t in order:
        words = SPACE.findall(t or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone |= set(range(i, i + 20))
            seen.add(window)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d, t] = (len(words), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return by_key([(d, *out[d, t]) for d, t in rows])


@pytest.mark.parametrize("crowded", [repeats.CROWDED, 1])
def test_repeats_of_odd_documents(odd, crowded):
    got = repeats.remove_repeats(odd, crowded=crowded)
    assert by_key(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == cut_plainly(pairs(odd))


@pytest.mark.parametrize("crowded", [repeats.CROWDED, 3])
def test_repeats_of_shuffled_passages(spark, crowded):
    draw = random.Random(8)
    passages = [[draw.choice("ab") if p % 3 == 0 else draw.choice("abcdefg") for _ in range(draw.randint(15, 45))] for p in range(12)]
    rows = []
    for d in range(40):
        words = []
        for _ in range(draw.randint(0, 5)):
            words += draw.choice(passages) if draw.random() < 0.6 else [draw.choice("abcdefghij") for _ in range(25)]
        rows.append((d, " ".join(words)))
    got = repeats.remove_repeats(documents(spark, rows).repartition(4), crowded=crowded)
    assert by_key(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == cut_plainly(rows)


def test_prefix_doubling_ranks():
    codes = np.random.default_rng(1).integers(0, 3, 200).astype(np.int32)
    found = repeats.prefix_ranks(codes, (4, 16, 20))
    for depth, ranks in found.items():
        for i in range(0, 180):
            for j in range(0, 180, 7):
                left, right = codes[i : i + depth].tolist(), codes[j : j + depth].tolist()
                assert (ranks[i] == ranks[j], ranks[i] < ranks[j]) == (left == right, left < right)


@pytest.mark.parametrize("seed", range(30))
def test_subtree_against_all_pairs(seed):
    """The deepest node under which a suffix isn't the earliest is as deep as the longest run shared with any earlier one."""
    draw = np.random.default_rng(seed)
    passages = [draw.integers(0, 1 + seed % 4, 34) for _ in range(3)]
    strings = []
    for _ in range(40):
        n, passage = int(draw.integers(20, 35)), passages[draw.integers(3)]
        a = int(draw.integers(0, 35 - n))
        string = passage[a : a + n].copy()
        if draw.random() < 0.4:
            string[draw.integers(n)] = 9
        strings.append(string)
    codes = np.concatenate([np.append(x, 100 + i) for i, x in enumerate(strings)])
    begin = np.cumsum([0] + [len(x) + 1 for x in strings[:-1]])
    places = np.concatenate([np.arange(b, b + len(x) - 19) for b, x in zip(begin, strings)])
    age = draw.permutation(len(places))
    got = repeats.shared_with_earlier(codes, places, age)

    def shared(i, j):
        k = 0
        while max(i, j) + k < len(codes) and codes[i + k] == codes[j + k]:
            k += 1
        return k

    for i, place in enumerate(places):
        most = max((shared(place, other) for other in places[age < age[i]]), default=0)
        assert got[i] == (most if most >= 20 else 0)


def test_rows_under_one_id_are_spread_and_their_order_does_not_depend_on_blocks(spark, monkeypatch):
    passage = prose(1, 45)
    rows = [(None if d % 3 == 0 else d, prose(d + 10, 30) + " " + passage) for d in range(90)]
    docs = documents(spark, rows)
    sizes = [r["count"] for r in repeats._in_blocks(docs.select("doc_id", "text"), 6).groupBy("block").count().collect()]
    assert len(sizes) == 6 and max(sizes) <= 3 * sorted(sizes)[3]
    want = cut_plainly(rows)
    for block_bytes in (4 << 20, 2_000):
        monkeypatch.setattr(repeats, "BLOCK_BYTES", block_bytes)
        got = repeats.remove_repeats(docs, crowded=repeats.CROWDED if block_bytes > 1 << 20 else 5)
        assert by_key(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == want


def test_groups_larger_than_a_batch(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_WORDS", 60)
    rows = [(d, prose(1, 60) if d % 2 else prose(d, 40)) for d in range(30)]
    segments = repeats._segments(*_prepared(documents(spark, rows)))
    spans = repeats._tree_repeats(segments).collect()
    assert {r["doc"] for r in spans} == set(range(3, 30, 2))


def _prepared(docs):
    blocks = repeats._in_blocks(docs.select("doc_id", "text"), 2)
    anchors = repeats._anchor_rows(blocks)
    again = anchors.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key", F.lit(False).alias("crowded"))
    return repeats._packed(blocks), anchors.select("block", "key").join(again, "key").distinct()


# near duplicates


def plain_fingerprint(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(values, radius=2):
    """Components of integers linked at ``radius`` or fewer differing bits."""
    values, parent = list(values), {}

    def top(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[top(a)] = top(b)
    return {v: top(v) for v in values}


def test_near_duplicates_of_odd_documents(odd):
    rows = pairs(odd)
    prints = {t: plain_fingerprint(t) for _, t in rows}
    group = groups_of(set(prints.values()))
    least = collections.defaultdict(list)
    for d, t in rows:
        least[group[prints[t]]] += [d] if d is not None else []
    want = [(d, f"{prints[t]:016x}", min(least[group[prints[t]]], default=None)) for d, t in rows]
    assert by_key(map(tuple, simhash.near_duplicates(odd).drop("mark", "root").collect())) == by_key(want)


@pytest.mark.parametrize("shard_rows", [simhash.SHARD_ROWS, 2])
def test_links_connect_what_brute_force_connects(spark, shard_rows):
    draw = random.Random(4)
    values = set()
    for _ in range(30):
        v = draw.getrandbits(64)
        for _ in range(draw.randint(1, 25)):
            values.add(v)
            v ^= sum(1 << draw.randrange(64) for _ in range(draw.randint(1, 3)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), shard_rows=shard_rows))
    roots = {r["node"] & (1 << 64) - 1: r["root"] for r in found.collect()}
    group = groups_of(values)
    sizes = collections.Counter(group.values())
    assert set(roots) == {v for v in values if sizes[group[v]] > 1}
    assert len({(group[v], roots[v]) for v in roots}) == len({group[v] for v in roots}) == len(set(roots.values()))


def test_bk_tree_finds_all_within_the_radius():
    draw = random.Random(1)
    values = [draw.getrandbits(16) for _ in range(200)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:20]:
        assert sorted(tree.values[i] for i in tree.within(q, 3)) == sorted(v for v in tree.values if (v ^ q).bit_count() <= 3)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(edges).collect()} == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


# personal data

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (14 <= len(digits) <= 19 and private.passes_luhn(digits)):
                continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, m.end()))
    return sorted(found)


def test_base_spans_are_the_patterns():
    draw = random.Random(6)
    parts = ["a.b", "@", "c-d", ".com", "1", "23", "255", "256", ".", " ", "-", "+1", "(555)", "4111111111111111", "é", "4111 1111 1111 1111", "\n"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert private.base_spans(text) == plain_spans(text), text


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"{prose(i, 30)} please call me +1 (555) 0{i:02d}-7{i:03d} today {prose(i + 99, 9)}") for i in range(40)]
    rows += [(100, f"{prose(70, 20)} please call me 555-0134-99 today"), (101, prose(71, 60) + " the 555-0134-99 of"), (102, "the 555-0135-98 of " + prose(72, 50))]
    got = {r["doc_id"]: r for r in private.find(documents(spark, rows)).collect()}
    text = dict(rows)[100]
    at = text.index("555-0134-99")
    assert got[100]["spans"] == f"phone:{at}:{at + 11}" and got[100]["n_phone"] == 0
    assert got[101]["spans"] != "" and got[102]["spans"] == ""
    assert got[3]["spans"].startswith("phone:") and got[3]["n_phone"] == 1
    hidden = {r["doc_id"]: r["text"] for r in private.redact(documents(spark, rows)).collect()}
    assert hidden[100] == text.replace("555-0134-99", "[PHONE]") and hidden[102] == dict(rows)[102]


def plain_bootstrap(rows):
    """Spans of every text, with patterns and instances scored in dicts."""
    slots = {d: private.slots(t, private.base_spans(t)) for d, t in rows}
    every = [s for found in slots.values() for s in found]
    links = {(s["kind"], s["instance"], p) for s in every for p in s["patterns"]}
    seeds = {(s["kind"], s["instance"]) for s in every if s["seed"] and s["patterns"]}
    within = collections.defaultdict(set)
    for _, i, p in links:
        within[p].add(i)
    trust = {(k, i): 1.0 * ((k, i) in seeds) for k, i, _ in links}
    while True:
        worth, next_trust = {}, dict(trust)
        for kind, pattern in {(k, p) for k, _, p in links}:
            found = [trust[kind, i] for k, i, p in links if (k, p) == (kind, pattern)]
            if sum(t >= 0.9 for t in found) >= 5:
                worth[kind, pattern] = sum(found) / (len(within[pattern]) + 1)
        for kind, i in trust:
            known = [worth[kind, p] for k, j, p in links if (k, j) == (kind, i) and (kind, p) in worth]
            next_trust[kind, i] = max(trust[kind, i], round(1 - math.prod(1 - w for w in known), 6))
        if next_trust == trust:
            break
        trust = next_trust
    out = {}
    for d, t in rows:
        base = private.base_spans(t)
        more = {(s["start"], s["kind"], s["end"]) for s in slots[d] if not s["seed"] and (s["kind"], s["instance"]) not in seeds and trust.get((s["kind"], s["instance"]), 0) >= 0.9}
        more = [m for m in more if not any((o[0], o[2]) != (m[0], m[2]) and o[0] <= m[0] and m[2] <= o[2] for o in more)]
        out[d] = private.written(sorted(base + more))
    return out


def test_contexts_find_spaced_identifiers(spark):
    card = lambda i: next(n for n in range(4_000_000_000_000_000 + 97 * i, 10**17) if private.passes_luhn(str(n)))
    spaced = lambda n: " ".join(str(n)[j : j + 4] for j in (0, 4, 8, 12))
    rows = [(i, f"{prose(i, 30)} please call me +1 (555) 0{i:02d}-7{i:03d} today {prose(i + 99, 9)}") for i in range(40)]
    rows += [(200 + i, f"{prose(i, 9)} bill my card {spaced(card(i))} soon {prose(i + 50, 9)}") for i in range(40)]
    wrong = spaced(card(3) + 1)
    cases = {100: ("(555) 123-4567", "phone"), 101: ("555 123 4567", "phone"), 102: ("555-0134-99", "phone")}
    rows += [(d, f"{prose(d, 20)} please call me {x} today {prose(d + 1, 5)}") for d, (x, _) in cases.items()]
    rows += [(104, f"{prose(80, 20)} bill my card {wrong} soon"), (105, f"{prose(81, 20)} the 555 123 4568 of 12 34 56 78 90 and ({wrong[:-1]}9) or 7 8")]
    got = {r["doc_id"]: r["spans"] for r in private.find(documents(spark, rows)).collect()}
    texts = dict(rows)
    for d, (x, kind) in (cases | {104: (wrong, "card")}).items():
        at = texts[d].index(x)
        assert f"{kind}:{at}:{at + len(x)}" in got[d].split(","), (d, got[d])
    assert got[105] == "" and got == plain_bootstrap(rows)
    hidden = {r["doc_id"]: r["text"] for r in private.redact(documents(spark, rows)).collect()}
    assert hidden[100] == texts[100].replace("(555) 123-4567", "[PHONE]") and hidden[105] == texts[105]


def test_contexts_go_on_until_nothing_is_learned(spark):
    """Four hops: every group of numbers is also found in the next group's contexts."""
    number = lambda hop, i: f"{hop}55-01{i:02d}-9{hop}"
    frames = ["please call me {} today", "ring that line {} soon", "our old desk {} now", "use his fax {} then", "her new home {} later"]
    rows = [(i, frames[0].format(f"+1 (555) 0{i:02d}-7{i:03d}")) for i in range(25)]
    for hop in range(1, 5):
        for i in range(25):
            rows += [(1000 * hop + i, frames[hop - 1].format(number(hop, i))), (1000 * hop + 500 + i, frames[hop].format(number(hop, i)))]
    draw = random.Random(5)
    rows += [(9000 + i, f"{prose(i, 12)} 12-34-56-{draw.randint(10, 99)} {prose(i + 7, 4)}") for i in range(20)]
    got = {r["doc_id"]: r["spans"] for r in private.find(documents(spark, rows)).collect()}
    assert got == plain_bootstrap(rows)
    assert all(got[1000 * hop + 500 + i] for hop in range(1, 5) for i in range(25))


def test_digit_runs():
    at = lambda t: [t[a:b] for a, b in private.runs(t)]
    assert at("x (555) 123-4567.") == ["(555) 123-4567"] and at("555 123 4567") == ["555 123", "555 123 4567", "123 4567"]
    assert at("(see 555 1234)") == ["555 1234"] and at("a1 2 3b") == [] and at("+44 20 7946") == ["+44 20", "+44 20 7946", "20 7946"]
    long = " ".join("1" * 5 for _ in range(5000))
    assert len(at(long)) == 4999 + 4998


def test_odd_documents_keep_base_spans(odd, spark):
    extra = documents(spark, [(30, "mail é🙂 a@b.co and 1.2.3.4"), (30, "mail é🙂 a@b.co and 1.2.3.4"), (31, None), (None, "x@y.z")])
    both = odd.union(extra)
    got = private.find(both).collect()
    want = []
    for d, t in pairs(both):
        spans = plain_spans(t or "")
        text = private.written(spans)
        want.append((d, *(sum(k == i for _, k, _ in spans) for i in range(4)), hashlib.sha256(text.encode()).hexdigest(), text))
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert by_key([tuple(r[c] for c in names) for r in got]) == by_key(want)
    hidden = private.redact(both)
    assert hidden.columns == both.columns and hidden.count() == both.count()
    assert "mail é🙂 [EMAIL] and [IP]" in [r["text"] for r in hidden.collect()]


# sharding


def test_shards_of_odd_documents(odd):
    got = sharding.shard_documents(odd, shards=3).collect()
    want = by_key((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs(odd))
    assert by_key((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_are_even_though_a_source_and_a_text_are_hot(spark):
    draw = random.Random(5)
    rows = [(i, "copied text " * 20 if i % 4 == 0 else "x" * draw.randint(1, 600), draw.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    got = sharding.shard_documents(documents(spark, rows)).collect()
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 24
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    assert {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)


def test_target_bytes_and_one_shard(spark):
    docs = documents(spark, [(i, "y" * 92) for i in range(50)])
    assert {r["shard"] for r in sharding.shard_documents(docs, shards=None, target_bytes=1000).collect()} == set(range(5))
    assert {r["shard"] for r in sharding.shard_documents(docs, shards=1).collect()} == {0}


def test_sharding_runs_no_python(odd):
    from conftest import plan_of

    assert "Python" not in plan_of(sharding.shard_documents(odd))


def test_empty_tables(empty):
    for made in (outliers.judge(empty), repeats.remove_repeats(empty), simhash.near_duplicates(empty), private.find(empty), private.redact(empty), sharding.shard_documents(empty)):
        assert made.count() == 0


def test_mark_is_the_hash_of_the_text(odd):
    for r in odd.select("text", text_mark("text").alias("m")).collect():
        assert r["m"] & (1 << 64) - 1 == xxhash.xxh64_intdigest(r["text"] or "", 42)
