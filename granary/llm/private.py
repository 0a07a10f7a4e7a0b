"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Base spans of four kinds come from fixed patterns with checks. They are the seeds of a
bootstrap over all documents: the words around a seed make lexical patterns
(two words before; one before and one after), and what is shaped like a kind but not
matched by its base pattern is a candidate: tokens, and runs of neighbouring digit groups
with one space between two ("(555) 123-4567"), with every part of a run that has a number's digits. Patterns
and instances form a graph. Spark scores it in rounds: a pattern is worth the mean confidence of the
distinct instances found in it, an instance of a candidate is as sure as its
patterns together make it. Rounds go on until no confidence rises; it is kept in whole
millionths, so that ends. Candidates at ``SURE`` or above become further
spans at every place where they occur, but for places inside a longer one's; base spans always stay.

A pattern needs ``SUPPORT`` distinct sure instances, so chance neighbours teach nothing.

Nulls: a null text is empty. Spans count code points, ends exclusive. Repeated rows give
repeated rows; an empty table gives an empty one. Of a place that is sure as two kinds both spans are given.
Only doc_id and text are read by ``find``; ``redact`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.text import plain, slices, text_mark
from granary.sources.workspace import settle

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5
SMOOTH = 1.0
SURE = 0.9
UNITS = 1_000_000  # of confidence
AROUND = 64  # characters looked at on either side for context words

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, as its start would match as well; said so, the search is linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
GROUP = re.compile(r"\(?[0-9]++(?:[().-]++[0-9]++)*+\)?")
RUN = re.compile(rf"(?<![^\s\"'(\[{{<])\+?{GROUP.pattern}(?: {GROUP.pattern})+(?![^\s\"'()\[\]{{}}<>,;:.!?])")
MOST_DIGITS = 19  # of any kind
MARKS = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # start, place in KINDS, end


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start and kind."""
    found: list[Span] = []
    if "@" in text:
        last = 0
        for m in EMAIL_REST.finditer(text):
            at = m.start()
            while at > last and text[at - 1] in LOCAL:
                at -= 1
            if at < m.start():
                found.append((at, 0, m.end()))
                last = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def shapes(token: str) -> list[int]:
    """The kinds whose identifiers a token resembles, without being one for the base patterns."""
    if re.fullmatch(r"[^@]+@[^@]+", token):
        return [0]
    if re.fullmatch(r"[0-9]{1,3}([.:-][0-9]{1,3}){3}", token):
        return [1]
    if re.fullmatch(r"\+?[0-9(][0-9(). -]*", token):
        n = sum(c.isdigit() for c in token)
        return [2] * (14 <= n <= 19) + [3] * (7 <= n <= 15)
    return []


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a place."""
    before = [re.sub("[0-9]", "0", w.lower()) for w in text[max(0, start - AROUND) : start].split()[-2:]]
    after = [re.sub("[0-9]", "0", w.lower()) for w in text[end : end + AROUND].split()[:1]]
    return (["< " + " ".join(before)] if len(before) == 2 else []) + ([f"{before[-1]} _ {after[0]}"] if before and after else [])


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Places of words that could be identifiers, without the punctuation around them."""
    for m in TOKEN.finditer(text):
        if MARKS.search(m[0]):
            token = m[0].strip("\"'()[]{}<>,;:.!?")
            if token:
                start = m.start() + m[0].find(token)
                yield start, start + len(token)


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Places of two or more neighbouring digit groups, at most ``MOST_DIGITS`` digits together."""
    for m in RUN.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m[0])]
        digits = [sum(c.isdigit() for c in text[a:b]) for a, b in groups]
        for i, (start, _) in enumerate(groups):
            n = digits[i]
            for j in range(i + 1, len(groups)):  # a group has a digit, so few follow
                n += digits[j]
                if n > MOST_DIGITS:
                    break
                yield start - (i == 0 and start > m.start()), groups[j][1] - unopened(text[start : groups[j][1]])


def unopened(run: str) -> bool:
    """Whether the closing bracket at the end belongs to what is around."""
    return run.endswith(")") and run.count("(") < run.count(")")


def slots(text: str, spans: list[Span]) -> list[dict]:
    """Seeds (``seed`` true) and candidates of a text with the patterns around them."""
    out = [
        {"kind": k, "start": s, "end": e, "instance": text[s:e], "seed": True, "patterns": contexts(text, s, e)} for s, k, e in spans
    ]
    # Before each place in order of starts: how far the base spans that start there or earlier reach.
    starts, reach = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
    for start, end in chain(tokens(text), runs(text)):
        known = bisect_left(starts, end)
        if not known or reach[known - 1] <= start:
            for k in shapes(text[start:end]):
                out.append({"kind": k, "start": start, "end": end, "instance": text[start:end], "seed": False, "patterns": contexts(text, start, end)})
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SLOT = pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string())),
])


def scan(docs: DataFrame) -> DataFrame:
    """(row, doc_id, mark, counts, base_sha256, slots) of every row; ``mark`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            shas, all_slots, counts = [], [], []
            for text in plain(part.column("text")).to_pylist():
                spans = base_spans(text) if MARKS.search(text) else []
                shas.append(hashlib.sha256(written(spans).encode()).hexdigest())
                counts.append([sum(k == kind for _, k, _ in spans) for kind in range(len(KINDS))])
                all_slots.append(slots(text, spans) if MARKS.search(text) else [])
            n = part.num_rows
            columns = [pa.array(range(row, row + n), pa.int64()), part.column("doc_id"), part.column("mark")]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            row += n
            yield pa.record_batch(columns + [pa.array(shas), pa.array(all_slots, pa.list_(SLOT))], names=["row", "doc_id", "mark", *(f"n_{k}" for k in KINDS), "base_sha256", "slots"])

    schema = "row long, doc_id long, mark long, " + ", ".join(f"n_{k} long" for k in KINDS)
    schema += ", base_sha256 string, slots array<struct<kind: int, start: int, end: int, instance: string, seed: boolean, patterns: array<string>>>"
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), text_mark("text").alias("mark")).mapInArrow(run, schema)


def bootstrap(places: DataFrame, support: int = SUPPORT, sure: float = SURE) -> DataFrame:
    """(kind, instance) of the candidates that the rounds are sure of; ``places`` has kind, instance, seed, patterns."""
    edges = settle(
        places.select("kind", "instance", "seed", F.explode("patterns").alias("pattern")).distinct(), "pattern-edges"
    )
    # What a pattern is worth for a kind: instances of the other kinds found in it count against it.
    found = settle(edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "patterns")
    links = edges.groupBy("kind", "instance", "pattern").agg(F.max("seed").alias("seed"))
    known = edges.groupBy("kind", "instance").agg(F.max(F.when(F.col("seed"), UNITS).otherwise(0)).cast("long").alias("trust"))
    known = settle(known.withColumn("rose", F.lit(True)), "instances")
    enough = round(sure * UNITS)
    while not known.filter("rose").isEmpty():
        judged = links.join(known, ["kind", "instance"])
        worth = judged.groupBy("kind", "pattern").agg(F.sum("trust").alias("trust"), F.sum((F.col("trust") >= enough).cast("int")).alias("sure"))
        worth = worth.join(found, "pattern").filter(F.col("sure") >= support)
        worth = worth.select("kind", "pattern", (F.col("trust") / UNITS / (F.col("n") + SMOOTH)).alias("worth"))
        missed = judged.filter(F.col("trust") < UNITS).join(worth, ["kind", "pattern"]).groupBy("kind", "instance")
        now = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("worth"), F.lit(1e-9)))))
        gained = missed.agg(F.round(now * UNITS).cast("long").alias("now"))
        best = F.greatest("trust", F.coalesce("now", F.lit(0)))
        known = settle(
            known.join(gained, ["kind", "instance"], "left").select("kind", "instance", best.alias("trust"), (best > F.col("trust")).alias("rose")),
            "instances",
        )
    seeds = edges.filter("seed").select("kind", "instance").distinct()
    return known.filter(F.col("trust") >= enough).join(seeds, ["kind", "instance"], "left_anti").select("kind", "instance")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, counts of base spans, base_sha256, spans) for every row; ``spans`` holds base spans and those the contexts found."""
    scanned = settle(scan(docs), "scanned")
    places = scanned.select("row", F.explode("slots").alias("s")).select("row", "s.*")
    sure = bootstrap(places)
    base = places.filter("seed").select("row", "kind", "start", "end")
    more = places.filter("not seed").join(sure, ["kind", "instance"]).groupBy("row", "start", "end").agg(F.collect_set("kind").alias("kinds"))
    ahead = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)  # of one text
    outer = more.withColumn("reach", F.max("end").over(ahead)).filter("reach is null or reach < end")
    more = outer.select("row", F.explode("kinds").alias("kind"), "start", "end")
    spans = base.union(more).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("list"))
    names = F.array(*map(F.lit, KINDS))
    text = F.transform("list", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return scanned.drop("slots").join(spans, "row", "left").select(
        "doc_id", "mark", *(f"n_{k}" for k in KINDS), "base_sha256", F.coalesce(F.array_join(text, ","), F.lit("")).alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; overlapping spans are replaced as one."""
    found = find(docs).filter("spans <> ''").select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans")).distinct()
    keyed = docs.withColumns({"__own_doc": F.col("doc_id").cast("long"), "__own_mark": text_mark("text")})
    same = F.col("__own_doc").eqNullSafe(F.col("__doc")) & (F.col("__own_mark") == F.col("__mark"))
    joined = keyed.join(found, same, "left")
    hidden = F.expr(
        """
        aggregate(
          transform(split(__spans, ','), s -> split(s, ':')),
          named_struct('out', '', 'at', 1),
          (acc, s) -> if(cast(s[1] as int) + 1 < acc.at,
            named_struct('out', acc.out, 'at', greatest(acc.at, cast(s[2] as int) + 1)),
            named_struct('out', concat(acc.out, substring(text, acc.at, cast(s[1] as int) + 1 - acc.at), '[', upper(s[0]), ']'), 'at', cast(s[2] as int) + 1)),
          acc -> concat(acc.out, substring(text, acc.at)))
        """
    )
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(hidden)
    return joined.select(*(text.alias("text") if c == "text" else c for c in docs.columns))
