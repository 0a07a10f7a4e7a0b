"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

Per text: counts of words, characters in words, symbols, repeated lines and
words in repeated windows. A text fails the base rules when it has few words or
much repetition. The others are judged by the Mahalanobis distance of their
transformed counts to a robust centre and scatter of their language and source.

The MCD of a group is the scatter of the half of its rows (``CORE``) that gives
the smallest determinant. It is found by concentration steps: rank the rows by
distance under the present estimate, keep the core, estimate anew. A step here
is one aggregation: every row falls in a class of distances an eighth of an
octave wide, sums of rows and products are kept for each class, and the core is
the nearest classes that hold ``CORE`` of the rows, the last of them with the weight that fills it up. Equal texts of a group
count once. So no group, however hot, meets in
a task, and sums of whole numbers do not depend on their order. Two starts
(median with absolute deviations, plain mean with covariance) are carried along
and the smaller determinant wins. The scatter of a group is drawn towards the
one of all rows by ``PRIOR_ROWS`` rows, so small groups need no other rule, and
``FLOOR`` keeps counts that are nearly always zero from making it singular.

Nulls: a null text has no words and fails; null languages and sources are groups of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.text import plain, slices, text_mark, words_of
from granary.sources.workspace import settle

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
SYMBOLS = "[#*$%&|<>]"
CORE = 0.5  # share of a group's rows that the robust estimate rests on: of n rows (n + P + 1) / 2
STEPS = 5
PRIOR_ROWS = 50
REJECT = 1e-9  # chance of a row of the core's normal distribution to be rejected
FLOOR = (0.25, 0.06, 0.10, 0.25, 0.15)  # least deviation of each transformed count
CLASSES_PER_OCTAVE = 8
UNIT = 1 << 16  # transformed counts are summed as whole multiples of 1 / UNIT
P = len(FLOOR)
PRODUCTS = [(i, j) for i in range(P) for j in range(i, P)]

KEYS = ("doc_id", "mark", "lang", "source")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text."""
    texts = plain(texts)
    words = words_of(texts)
    n_words = np.diff(words.starts)
    chars = pc.utf8_length(words.names).to_numpy(zero_copy_only=False).astype(np.int64)
    symbols = pc.count_substring_regex(words.names, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)
    return {
        "n_words": n_words,
        "word_chars": words.per_text(chars[words.codes]),
        "n_symbols": words.per_text(symbols[words.codes]),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": words.per_text(repeated_windows(words.codes, words.owners())),
    }


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    full = pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0
    coded = lines.dictionary_encode()
    codes, owner = coded.indices.to_numpy(zero_copy_only=False)[full], owner[full]
    distinct = np.unique(owner.astype(np.int64) * max(1, len(coded.dictionary)) + codes) // max(1, len(coded.dictionary))
    n = len(texts)
    return np.bincount(owner, minlength=n) - np.bincount(distinct, minlength=n)


def repeated_windows(codes: np.ndarray, owner: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each word whether a window over it is found twice or more in its text."""
    covered = np.zeros(len(codes), dtype=np.int64)
    starts = np.flatnonzero(owner[: len(codes) - width + 1] == owner[width - 1 :]) if len(codes) >= width else np.empty(0, int)
    if not len(starts):
        return covered
    mixed = owner[starts].astype(np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[starts + i].astype(np.uint64) + np.uint64(1)
    mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return covered
    likely = np.zeros(len(starts), dtype=bool)
    likely[order[1:][same]] = likely[order[:-1][same]] = True
    starts = starts[likely]  # the hash only proposes; the words decide
    rows = np.column_stack([owner[starts], *(codes[starts + i] for i in range(width))])
    _, group, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    twice = starts[times[group.ravel()] > 1]
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + width, -1)
    return (np.cumsum(edge[:-1]) > 0).astype(np.int64)


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, lang, source, counts, base_failed) for every row; ``mark`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = counts_of(part.column("text"))
            keys = [part.column(c) for c in KEYS]
            yield pa.record_batch(keys + [pa.array(made[c].astype(np.int64)) for c in COUNTS], names=[*KEYS, *COUNTS])

    wanted = docs.select(F.col("doc_id").cast("long"), text_mark("text").alias("mark"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    counted = wanted.mapInArrow(run, "doc_id long, mark long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return counted.withColumn("base_failed", failed)


def transformed() -> list:
    """Counts on scales on which ordinary texts spread about evenly, as whole multiples of 1 / UNIT."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    columns = (
        F.log(n),
        F.log((F.col("word_chars") + 1) / n),
        F.sqrt(F.col("n_symbols") / n),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.sqrt(F.col("n_repeat_words") / n),
    )
    return [F.round(c * UNIT).cast("long").alias(f"x{i}") for i, c in enumerate(columns)]


def chi2_share(x: float, dof: int) -> float:
    """Distribution function of chi-square: the series of the lower incomplete gamma function."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 0.0
    if x > 700:
        return 1.0
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_point(share: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, dof) < share else (low, mid)
    return high


def _estimates(moments: DataFrame, widen: float) -> DataFrame:
    """Centre and inverse scatter of each (cell, start) from its sums; ``widen`` makes the core's scatter that of all rows."""
    names = [f"m{i}" for i in range(P)] + [f"v{i}{j}" for i, j in PRODUCTS] + ["logdet"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = {c: [] for c in names}
            for r in rows:
                n, scatter, mean = float(r["n"]), np.zeros((P, P)), np.array([r[f"s{i}"] for i in range(P)], float) / r["n"] / UNIT
                for i, j in PRODUCTS:
                    scatter[i, j] = scatter[j, i] = r[f"q{i}{j}"] / r["n"] / UNIT - mean[i] * mean[j]
                scatter *= widen
                if r["all_n"]:
                    base = np.zeros((P, P))
                    whole = np.array([r[f"all_s{i}"] for i in range(P)], float) / r["all_n"] / UNIT
                    for i, j in PRODUCTS:
                        base[i, j] = base[j, i] = r[f"all_q{i}{j}"] / r["all_n"] / UNIT - whole[i] * whole[j]
                    weight = n / (n + PRIOR_ROWS)
                    scatter = weight * scatter + (1 - weight) * widen * base
                    mean = weight * mean + (1 - weight) * whole
                scatter += np.diag(np.square(FLOOR))
                inverse = np.linalg.inv(scatter)
                for c, v in zip(names, [*mean, *(inverse[i, j] for i, j in PRODUCTS), np.linalg.slogdet(scatter)[1]]):
                    out[c].append(float(v))
            yield pa.record_batch([batch.column("cell"), batch.column("start")] + [pa.array(out[c], pa.float64()) for c in names], names=["cell", "start", *names])

    return moments.mapInArrow(run, "cell string, start int, " + ", ".join(f"{c} double" for c in names))


def _distance() -> F.Column:
    d = [F.col(f"x{i}") / F.lit(float(UNIT)) - F.col(f"m{i}") for i in range(P)]
    terms = [d[i] * d[j] * F.col(f"v{i}{j}") * (1.0 if i == j else 2.0) for i, j in PRODUCTS]
    return sum(terms[1:], terms[0])


def _sums() -> list:
    first = [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)]
    second = [F.sum(F.round(F.col(f"x{i}") * (F.col(f"x{j}") / UNIT)).cast("long")).alias(f"q{i}{j}") for i, j in PRODUCTS]
    return [F.count(F.lit(1)).alias("n"), *first, *second]


SUMS = ["n"] + [f"s{i}" for i in range(P)] + [f"q{i}{j}" for i, j in PRODUCTS]


def _with_prior(moments: DataFrame) -> DataFrame:
    """Each cell's sums beside those of all rows, taken from its own start's core."""
    whole = moments.groupBy("start").agg(*(F.sum(c).alias(f"all_{c}") for c in SUMS))
    return moments.join(whole, "start")


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Sums of each cell's core: its nearest classes of distance that hold CORE of its rows."""
    near = rows.join(estimates, "cell").withColumn(
        "class", F.floor(F.log2(F.greatest(_distance(), F.lit(1e-6))) * CLASSES_PER_OCTAVE).cast("int")
    )
    binned = near.groupBy("cell", "start", "class").agg(*_sums())
    nearer = "sum(n) over (partition by cell, start order by class rows between unbounded preceding and 1 preceding)"
    ranked = binned.withColumn("nearer", F.coalesce(F.expr(nearer), F.lit(0))).withColumn("group_n", F.expr("sum(n) over (partition by cell, start)"))
    wanted = F.least(F.col("group_n"), F.floor((F.col("group_n") + P + 1) * CORE)) - F.col("nearer")
    share = F.least(F.lit(1.0), F.col("wanted") / F.col("n"))
    weighted = [F.sum(F.round(F.col(c) * F.col("share")).cast("long")).alias(c) for c in SUMS]
    return ranked.withColumn("wanted", wanted).filter("wanted > 0").withColumn("share", share).groupBy("cell", "start").agg(*weighted)


def _starts(rows: DataFrame) -> DataFrame:
    """Two first estimates of each cell: plain moments, and medians with absolute deviations."""
    plain_sums = rows.groupBy("cell").agg(*_sums()).withColumn("start", F.lit(0))
    # Settled, so that its size shows: rows then stay where they are and a hot cell is summed up map-side.
    middle = settle(rows.groupBy("cell").agg(*(F.percentile_approx(f"x{i}", 0.5).alias(f"c{i}") for i in range(P))), "medians")
    spread = (
        rows.join(middle, "cell").groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), *(F.first(f"c{i}").alias(f"c{i}") for i in range(P)),
             *(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"c{i}")), 0.5).alias(f"d{i}") for i in range(P)))
    )
    robust = spread.select(
        "cell", "n",
        *((F.col(f"c{i}") * F.col("n")).alias(f"s{i}") for i in range(P)),
        *(
            F.round(F.col("n") * (F.col(f"c{i}") * (F.col(f"c{j}") / UNIT) + (F.pow(1.4826 * F.col(f"d{i}"), F.lit(2)) / UNIT if i == j else 0.0)))
            .cast("long").alias(f"q{i}{j}")
            for i, j in PRODUCTS
        ),
        F.lit(1).alias("start"),
    )
    return plain_sums.unionByName(robust)


def fit(counted: DataFrame, steps: int = STEPS) -> DataFrame:
    """(cell, centre, inverse scatter): the MCD estimate of each language and source."""
    fitted = _rows(counted.filter(~F.col("base_failed"))).dropDuplicates(["cell", "mark"])
    rows = settle(fitted.select("cell", *(f"x{i}" for i in range(P))), "vectors")
    estimates = settle(_estimates(_with_prior(_starts(rows)), 1.0), "estimates")
    for _ in range(steps):
        moments = settle(_concentrate(rows, estimates), "core")
        estimates = settle(_estimates(_with_prior(moments), core_widening()), "estimates")
    best = F.row_number().over(Window.partitionBy("cell").orderBy("logdet", "start"))
    return estimates.withColumn("rank", best).filter("rank = 1").drop("rank", "start")


def core_widening() -> float:
    """Scatter of a normal distribution over that of its nearest CORE share."""
    return CORE / chi2_share(chi2_point(CORE, P), P + 2)


def _rows(counted: DataFrame) -> DataFrame:
    """Counts with the cell they are judged in and their transformed values."""
    return counted.withColumn("cell", F.to_json(F.struct("lang", "source"))).select("*", *transformed())


def judge(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """(doc_id, counts, base_failed, kept, distance, mark) for every row of documents.

    ``distance`` is null where a base rule failed or where no row of the cell could be fitted; such rows are judged by the base rules alone.
    """
    counted = settle(text_counts(docs), "counts")
    rows = _rows(counted)
    judged = rows.join(fit(counted).drop("logdet"), "cell", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_point(1 - reject, P), F.lit(True))
    return judged.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "distance", "mark")
