"""Exact quantiles of every group, in passes whose number does not depend on the number of groups.

A quantile sketch for each group is a column that merges map-side and can be kept and rolled up
(``quantile_sketches``, ``merged_sketches``). It only proposes where a group's quantiles lie: two values
close around each. One more pass counts what is below, at and between them, which proves them right, and the few rows
between are written out and looked at again, until a group has few rows left to sort. A proposal that proves wrong
costs another look, never a wrong value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.sources.workspace import settle

SKETCH = 800  # size parameter: ranks are right to about 0.4 % of the rows
MARGIN = 0.01  # share of the rows left on both sides of a wanted rank
STEPS = 200  # ranks at which a sketch is asked
FEW_ROWS = 10_000  # values of a group that are sorted in memory
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _values(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.select(*by, x.alias("__x")).where(x.isNotNull() & ~F.isnan(x))


def quantile_sketches(df: DataFrame, by: Sequence[str], column: str, size: int = SKETCH) -> DataFrame:
    """(by..., n, sketch): values of each group and a sketch of them; nulls and NaN are left out."""
    return _values(df, by, column).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__x", F.lit(size)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """Sketches with a column for each share: a value whose rank is near the wanted one."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))) for name, share in shares.items()})


def _ranks(n: Column, share: float) -> tuple[Column, Column]:
    """The two neighbouring ranks between which a quantile lies."""
    first = F.floor((n - 1) * F.lit(float(share)))
    return first, F.least(first + 1, n - 1)


def _pivots(n: Column, first: Column, second: Column) -> tuple[Column, Column]:
    """Values around two ranks, by the sketch."""
    steps = F.kll_sketch_get_quantile_double("__sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    spare = n * F.lit(MARGIN) + 1
    low = F.greatest(F.lit(0), F.floor((first - spare) / n * STEPS))
    high = F.least(F.lit(STEPS), F.ceil((second + 1 + spare) / n * STEPS))
    return F.get(steps, low.cast("int")), F.get(steps, high.cast("int"))


def _counts(low: Column, high: Column) -> dict[str, Column]:
    x = F.col("__x")
    return {
        "below": F.count_if(x < low),
        "at_low": F.count_if(x == low),
        "inside": F.count_if((x > low) & (x < high)),
        "at_high": F.count_if((x == high) & (high > low)),
    }


def _told(tasks: DataFrame) -> DataFrame:
    """Tasks with the values that the counts prove, and the ranks and rows that are left.

    If a wanted rank lies outside what was proposed, all rows are looked at again (``low`` and ``high`` are null).
    """
    up_to_low, up_to_inside = F.col("below") + F.col("at_low"), F.col("below") + F.col("at_low") + F.col("inside")
    up_to_high = up_to_inside + F.col("at_high")

    def value(rank: str) -> Column:
        r = F.col(rank)
        return F.when((r >= F.col("below")) & (r < up_to_low), F.col("low")).when((r >= up_to_inside) & (r < up_to_high), F.col("high"))

    open_ranks = [(F.col(v).isNull(), F.col(r)) for v, r in (("v0", "r0"), ("v1", "r1"))]
    right = F.lit(True)
    for still, r in open_ranks:
        right = right & (~still | ((r >= F.col("below")) & (r < up_to_high)))
    told = tasks.withColumns({"__right": right, "v0": F.coalesce("v0", value("r0")), "v1": F.coalesce("v1", value("r1"))})
    ok = F.col("__right")
    return told.select(
        "cell", "share", "v0", "v1",
        *[F.when(ok, F.col(r) - up_to_low).otherwise(F.col(r)).alias(r) for r in ("r0", "r1")],
        F.when(ok, F.col("inside")).otherwise(F.col("rows")).alias("rows"),
        F.when(ok, F.col("low")).alias("low"), F.when(ok, F.col("high")).alias("high"),
    )


OPEN = "v0 is null or v1 is null"


def _between(low: Column, high: Column) -> Column:
    return low.isNull() | ((F.col("__x") > low) & (F.col("__x") < high))


def _finish(tasks: DataFrame, rows: DataFrame, few_rows: int) -> DataFrame:
    """(cell, share, v0, v1) of all tasks, given the rows (cell, share, __x) of the open ones."""
    done = [tasks.where(f"not ({OPEN})").select("cell", "share", "v0", "v1")]
    open_tasks = tasks.where(OPEN)
    while True:
        few = open_tasks.where(F.col("rows") <= few_rows)
        sorted_rows = rows.join(few.select("cell", "share"), ["cell", "share"], "left_semi").groupBy("cell", "share").agg(F.sort_array(F.collect_list("__x")).alias("few"))
        found = few.join(sorted_rows, ["cell", "share"])
        done.append(found.select("cell", "share", *[F.coalesce(v, F.get("few", F.col(r).cast("int"))).alias(v) for v, r in (("v0", "r0"), ("v1", "r1"))]))
        many = settle(open_tasks.where(F.col("rows") > few_rows), "tasks")
        if many.isEmpty():
            break
        mine = rows.join(many.select("cell", "share"), ["cell", "share"], "left_semi")
        sketches = mine.groupBy("cell", "share").agg(F.kll_sketch_agg_double("__x", F.lit(SKETCH)).alias("__sketch"))
        low, high = _pivots(F.col("rows"), F.col("r0"), F.col("r1"))
        pivots = settle(many.drop("low", "high").join(sketches, ["cell", "share"]).withColumns({"low": low, "high": high}).drop("__sketch"), "pivots")
        counted = mine.join(pivots.select("cell", "share", "low", "high"), ["cell", "share"]).groupBy("cell", "share")
        counted = counted.agg(*[c.alias(name) for name, c in _counts(F.col("low"), F.col("high")).items()])
        told = settle(_told(pivots.join(counted, ["cell", "share"])), "tasks")
        done.append(told.where(f"not ({OPEN})").select("cell", "share", "v0", "v1"))
        open_tasks = told.where(OPEN)
        inner = mine.join(open_tasks.select("cell", "share", "low", "high"), ["cell", "share"])
        rows = settle(inner.where(_between(F.col("low"), F.col("high"))).select("cell", "share", "__x"), "inner")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _line(v0: Column, v1: Column, n: Column, share: float) -> Column:
    """Between two neighbours, as far as the share asks."""
    position = (n - 1) * F.lit(float(share))
    return F.when((v0 == v1) | (position == F.floor(position)), v0).otherwise(v0 + (v1 - v0) * (position - F.floor(position)))


def grouped_quantiles(
    df: DataFrame, by: Sequence[str], column: str, shares: Mapping[str, float] = QUARTILES, few_rows: int = FEW_ROWS
) -> DataFrame:
    """(by..., n, one column for each share): exact quantiles with linear interpolation between neighbours.

    Nulls and NaN are left out; a null group is a group, one without values is absent; halfway to an infinite neighbour is NaN. Hand in a settled table: it is read once for the
    sketches, once for the groups with few rows, and twice for those with many, whatever their number.
    """
    names, by = list(shares), list(by)
    values = _values(df, by, column)
    groups = values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__x", F.lit(SKETCH)).alias("__sketch"))
    groups = settle(groups.withColumn("cell", F.monotonically_increasing_id()), "groups")
    sizes = groups.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    parts = []
    if sizes.most is None or sizes.least <= few_rows:
        few = _with_group(values, groups.where(F.col("n") <= few_rows).select(*by, "cell", "n"), by)
        few = few.groupBy("cell", "n").agg(F.sort_array(F.collect_list("__x")).alias("few"))
        pick = lambda r: F.get("few", r.cast("int"))
        parts.append(few.select("cell", *[_line(*map(pick, _ranks(F.col("n"), s)), F.col("n"), s).alias(name) for name, s in shares.items()]))
    if sizes.most is not None and sizes.most > few_rows:
        n = F.col("n")
        around = {}
        for i, share in enumerate(shares.values()):
            first, second = _ranks(n, share)
            around[f"low_{i}"], around[f"high_{i}"] = _pivots(n, first, second)
        pivots = settle(groups.where(n > few_rows).withColumns(around).drop("__sketch"), "pivots")
        joined = _with_group(values, pivots, by)
        counts = [c.alias(f"{name}_{i}") for i in range(len(names)) for name, c in _counts(F.col(f"low_{i}"), F.col(f"high_{i}")).items()]
        counted = pivots.join(joined.groupBy("cell").agg(*counts), "cell")
        tasks = []
        for i, share in enumerate(shares.values()):
            first, second = _ranks(n, share)
            own = [F.col(f"{c}_{i}").alias(c) for c in ("low", "high", "below", "at_low", "inside", "at_high")]
            nothing = F.lit(None).cast("double")
            tasks.append(F.struct(F.lit(i).alias("share"), first.alias("r0"), second.alias("r1"), n.alias("rows"), nothing.alias("v0"), nothing.alias("v1"), *own))
        tasks = settle(_told(counted.select("cell", F.inline(F.array(*tasks)))), "tasks")
        edges = tasks.where(OPEN).groupBy("cell").agg(F.collect_list(F.struct("share", "low", "high")).alias("edges"))
        inner = joined.select("cell", "__x").join(edges, "cell").select("cell", "__x", F.inline("edges"))
        rows = settle(inner.where(_between(F.col("low"), F.col("high"))).select("cell", "share", "__x"), "inner")
        found = _finish(tasks, rows, few_rows).join(groups.select("cell", "n"), "cell")
        value = F.lit(None).cast("double")
        for i, share in enumerate(shares.values()):
            value = F.when(F.col("share") == i, _line(F.col("v0"), F.col("v1"), n, share)).otherwise(value)
        parts.append(found.groupBy("cell").agg(*[F.max(F.when(F.col("share") == i, value)).alias(name) for i, name in enumerate(names)]))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return groups.select(*by, "n", "cell").join(out, "cell").drop("cell")


def _with_group(values: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Values with the columns of their group; null keys meet each other."""
    if not by:
        return values.crossJoin(F.broadcast(groups))  # the one row of a table without groups
    renamed = groups.withColumnsRenamed({c: f"__{i}" for i, c in enumerate(by)})
    on = [values[c].eqNullSafe(renamed[f"__{i}"]) for i, c in enumerate(by)]
    return values.join(renamed, on).drop(*by, *[f"__{i}" for i in range(len(by))])
