"""Tree models fitted on cells: rows that fall into the same bin of every feature.

MLlib's trees see a continuous feature through at most ``maxBins`` bins, and of the labels in a node they use the count, the
sum and the sum of squares. Rows of one cell can therefore be told apart by no split, and two weighted rows with the cell's mean label, one
standard deviation below and above it, stand for all of them: every split, leaf, gain and error is that of the rows. The rows are read
in a few passes to bin and to sum them; the dozens or hundreds of passes of a fit go over the cells, of which there are no
more however many rows come.

* Bins are those of MLlib, from the counts of all values where a column has up to ``COUNTED`` of them, else from a sketch of all rows.
* Boosted trees and forests without bootstrap are one fit on the cells. In a forest with bootstrap each row is drawn a Poisson number of
  times for each tree, as in MLlib; the draws are summed by cell and tree, and every tree is fitted on its own sums.
* Where rows do not gather in cells (fewer than ``FEW`` rows a cell: wide or small tables), the estimator is fitted on the rows.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from granary.sources.workspace import settle

FEW = 32
COUNTED = 10_000
SKETCH_ERROR = 1e-4
ALL_BINS = 1500  # MLlib looks for bins in a sample of maxBins ** 2 rows; those it finds here are the bins themselves
ROWS_A_TASK = 100_000  # cells in a task of a fit
DRAWN_A_TASK = 1_000_000  # rows in a task that draws for all trees
SPREAD = 8  # tasks that share the rows of one cell
WEIGHT = "__weight"


def cut_points(values: Sequence[tuple[float, int]], bins: int) -> list[float]:
    """Between which of the sorted (value, count) a column is cut into ``bins`` bins of like counts, by MLlib's rule."""
    middle = [(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])]
    if len(middle) < bins:
        return middle
    stride = sum(n for _, n in values) / bins
    cuts, seen, target = [], values[0][1], stride
    for cut, (_, n) in zip(middle, values[1:]):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            cuts.append(cut)
            target += stride
    return cuts


@dataclass(frozen=True)
class Cells:
    """Training rows with their bins, and the same rows summed by cell."""

    stages: list[Transformer]  # from the columns behind the features to the vector of bins
    bins: list[str]
    kept: list[str]
    label: str
    centre: float
    rows: DataFrame  # bins, kept, label less centre
    n_rows: int
    table: DataFrame  # bins, kept, n, mean, deviation
    n_cells: int

    @property
    def features(self) -> str:
        return self.stages[-1].getOutputCol()


def _cuts(rows: DataFrame, inputs: Sequence[str], distinct: Sequence[int], bins: int) -> list[list[float]]:
    few = [i for i, n in enumerate(distinct) if n <= COUNTED]
    counts: dict[int, list[tuple[float, int]]] = {i: [] for i in few}
    if few:
        values = rows.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(inputs[i]).cast("double").alias("v")) for i in few])).alias("x"))
        for r in values.groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n")).collect():  # some COUNTED rows a column
            counts[r["i"]].append((r["v"], r["n"]))
    many = [i for i in range(len(inputs)) if i not in counts]
    at = [j / bins for j in range(1, bins)]
    doubles = rows.select(*[F.col(inputs[i]).cast("double").alias(f"c{i}") for i in many])
    sketched = dict(zip(many, doubles.approxQuantile([f"c{i}" for i in many], at, SKETCH_ERROR))) if many else {}
    return [cut_points(sorted(counts[i]), bins) if i in counts else sorted(set(sketched[i])) for i in range(len(inputs))]


def cells_of(rows: DataFrame, inputs: Sequence[str], label: str, kept: Sequence[str], bins: int) -> Cells | None:
    """The cells of rows without null features; None where they are not far fewer than the rows, or where a label is missing."""
    if not all(isinstance(rows.schema[c].dataType, NumericType) for c in [*inputs, label]):
        return None
    y = F.col(label).cast("double")
    first = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == math.inf)).alias("broken"),
        F.avg(y).alias("centre"),
        *[F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(inputs)],
    ).first()
    if first["n"] < FEW or first["broken"]:
        return None
    cuts = _cuts(rows, inputs, [first[f"d{i}"] for i in range(len(inputs))], bins)
    if not all(math.isfinite(t) for of in cuts for t in of):
        return None
    # A value on a cut is left of it. A column of one value has no cut, but a Bucketizer must have one.
    splits = [[-math.inf, *np.nextafter(of or [0.0], math.inf).tolist(), math.inf] for of in cuts]
    names = [f"__bin_{bins}_{i}" for i in range(len(inputs))]
    stages = [
        Bucketizer(splitsArray=splits, inputCols=list(inputs), outputCols=names),
        VectorAssembler(inputCols=names, outputCol=f"binned_features_{bins}"),
    ]
    # The cast also takes off the mark of a nominal column.
    flags = [F.col(c).cast("short").alias(c) for c in names]
    binned = stages[0].transform(rows).select(*flags, *kept, (y - first["centre"]).alias(label))
    sums = [F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), F.stddev_pop(label).alias("deviation")]
    table = settle(binned.groupBy(*names, *kept).agg(*sums), "cells")
    n_cells = table.count()
    if n_cells * FEW > first["n"]:
        return None
    return Cells(stages, names, list(kept), label, first["centre"], binned, first["n"], table, n_cells)


def takes_cells(model: Estimator, features: str) -> bool:
    """Whether an estimator's fit is the same on cells: squared error, whole rows, no weights of its own."""
    if not isinstance(model, (RandomForestRegressor, GBTRegressor)) or model.getFeaturesCol() != features or model.isSet("weightCol"):
        return False
    if isinstance(model, GBTRegressor):
        return model.getLossType() == "squared" and model.getSubsamplingRate() == 1.0
    return model.getBootstrap() or model.getSubsamplingRate() == 1.0


def _weighted(cells: Cells, table: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Two rows for each cell, together of the cell's weight, mean and variance."""
    ends = F.explode(F.when(F.col("deviation") > 0, F.array(-F.col("deviation"), F.col("deviation"))).otherwise(F.array(F.lit(0.0))))
    two = table.withColumn("__aside", ends).withColumn(WEIGHT, F.col("n") / F.when(F.col("deviation") > 0, 2.0).otherwise(1.0))
    label = (F.col("mean") + F.col("__aside") + cells.centre).alias(cells.label)
    return cells.stages[-1].transform(two).select(cells.features, *kept, label, WEIGHT)


def _on_cells(model: Estimator, cells: Cells, rows: int, **more) -> Estimator | None:
    """The estimator with its least rows of a node as a share of ``rows``; None if no node could be split."""
    least = model.getMinInstancesPerNode()
    if rows < 2 * least:
        return None
    share = max(model.getMinWeightFractionPerNode(), (least - 0.5) / rows)
    given = {"featuresCol": cells.features, "weightCol": WEIGHT, "minInstancesPerNode": 1, "minWeightFractionPerNode": share, "maxBins": ALL_BINS, **more}
    return model.copy({model.getParam(k): v for k, v in given.items()})


def _poisson(mean: float, unit: Column) -> Column:
    """A Poisson number from a uniform one, by the sums of its probabilities."""
    share = upto = math.exp(-mean)
    found, k = F.when(unit < upto, 0), 0
    while upto < 1 - 1e-15 and share > 1e-18:
        k += 1
        share *= mean / k
        upto += share
        found = found.when(unit < upto, k)
    return found.otherwise(k + 1)


def draws(cells: Cells, trees: int, rate: float, seed: int) -> DataFrame:
    """(tree, bins, n, mean, deviation): the rows drawn for each tree, summed by cell.

    Rows are dealt by cell into a written table, a cell's over up to ``SPREAD`` tasks, so a task sums few cells. Draws depend on that
    table's files alone.
    """
    parallel = cells.rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(parallel, math.ceil(cells.n_rows / DRAWN_A_TASK))
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))
    dealt = settle(cells.rows.select(*cells.bins, cells.label, deal.alias("__deal")).repartition(tasks, *cells.bins, "__deal").drop("__deal"), "dealt")
    y = F.col(cells.label)
    each = dealt.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))).withColumn("__unit", F.rand(seed))
    drawn = each.withColumn("k", _poisson(rate, F.col("__unit"))).where("k > 0")
    sums = drawn.groupBy("tree", *cells.bins).agg(F.sum("k").alias("n"), F.sum(F.col("k") * y).alias("s"), F.sum(F.col("k") * y * y).alias("q"))
    mean, spread = F.col("s") / F.col("n"), F.col("q") / F.col("n") - (F.col("s") / F.col("n")) ** 2
    told = sums.select("tree", *cells.bins, "n", mean.alias("mean"), F.sqrt(F.greatest(spread, F.lit(0.0))).alias("deviation"))
    return settle(told.repartitionByRange(min(trees, parallel), "tree").sortWithinPartitions("tree"), "draws")


def _fit_forest(model: RandomForestRegressor, cells: Cells) -> Model | None:
    spark = cells.table.sparkSession
    trees = model.getNumTrees()
    chosen = model.getFeatureSubsetStrategy()
    chosen = ("onethird" if trees > 1 else "all") if chosen == "auto" else chosen
    drawn = draws(cells, trees, model.getSubsamplingRate(), model.getSeed())
    weights = {r["tree"]: r["w"] for r in drawn.groupBy("tree").agg(F.sum("n").alias("w")).collect()}
    seeds = random.Random(model.getSeed())
    settings = {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": chosen}
    single = [_on_cells(model, cells, weights.get(t, 0), seed=seeds.getrandbits(62), **settings) for t in range(trees)]
    if not all(single):
        return None

    def fit(t: int) -> Model:
        own = _weighted(cells, drawn.where(F.col("tree") == t))
        return single[t].fit(own.coalesce(math.ceil(2 * cells.n_cells / ROWS_A_TASK)))

    with ThreadPool(min(trees, spark.sparkContext.defaultParallelism)) as pool:
        fitted = pool.map(inheritable_thread_target(spark)(fit), range(trees), chunksize=1)
    # The constructor takes the trees as the JVM has them.
    kind = spark.sparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    grown = JavaWrapper._new_java_array([one.trees[0]._java_obj for one in fitted], kind)
    forest = JavaWrapper._new_java_obj("org.apache.spark.ml.regression.RandomForestRegressionModel", model.uid, grown, len(cells.bins))
    own = model.copy({model.featuresCol: cells.features})
    made = own._copyValues(own._create_model(forest))
    made._transfer_params_to_java()
    return made


def fit_on_cells(model: Estimator, cells: Cells) -> Model | None:
    """The model fitted on cells; None if there are too few rows for any split."""
    if isinstance(model, RandomForestRegressor) and model.getBootstrap():
        return _fit_forest(model, cells)
    told = model.getValidationIndicatorCol() if isinstance(model, GBTRegressor) and model.isSet("validationIndicatorCol") else None
    table = cells.table.where(~F.col(told)) if told else cells.table
    on_cells = _on_cells(model, cells, table.agg(F.sum("n")).first()[0] or 0)
    rows = _weighted(cells, cells.table, cells.kept)
    return on_cells.fit(rows.coalesce(math.ceil(2 * cells.n_cells / ROWS_A_TASK))) if on_cells else None


def scoring(preparation: PipelineModel, used: Sequence[Cells]) -> PipelineModel:
    """The preparation with the bins that the models look at."""
    return PipelineModel(stages=[*preparation.stages, *[s for cells in used for s in cells.stages]])
