"""A category's index by frequency, kept as a table.

The same order as the library's own indexer (most frequent first, ties by name, from 0), but
labels are put in order by ranges and numbered by the rows of the ranges before, and rows
find their index by a join. Nothing is kept per label on the driver, in a model's metadata or in a task.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sources.workspace import settle


def placed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their place in the order, from 0 without a gap; ``rows`` must be a written table.

    Ranges are sorted apart; the window that adds up the rows before them has one row a range.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = settle(ranged.withColumn("__part", F.shiftright("__at", 33)), "ranged")
    parts = ranged.groupBy("__part").agg(F.min("__at").alias("__least"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", "__least", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return ranged.join(parts, "__part").withColumn(name, F.col("__at") - F.col("__least") + F.col("__before")).drop("__at", "__part", "__least", "__before")


def category_index(df: DataFrame, column: str) -> DataFrame:
    """The written table (label, n, index) of a column's values; nulls have none."""
    label = F.col(column).cast("string")
    counts = settle(df.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")), "labels")
    return settle(placed(counts, [F.desc("n"), F.asc("label")], "index"), "index")


def with_index(df: DataFrame, labels: DataFrame, column: str, output: str) -> DataFrame:
    """Rows with the index of their category as a double; unseen ones and nulls have the number of labels."""
    known = labels.select(F.col("label").alias("__label"), F.col("index").cast("double").alias("__index"))
    unseen = labels.agg(F.count(F.lit(1)).cast("double")).scalar()
    found = df.join(known, F.col(column).cast("string") == F.col("__label"), "left")
    return found.withColumn(output, F.coalesce("__index", unseen)).drop("__label", "__index")


class CategoryIndexer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that fits a ``CategoryIndexModel``."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CategoryIndexModel:
        model = CategoryIndexModel(category_index(dataset, self.getInputCol()))
        return model._set(inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class CategoryIndexModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """A fitted index; saved as its parameters and the table of labels beside them."""

    def __init__(self, labels: DataFrame | None = None):
        super().__init__()
        self.labels = labels

    def copy(self, extra=None) -> CategoryIndexModel:
        made = super().copy(extra)
        made.labels = self.labels
        return made

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_index(dataset, self.labels, self.getInputCol(), self.getOutputCol())

    def write(self) -> MLWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexReader()


class _IndexWriter(MLWriter):
    def __init__(self, model: CategoryIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.labels.write.parquet(f"{path}/labels")


class _IndexReader(MLReader):
    def load(self, path: str) -> CategoryIndexModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryIndexModel(self.sparkSession.read.parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
