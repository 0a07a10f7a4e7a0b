from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from granary.functions import draws
from granary.operators import sampling, synth

RULES = (
    synth.RangeRule("area", 0.5, 1.5, floor=10.0, whole=True),
    synth.RangeRule("rain", 0.8, 1.2, ceiling=100.0),
)


def _drawn(spark, n=4000):
    real = spark.createDataFrame([("a", 15.0, 50.0), ("b", 40.0, 99.0), ("c", 20.0, 60.0)], "cat string, area double, rain double")
    return synth.draw_rows(spark, n, synth.derive_ranges(real, RULES), RULES, real, "cat", years=(1990, 1995))


def test_draws_stay_in_range_and_cover_it(spark):
    df = _drawn(spark)
    got = df.agg(F.min("area"), F.max("area"), F.min("rain"), F.max("rain"), F.min("year"), F.max("year"), F.count("*")).first()
    assert (got[0], got[1]) == (10, 59) and 40 <= got[2] < 41 and 99 < got[3] <= 100
    assert (got[4], got[5], got[6]) == (1990, 1994, 4000)
    counts = [r["count"] for r in df.groupBy("cat").count().collect()]
    assert len(counts) == 3 and min(counts) > 1200
    assert dict(df.dtypes)["area"] == "bigint"


def test_draws_do_not_depend_on_partitions_or_runs(spark):
    ids = spark.range(1000)
    one = ids.repartition(1).select("id", draws.uniform("id", "s").alias("u"))
    many = ids.repartition(13).select("id", draws.uniform("id", "s").alias("u"))
    assert one.exceptAll(many).isEmpty()
    assert _drawn(spark, 500).exceptAll(_drawn(spark, 500)).isEmpty()


def test_normal_and_halves_are_well_behaved(spark):
    u0, u1 = draws.uniform("id", "n", 0), draws.uniform("id", "n", 1)
    got = spark.range(40_000).select(u0.alias("a"), u1.alias("b"), draws.normal(u0, u1).alias("z")).toPandas()
    assert abs(got.a.mean() - 0.5) < 0.01 and abs(got.a.var() - 1 / 12) < 0.003
    assert abs(np.corrcoef(got.a, got.b)[0, 1]) < 0.02
    assert abs(got.z.mean()) < 0.02 and abs(got.z.std() - 1) < 0.02


def test_values_are_numbered_densely(spark):
    values = spark.range(5000).select((F.col("id") % 700).cast("string").alias("v"))
    numbered, k = synth.number_values(values, "v", "i")
    got = numbered.collect()
    assert k == 700
    assert sorted(r.i for r in got) == list(range(1, 701))
    assert len({r.v for r in got}) == 700


def test_target_is_cut_and_floored(spark):
    df = spark.createDataFrame([(10.9, 2003), (-900.0, 2000), (5000.7, 1999)], "b double, y int")
    out = synth.with_target(df, "t", F.col("b"), F.lit(2.0), "y").collect()
    assert [r.t for r in out] == [1521, 1000, 9501]


def test_split_is_stable_and_complete(spark):
    df = spark.range(10_000)
    train, test = sampling.split_train_test(df, ["id"])
    again, _ = sampling.split_train_test(df.repartition(7), ["id"])
    assert train.count() + test.count() == 10_000
    assert 7800 < train.count() < 8200
    assert train.exceptAll(again).isEmpty()
    sizes = {r.split: r.n for r in sampling.split_sizes(sampling.label_split(df, ["id"])).collect()}
    assert sizes == {"train": train.count(), "test": test.count()}
    first, second = sampling.split_random(df)
    assert first.count() + second.count() == 10_000
