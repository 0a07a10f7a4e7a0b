"""Feature pipelines and regressors on lineitem: the price from quantity, discount, tax and flag."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from granary.operators import accuracy as acc
from granary.operators import learning, sampling
from granary.plans.modelling import train_and_compare
from granary.sources.tables import load_model, save_model
from granary.sources.workspace import scratch_path
from granary.testbed.registry import query, sql_round, table

LABEL, CATEGORY = "l_extendedprice", "l_returnflag"
NUMERIC = ["l_quantity", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


def _rows(spark, folder):
    return table(spark, folder, "lineitem").select(*KEYS, *NUMERIC, CATEGORY, LABEL)


def _models(*names):
    """The regressors as they are, in full size."""
    return {n: m for n, m in learning.regressors(LABEL).items() if n in names}


def _judged(spark, folder, *names):
    train, test = sampling.split_train_test(_rows(spark, folder), KEYS)
    return train_and_compare(train, test, LABEL, NUMERIC, CATEGORY, KEYS, _models(*names))


def sql_uniform_of(*keys, salt):
    """The SQL of a draw on several keys."""
    text = " || ':' || ".join([*(f"cast({k} as varchar)" for k in keys), f"'{salt}'"])
    return f"(cast(cast('0x' || substr(md5({text}), 1, 13) as bigint) as double) / 4503599627370496.0::double)"


def _line_stages():
    return [
        *learning.feature_stages(["l_quantity"]),
        LinearRegression(featuresCol=learning.FEATURES, labelCol=LABEL, regParam=0.0, solver="normal"),
    ]


SQL_INDEX = (
    "(select {c} as name, row_number() over (order by count(*) desc, {c}) - 1 as i from {t} group by 1)"
)
SQL_SCALED = ", ".join(
    f"{sql_round(f'({c} - avg({c}) over ()) / stddev_samp({c}) over ()', 6)} + 0.0 as {c}_scaled"
    for c in ("l_quantity", "l_discount", "l_tax")
)


@query(
    "select c_custkey, cast(i as double) as segment_index from customer join "
    + SQL_INDEX.format(c="c_mktsegment", t="customer")
    + " on name = c_mktsegment"
)
def string_index(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    index = learning.feature_stages([], "c_mktsegment")[0]
    indexed = index.fit(customer).transform(customer)
    return indexed.select("c_custkey", F.col(learning.indexed_name("c_mktsegment")).alias("segment_index"))


@query(
    "select l_partkey, cast(count(*) as bigint) as n_rows, cast(max(i) as double) as part_index from lineitem join "
    + SQL_INDEX.format(c="cast(l_partkey as varchar)", t="lineitem")
    + " on name = cast(l_partkey as varchar) group by 1"
)
def category_index(spark, folder):
    """Parts indexed by frequency through a table of labels: a category with as many labels as there are keys."""
    items = table(spark, folder, "lineitem").select("l_partkey")
    index = learning.feature_stages([], "l_partkey", many_labels=True)[0]
    indexed = index.fit(items).transform(items)
    return indexed.groupBy("l_partkey").agg(F.count("*").alias("n_rows"), F.max(learning.indexed_name("l_partkey")).alias("part_index"))


@query(
    "with known as (select * from lineitem where l_shipdate < timestamp '1997-01-01'), labels as "
    + SQL_INDEX.format(c="cast(l_suppkey as varchar)", t="known")
    + " select l_orderkey, l_linenumber, l_partkey, cast(coalesce(i, (select count(*) from labels)) as double) as l_suppkey_indexed "
    "from lineitem left join labels on name = cast(l_suppkey as varchar)"
)
def category_index_unseen(spark, folder):
    """Suppliers indexed on the early line items, applied to all; an index saved and read back."""
    items = table(spark, folder, "lineitem")
    early = items.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    path = scratch_path(spark, "index-model")
    save_model(Pipeline(stages=learning.feature_stages([], "l_suppkey", many_labels=True)[:1]).fit(early), path)
    return load_model(path).transform(items).select("l_orderkey", "l_linenumber", "l_partkey", learning.indexed_name("l_suppkey"))


@query(
    "with rows as (select l_quantity as x, l_extendedprice as y, "
    f"cast(floor({sql_uniform_of('l_orderkey', 'l_linenumber', 'l_partkey', salt=learning.FOLD_SALT)} * 3) as int) as fold from lineitem), "
    "lines as (select f.fold, regr_slope(y, x) as s, regr_intercept(y, x) as i from rows, (select distinct fold from rows) f "
    "where rows.fold <> f.fold group by 1) "
    f"select fold, count(*) as n, {sql_round('sqrt(avg((s * x + i - y) * (s * x + i - y)))', 4)} as rmse, "
    f"{sql_round('avg(abs(s * x + i - y))', 4)} as mae, {sql_round('1 - avg((s * x + i - y) * (s * x + i - y)) / var_pop(y)', 6)} as r2 "
    "from rows join lines using (fold) group by 1"
)
def fold_metrics(spark, folder):
    """A line fitted on two thirds and judged on the other, three times, side by side."""
    *stages, line = _line_stages()
    found = learning.fold_metrics(_rows(spark, folder), LABEL, stages, line, KEYS)
    return found.withColumns({**{c: F.round(c, 4) for c in ("rmse", "mae")}, "r2": F.round("r2", 6)})


@query("select l_orderkey, l_linenumber, l_quantity as q, l_tax as t, l_extendedprice as p from lineitem")
def assemble_features(spark, folder):
    lineitem = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", LABEL)
    assembler = learning.feature_stages(["l_quantity", "l_tax", LABEL])[0]
    wide = assembler.transform(lineitem).select("l_orderkey", "l_linenumber", learning.FEATURES)
    return learning.unpack(wide, learning.FEATURES, ["q", "t", "p"])


def _scaled(df, names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


@query(f"select l_orderkey, l_linenumber, l_partkey, {SQL_SCALED} from lineitem")
def standard_scale(spark, folder):
    rows = _rows(spark, folder)
    wide = Pipeline(stages=learning.feature_stages(NUMERIC)).fit(rows).transform(rows)
    names = [f"{c}_scaled" for c in NUMERIC]
    out = learning.unpack(wide.select(*KEYS, learning.SCALED), learning.SCALED, names)
    return _scaled(out, names)


@query(
    "with x as (select *, cast(i as double) as flag from lineitem join "
    + SQL_INDEX.format(c="l_returnflag", t="lineitem")
    + f" on name = l_returnflag) select l_orderkey, l_linenumber, l_partkey, {SQL_SCALED}, "
    + sql_round("(flag - avg(flag) over ()) / stddev_samp(flag) over ()", 6)
    + " + 0.0 as flag_scaled from x"
)
def feature_preparation(spark, folder):
    """Index, assemble and standardise in one fitted pipeline."""
    rows = _rows(spark, folder)
    wide = Pipeline(stages=learning.feature_stages(NUMERIC, CATEGORY)).fit(rows).transform(rows)
    names = [*[f"{c}_scaled" for c in NUMERIC], "flag_scaled"]
    out = learning.unpack(wide.select(*KEYS, learning.SCALED), learning.SCALED, names)
    return _scaled(out, names)


@query(
    f"select {sql_round('regr_slope(l_extendedprice, l_quantity)', 4)} as slope, "
    f"{sql_round('regr_intercept(l_extendedprice, l_quantity)', 4)} as intercept from lineitem"
)
def linreg_ols_single(spark, folder):
    model = Pipeline(stages=_line_stages()).fit(_rows(spark, folder))
    line = model.stages[-1]
    ends = spark.createDataFrame([(float(line.coefficients[0]), float(line.intercept))], "slope double, intercept double")
    return ends.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


SQL_LINE = (
    "(select regr_slope(l_extendedprice, l_quantity) as s, regr_intercept(l_extendedprice, l_quantity) as i from lineitem)"
)


@query(
    f"select l_orderkey, l_linenumber, l_partkey, {sql_round('i + s * l_quantity', 4)} as predicted from lineitem, {SQL_LINE}"
)
def score_rows(spark, folder):
    rows = _rows(spark, folder)
    scored = learning.score(Pipeline(stages=_line_stages()).fit(rows), rows)
    return scored.select(*KEYS, F.round("prediction", 4).alias("predicted"))


@query(
    f"select l_orderkey, l_linenumber, l_partkey, {sql_round('i + s * l_quantity', 4)} as predicted, true as unchanged "
    f"from lineitem, {SQL_LINE}"
)
def model_save_load(spark, folder):
    """A saved pipeline scores every row as the one in memory does."""
    rows = _rows(spark, folder)
    model = Pipeline(stages=_line_stages()).fit(rows)
    path = scratch_path(spark, "model")
    save_model(model, path)
    both = learning.score(load_model(path), learning.score(model, rows, "before"), "after")
    same = (F.col("before") == F.col("after")).alias("unchanged")
    return both.select(*KEYS, F.round("after", 4).alias("predicted"), same)


PENALTY, MIX = 50.0, 0.4
SQL_SHRUNK = (
    "(select (sign(c) * greatest(abs(c) - l * a, 0)) / (1 + l * (1 - a)) as w, mx, sx, my, sy from (select "
    "covar_samp(l_quantity, l_extendedprice) / stddev_samp(l_quantity) / stddev_samp(l_extendedprice) as c, "
    f"{PENALTY} / stddev_samp(l_extendedprice) as l, {MIX} as a, avg(l_quantity) as mx, stddev_samp(l_quantity) as sx, "
    "avg(l_extendedprice) as my, stddev_samp(l_extendedprice) as sy from lineitem))"
)


@query(f"select {sql_round('w * sy / sx', 2)} as slope, {sql_round('my', 1)} as at_the_mean from {SQL_SHRUNK}")
def elastic_net_single(spark, folder):
    """One feature: the elastic net is soft thresholding of the correlation, then shrinking."""
    rows = _rows(spark, folder)
    net = learning.elastic_net(LABEL, penalty=PENALTY, mix=MIX, tol=1e-12)
    fitted = learning.fit_models(rows.select("l_quantity", LABEL), LABEL, learning.feature_stages(["l_quantity"]), {"net": net})
    means = rows.agg(F.avg("l_quantity").alias("l_quantity")).withColumn("more", F.lit(0.0))
    ends = means.union(means.select(F.col("l_quantity") + 1, F.lit(1.0)))
    at = learning.score(fitted.pipeline("net"), ends)
    first = F.max(F.when(F.col("more") == 0, F.col("prediction")))
    return at.agg(F.round(F.max(F.when(F.col("more") == 1, F.col("prediction"))) - first, 2).alias("slope"), F.round(first, 1).alias("at_the_mean"))


# The best cut of a column of few values: the one that leaves the least squared error on its two sides.
SQL_STUMP = (
    "(with v as (select l_discount as x, count(*) as n, sum(l_extendedprice) as s from lineitem group by 1), "
    "c as (select x, sum(n) over (order by x) as ln, sum(s) over (order by x) as ls, sum(n) over () as n, sum(s) over () as s from v) "
    "select x as cut, ls / ln as low, (s - ls) / (n - ln) as high from c where n > ln "
    "order by ls * ls / ln + (s - ls) * (s - ls) / (n - ln) desc, x limit 1)"
)
SQL_STUMP_ROWS = (
    f"select l_orderkey, l_linenumber, l_partkey, {sql_round('case when l_discount <= cut then low else high end', 2)} "
    f"as predicted from lineitem, {SQL_STUMP}"
)


def _stump(spark, folder, model):
    rows = _rows(spark, folder)
    fitted = learning.fit_models(rows.select("l_discount", LABEL), LABEL, learning.feature_stages(["l_discount"]), {"stump": model})
    return fitted.pipeline("stump"), rows.select(*KEYS, "l_discount")


@query(SQL_STUMP_ROWS)
def forest_stump(spark, folder):
    """One tree of depth one over all rows: the cut with the least squared error."""
    model, rows = _stump(spark, folder, learning.random_forest(LABEL, 1, 1, bootstrap=False, featureSubsetStrategy="all"))
    return learning.score(model, rows).select(*KEYS, F.round("prediction", 2).alias("predicted"))


@query(SQL_STUMP_ROWS)
def boosted_stump(spark, folder):
    """One round of depth one is the same cut."""
    model, rows = _stump(spark, folder, learning.boosted_trees(LABEL, 1, 1))
    return learning.score(model, rows).select(*KEYS, F.round("prediction", 2).alias("predicted"))


@query("select cast(1 as int) as rank, 'l_discount' as feature, 1.0::double as importance from lineitem limit 1")
def stump_importance(spark, folder):
    model, rows = _stump(spark, folder, learning.random_forest(LABEL, 1, 1, bootstrap=False, featureSubsetStrategy="all"))
    return learning.feature_importance(model, ["l_discount"], rows)


SQL_TRAINED = (
    "with rows as (select l_quantity as x, l_extendedprice as y, "
    f"{sql_uniform_of('l_orderkey', 'l_linenumber', 'l_partkey', salt='split-42')} < 0.8::double as train from lineitem), "
    "fit as (select regr_slope(y, x) as s, regr_intercept(y, x) as i, avg(y) as m from rows where train), "
    "told as (select 'line' as model, y, s * x + i as p from rows, fit where not train union all select 'mean', y, m from rows, fit where not train)"
)


@query(
    f"{SQL_TRAINED} select model, count(*) as n, {sql_round('sqrt(avg((p - y) * (p - y)))', 4)} as rmse, {sql_round('avg(abs(p - y))', 4)} as mae, "
    f"{sql_round('1 - avg((p - y) * (p - y)) / var_pop(y)', 6)} as r2, {sql_round('avg(abs(p - y) / nullif(y, 0) * 100)', 4)} as mean_error_pct, "
    "row_number() over (order by avg((p - y) * (p - y)) / var_pop(y), model) = 1 as is_best from told group by 1"
)
def trained_lines(spark, folder):
    """The whole training stage with two models that SQL can fit as well: a line, and one penalised down to the mean."""
    train, test = sampling.split_train_test(_rows(spark, folder), KEYS)
    models = {
        "line": LinearRegression(featuresCol=learning.SCALED, labelCol=LABEL, regParam=0.0, solver="normal"),
        "mean": learning.elastic_net(LABEL, penalty=1e9, mix=1.0),
    }
    judged = train_and_compare(train, test, LABEL, ["l_quantity"], None, KEYS, models)
    told = judged.metrics.withColumn("is_best", F.col("model") == judged.best)
    return told.withColumns({**{c: F.round(c, 4) for c in ("rmse", "mae", "mean_error_pct")}, "r2": F.round("r2", 6)})


@query()
def rf_metrics(spark, folder):
    return _judged(spark, folder, "RandomForest").metrics


@query()
def gbt_metrics(spark, folder):
    return _judged(spark, folder, "GBT").metrics


@query()
def linreg_elastic(spark, folder):
    return _judged(spark, folder, "LinearRegression").metrics


@query()
def trained_models(spark, folder):
    """All three regressors compared on one test set, the best marked."""
    judged = _judged(spark, folder, "RandomForest", "GBT", "LinearRegression")
    return judged.metrics.withColumn("is_best", F.col("model") == judged.best)


@query()
def feature_importance(spark, folder):
    rows = _rows(spark, folder).drop(*KEYS)
    stages = learning.feature_stages(NUMERIC, CATEGORY)
    model = learning.fit_models(rows, LABEL, stages, _models("RandomForest")).pipeline("RandomForest")
    return learning.feature_importance(model, [*NUMERIC, learning.indexed_name(CATEGORY)], rows)


@query("select * from (values ('rmse', true), ('mae', true), ('r2', true)) as t(metric, agrees)")
def metric_cross_check(spark, folder):
    """Whether the one-pass metrics agree with MLlib's evaluator on a trained model's predictions."""
    judged = _judged(spark, folder, "LinearRegression")
    checks = [
        (m, learning.evaluate(judged.predictions, acc.ACTUAL, acc.PREDICTED, m)) for m in ("rmse", "mae", "r2")
    ]
    ours = judged.metrics.select(F.expr("stack(3, 'rmse', rmse, 'mae', mae, 'r2', r2) as (metric, one_pass)"))
    both = ours.join(spark.createDataFrame(checks, "metric string, evaluator double"), "metric")
    return both.select(
        "metric", (F.abs(F.col("one_pass") - F.col("evaluator")) <= F.abs("evaluator") * 1e-9).alias("agrees")
    )
