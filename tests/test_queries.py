"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest
from compare import difference
from conftest import plan_of

from granary.testbed import load_all

ALL = load_all()
# Python runs only where bytes of single files are copied or peeked at; those results are settled tables.
NO_PLAN = {"landing_manifest"}


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql is not None])
def test_same_as_sql(name, spark, folder, duck):
    assert difference(ALL[name].run(spark, folder), duck, ALL[name].sql) is None


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql is None])
def test_rows_without_sql(name, spark, folder):
    df = ALL[name].run(spark, folder)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize("name", ["gold_features", "silver_measurements", "error_by_range", "histogram_density",
                                  "synthetic_target", "report_table", "dedupe_exact", "impute_group_mean",
                                  "model_comparison", "yearly_features", "union_real_synthetic"])
def test_plan_stays_in_the_jvm_and_joins_on_keys(name, spark, folder):
    plan = plan_of(ALL[name].run(spark, folder))
    for unwanted in ("Python", "Cartesian", "NestedLoop", "CollectLimit"):
        assert unwanted not in plan, unwanted


def test_entry_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 90
