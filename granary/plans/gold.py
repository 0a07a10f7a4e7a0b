"""Silver to gold: yearly features, integration with facts, the final feature table."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from granary.functions.aggregates import Measure
from granary.operators.joins import integrate_left
from granary.operators.shaping import add_literals, present, project_required, rename, standardize_keys


Choice = tuple[Sequence[str], str | Callable[[], Column]]


def choose_measures(df: DataFrame, wanted: Sequence[tuple[str, Sequence[Choice]]], **how) -> list[Measure]:
    """For each output the first source whose columns the table has; outputs without one are left out."""
    out = []
    for name, options in wanted:
        for needed, source in options:
            if all(c in df.columns for c in needed):
                out.append(Measure(name, source() if callable(source) else source, **how))
                break
    return out


def integrate_sources(
    history: DataFrame | None,
    facts: DataFrame | None,
    history_key: str,
    history_names: Mapping[str, str],
    fact_names: Mapping[str, str],
    year: str,
    default_year: int,
    key: str | None = None,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """The history if it has its key column, otherwise the facts with a default year. Schema decides.

    The ``key`` (its name after renaming) is written in its standard spelling, whichever source it comes from.
    """
    if history is not None and history_key in history.columns:
        out = rename(history, history_names)
    elif facts is None:
        raise ValueError("neither a usable history nor facts are given")
    else:
        out = add_literals(rename(facts, fact_names), {year: default_year}, only_missing=True)
    return standardize_keys(out, [key], aliases) if key else out


def gold_features(
    integrated: DataFrame,
    features: DataFrame | None,
    on: Sequence[str],
    feature_columns: Sequence[str],
    required: Sequence[str],
    out_names: Mapping[str, str] | None = None,
    facts_grouped: bool = False,
) -> DataFrame:
    """Feature table in the required column order, sorted by its keys.

    Features that the integrated table holds are its own; only those it lacks are
    joined, and where it lacks none there is no join at all. Required columns that neither side has are left out with a warning.
    """
    out = integrated
    lacking = [c for c in feature_columns if c not in out.columns]
    if lacking:
        if features is None:
            raise ValueError("the integrated table lacks features and none are given")
        out = integrate_left(out, features.select(*on, *present(features, lacking)), on, facts_grouped)
    out, absent = project_required(out, required)
    if absent:
        warnings.warn(f"required columns that no source has: {', '.join(absent)}", stacklevel=2)
    out = rename(out, out_names or {})
    order = [(out_names or {}).get(c, c) for c in on]
    return out.orderBy(*[c for c in order if c in out.columns])

