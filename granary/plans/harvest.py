"""The whole harvest lakehouse on one base folder: land, silver, gold, model, analysis.

Every stage reads what the stage before wrote, so a stage can be run again on
its own. Sessions, masters and their settings belong to the caller.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.cleaning import lookup, standard_name
from granary.operators import learning, sampling, synth
from granary.operators.accuracy import best_model
from granary.operators.features import yearly_features
from granary.operators.joins import reconcile_keys
from granary.operators.profile import describe_numeric
from granary.operators.shaping import present
from granary.plans import analysis, gold, modelling, silver
from granary.presets import harvest as h
from granary.sources import delimited, landing, tables


SPLIT_KEYS = ("source", "id", h.CATEGORY, h.YEAR)


@dataclass(frozen=True)
class HarvestLake:
    spark: SparkSession
    base: str
    weather_folder: str = "bronze/weather"
    facts_path: str = "bronze/facts"
    history_path: str = "bronze/history"
    as_of: datetime | str | None = None

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        return tables.published(self.spark, self.path(name))

    # landing

    def land(self, source: str, folders: tuple[str, ...] = (), glob: str = "*.csv") -> DataFrame:
        """Copy the raw files below ``source`` to bronze; total, succeeded and failed files."""
        files = landing.manifest(self.spark, source, glob)
        if folders:
            landing.require_folders(files, folders)
        return landing.landing_summary(landing.land_files(files, self.path("bronze")))

    # bronze to silver

    def build_weather(self, skip_unreadable: bool = False) -> bool:
        """Silver weather from all province files in one read; False if there are none.

        A file that cannot be read fails, or is passed over if so asked; ``weather_report`` names it.
        """
        folder = self.path(self.weather_folder)
        if not tables.holds_files(self.spark, folder):
            return False
        raw = delimited.scan_tagged_files(self.spark, folder, ";", h.WEATHER.code, codes=list(h.PROVINCES), skip_unreadable=skip_unreadable)
        if tables.is_empty(raw):
            return False
        tables.publish(silver.clean_measurements(raw, h.WEATHER, self.as_of), self.path("silver/weather"))
        return True

    def build_facts(self) -> bool:
        """Silver facts; False if their file is absent or empty."""
        if not tables.holds_files(self.spark, self.path(self.facts_path)):
            return False
        raw = delimited.scan_sniffed(self.spark, self.path(self.facts_path))
        if tables.is_empty(raw):
            return False
        tables.publish(silver.clean_facts(raw, h.FACTS, self.as_of), self.path("silver/facts"))
        return True

    def weather_report(self) -> DataFrame:
        """Which weather files are read, and why others are left out."""
        return delimited.scan_report(self.spark, self.path(self.weather_folder), ";")

    def validate(self) -> DataFrame:
        return silver.validate_silver(
            self.table("silver/weather"),
            self.table("silver/facts"),
            h.WEATHER.category,
            h.FACTS.key,
            nulls_of=h.WEATHER_KEYS,
        )

    def key_report(self) -> DataFrame:
        """Which provinces both silver tables know, and which only one."""
        return reconcile_keys(
            self.table("silver/weather"), h.WEATHER.category, self.table("silver/facts"), h.FACTS.key
        )

    # silver to gold

    def history(self) -> DataFrame:
        """The integrated history, read as text and cast: a stray blank must not turn a column to text."""
        raw = delimited.scan_sniffed(self.spark, self.path(self.history_path))
        renamed = raw.withColumnsRenamed({k: v for k, v in h.HISTORY_NAMES.items() if k != h.CATEGORY})
        kinds = {c: "double" for c in present(renamed, h.HISTORY_NUMBERS)}
        kinds.update({c: "int" for c in present(renamed, [h.YEAR])})
        return renamed.withColumns({c: F.trim(c).try_cast(kind) for c, kind in kinds.items()})

    def weather_features(self) -> DataFrame:
        weather = self.table("silver/weather")
        measures = gold.choose_measures(weather, h.WEATHER_MEASURES)
        return yearly_features(weather, "province", "tanggal", measures, h.YEAR, h.DEFAULT_YEAR)

    def build_gold(self, use_history: bool = True) -> DataFrame:
        """Write the gold table; returns the check of what was written.

        The facts stand in when the history is not wanted or lacks its key column.
        """
        history = self.history() if use_history else None
        usable = history is not None and h.CATEGORY in history.columns
        facts = None if usable else self.table("silver/facts")
        integrated = gold.integrate_sources(
            history, facts, h.CATEGORY, h.HISTORY_NAMES, h.FACT_NAMES, h.YEAR, h.DEFAULT_YEAR, "province", h.ALIASES
        )
        complete = all(c in integrated.columns for c in h.WEATHER_FEATURES)
        table = gold.gold_features(
            integrated,
            None if complete else self.weather_features(),
            ["province", h.YEAR],
            h.WEATHER_FEATURES,
            h.REQUIRED,
            {"province": h.CATEGORY},
        )
        return tables.write_verified(table, self.path("gold/features"), versioned=True)

    def export_gold(self, target: str) -> bool:
        return tables.export_table(self.spark, self.path("gold/features"), target)

    # synthetic rows and models

    def build_synthetic(self, rows: int = h.SYNTHETIC_ROWS, noise: bool = True) -> None:
        real = self.table("gold/features")
        drawn = synth.draw_rows(
            self.spark, rows, synth.derive_ranges(real, h.RULES), h.RULES, real, h.CATEGORY, h.YEAR, h.YEARS
        )
        made = synth.with_target(
            drawn,
            h.TARGET,
            synth.yield_base(h.AREA, h.RAIN, h.HUMIDITY, h.TEMPERATURE),
            lookup(standard_name(h.CATEGORY, h.ALIASES), h.FACTORS, 1.0),
            h.YEAR,
            synth.noise_for("id") if noise else None,
        )
        tables.publish(made, self.path("gold/synthetic"))

    def combined(self) -> DataFrame:
        return synth.combine_with_real(self.table("gold/features"), self.table("gold/synthetic"), "source")

    def compare_sources(self) -> DataFrame:
        return synth.compare_sources(self.combined(), [*h.FEATURES, h.TARGET])

    def split_report(self) -> DataFrame:
        """Sizes and shares of the training and test rows."""
        return sampling.split_sizes(sampling.label_split(self.combined(), SPLIT_KEYS))

    def train(self, models: Mapping[str, Estimator] | None = None) -> modelling.Fitted:
        """Fit and judge all models; writes the predictions of all, the metrics and the best model."""
        rows = self.combined()
        train, test = sampling.split_train_test(rows, SPLIT_KEYS)
        keep = [h.CATEGORY, h.YEAR, *h.FEATURES]
        done = modelling.train_and_compare(
            train, test, h.TARGET, h.FEATURES, h.CATEGORY, keep, models, self.path("predictions"),
            as_of=self.as_of, **h.PREDICTION_NAMES,
        )
        tables.publish(done.metrics, self.path("metrics"))
        tables.save_model(done.trained.pipeline(done.best), self.path(f"models/{done.best}"))
        names = [*h.FEATURES, learning.indexed_name(h.CATEGORY)]
        ranked = learning.feature_importance(done.trained.pipeline(done.best), names, rows)
        tables.publish(ranked, self.path("importance"))
        return done

    # analysis

    def best_model_name(self) -> str:
        model = h.PREDICTION_NAMES["model"]
        return best_model(self.table("metrics"), model).first()[model]

    def analyse(self) -> dict[str, DataFrame]:
        """All report tables of the best model, each also written as a CSV report."""
        names, best = h.PREDICTION_NAMES, self.best_model_name()
        predictions = self.table("predictions").where(F.col(names["model"]) == best)
        real, synthetic = self.table("gold/features"), self.table("gold/synthetic")
        out = analysis.accuracy_pack(
            predictions, h.CATEGORY, h.YEAR, [h.CATEGORY, h.YEAR], names["actual"], names["error_pct"]
        )
        out["prediction_statistics"] = describe_numeric(
            predictions, [names[n] for n in ("actual", "predicted", "error", "error_pct")]
        )
        out["model_comparison"] = self.table("metrics")
        out["summary"] = analysis.report_table(
            predictions, real, synthetic, h.CATEGORY, h.YEAR, h.TARGET, h.FEATURES, best,
            names["actual"], names["predicted"], names["error_pct"],
        )
        for name, df in out.items():
            tables.write_report(df, self.path(f"reports/{name}"))
        return out

    def chart_data(self) -> dict[str, DataFrame]:
        names = h.PREDICTION_NAMES
        predictions = self.table("predictions").where(F.col(names["model"]) == self.best_model_name())
        return analysis.plot_data(
            predictions, self.table("gold/features"), self.table("gold/synthetic"), h.FEATURES, h.TARGET,
            h.CATEGORY, h.YEAR, names["actual"], names["predicted"],
        )

    def write_charts(self) -> None:
        """The chart tables, each as a CSV report."""
        for name, df in self.chart_data().items():
            tables.write_report(df, self.path(f"charts/{name}"))
