"""Spark-native cleaning, feature building, regression and error analysis for tabular sources."""

__version__ = "0.1.0"
