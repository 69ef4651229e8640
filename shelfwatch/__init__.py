"""Demand features, forecasts, drift and answer-quality checks as Spark DataFrame operators."""

__version__ = "0.1.0"
