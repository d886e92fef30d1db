"""Spark-native data system for tabular risk scoring: cleaning, splitting, evaluation, fairness, monitoring."""

__version__ = "0.1.0"
