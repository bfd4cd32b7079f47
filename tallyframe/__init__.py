"""Tabular-ML data work as Spark plans: contracts, cleaning, features,
metrics, drift, scoring policy, leaderboards, training and monitoring."""

__version__ = "0.1.0"
