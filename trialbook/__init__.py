"""Experiment-registry analytics on PySpark: datasets, splits, runs, scores and leaderboards."""
