"""Scenario reporting on Spark: lookups, balances, roll-ups and annual series over model exports."""
