"""Keyed daily observations on a regular grid: mapping, incremental loading and data quality as Spark plans."""
