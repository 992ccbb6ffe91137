"""Whole jobs: build the mapping, load observations, run a quality suite."""
