"""Composed plans: the end-to-end pipeline, dashboard datasets, acceptance suite."""
