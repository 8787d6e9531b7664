"""Composed jobs: fixtures derived from the driver tables, pipelines, refresh control."""
