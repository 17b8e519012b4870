"""Layered (bronze, silver, gold) data pipelines written as Spark jobs."""

__version__ = "0.1.0"
