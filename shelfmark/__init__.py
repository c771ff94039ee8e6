"""Spark jobs that turn messy shop feeds into a product warehouse and mart."""

__version__ = "0.1.0"
