"""Contract-driven data products as plain Spark DataFrame functions."""

__version__ = "0.1.0"
