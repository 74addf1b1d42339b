"""Product-signal analytics on Spark: raw payloads to scores, labels, metrics and reports."""

__version__ = "0.1.0"
