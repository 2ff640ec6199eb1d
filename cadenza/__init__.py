"""Event-data engine on Spark: extraction, validation, merging and publication of dated events."""

__version__ = "0.1.0"
