"""Bronze / Silver / Gold tables from JSON feeds, written as Spark DataFrame programs."""

__version__ = "0.1.0"
