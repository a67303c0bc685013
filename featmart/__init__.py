"""Dataset operators for machine-learning feature tables, written on the public Spark API."""

__version__ = "0.1.0"
