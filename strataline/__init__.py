"""Patent-metadata analytics and training-data preparation as native Spark operators."""

__version__ = "0.1.0"
