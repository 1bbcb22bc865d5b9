"""Build and maintain wide fact tables from change-captured sources on Spark."""

__version__ = "0.1.0"
