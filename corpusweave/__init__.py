"""Corpus analytics for language-model data, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
