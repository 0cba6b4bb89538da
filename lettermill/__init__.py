"""Spark-native engine for corpora of e-mail-like messages."""

__version__ = "0.1.0"
