"""Quarry: a Spark-native engine for evidence-backed text corpora.

Everything is declared with DataFrame expressions; see README.md for the map of
subpackages.
"""

__version__ = "0.1.0"
