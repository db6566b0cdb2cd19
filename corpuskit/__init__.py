"""corpuskit: a PySpark-native engine for building multilingual text corpora."""

__version__ = "0.1.0"
