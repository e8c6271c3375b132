"""weftline: a PySpark-native engine for document-corpus and semi-structured analytics."""

__version__ = "0.1.0"
