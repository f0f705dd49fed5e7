"""statloom: a PySpark-native engine for large collections of numbered, cross-referencing documents."""

__version__ = "0.1.0"
