"""lexflume: a PySpark-native engine for document analytics and corpus preparation."""

__version__ = "0.1.0"
