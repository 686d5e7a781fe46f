"""cliplake: a PySpark-native engine for building training corpora from timed media."""

__version__ = "0.1.0"
