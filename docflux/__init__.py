"""docflux: a PySpark-native analytics engine for document-event corpora."""

__version__ = "0.1.0"
