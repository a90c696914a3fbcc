"""docpulse: a PySpark-native engine for document-extraction quality data."""
