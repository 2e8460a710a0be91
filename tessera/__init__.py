"""A Spark-native engine for document structure, retrieval and quality measurement."""
