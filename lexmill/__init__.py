"""Spark-native extraction of abbreviation lists and glossaries from large document collections."""
