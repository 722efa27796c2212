"""Tessella: Spark-native curation of interleaved text and image web documents."""
