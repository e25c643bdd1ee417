"""Spark-native building, aligning and auditing of parallel text corpora."""
