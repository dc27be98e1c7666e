"""Spark-native curation, auditing and evaluation of image-annotation datasets."""
