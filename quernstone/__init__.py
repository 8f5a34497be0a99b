"""Quernstone: a PySpark-native engine for preparing and analysing large text corpora."""
