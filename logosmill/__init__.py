"""Preparation and measurement of Modern Greek text corpora on PySpark."""
