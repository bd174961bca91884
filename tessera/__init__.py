"""Tessera: building and analysing large web-text corpora with PySpark."""
