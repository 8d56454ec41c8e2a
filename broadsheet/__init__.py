"""Broadsheet: content-curation analytics as PySpark DataFrame operators."""
