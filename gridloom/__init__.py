"""Gridded-event analytics on PySpark."""
