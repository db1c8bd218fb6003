"""Hourly energy analytics on PySpark."""
