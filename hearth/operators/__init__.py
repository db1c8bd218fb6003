"""Relational operators over DataFrames."""

from . import aggregates, filters, joins, keys, ordering, quality, sets

__all__ = ["aggregates", "filters", "joins", "keys", "ordering", "quality", "sets"]
