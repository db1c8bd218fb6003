"""Composed models: hourly staging, star schema, access views, questions."""
