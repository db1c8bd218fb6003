"""Column-level building blocks; all of them stay inside Catalyst."""

from . import bins, parse, text, time, units

__all__ = ["bins", "parse", "text", "time", "units"]
