"""All registered queries, by inventory section."""

from __future__ import annotations

from importlib import import_module

from .entry import Entry

SECTIONS = ["storage", "scalars", "relational", "models", "questions", "streams"]


def all_entries() -> dict[str, Entry]:
    entries: dict[str, Entry] = {}
    for section in SECTIONS:
        for name, entry in import_module(f"workbench.{section}").ENTRIES.items():
            if name in entries:
                raise ValueError(f"query {name} is registered twice")
            entries[name] = entry
    return entries
