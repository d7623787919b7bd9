"""Registered queries over the given tables, each with the SQL that states its expected result."""

from importlib import import_module

MODULES = ["marts", "upserts", "trips", "sales", "streams", "versions", "documents"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        found = getattr(import_module(f"{__name__}.{name}"), attribute)
        clash = merged.keys() & found.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(found)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
