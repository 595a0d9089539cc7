"""Registered queries: each wires the given tables to library functions.

Every module holds ``QUERIES``: name → (callable(spark, sf_dir), SQL or None).
"""

from importlib import import_module

MODULES = (
    "text", "files", "extracted", "graph", "search", "reports", "metrics", "state", "stored", "streams",
)


def registered() -> dict:
    found: dict = {}
    for name in MODULES:
        module = import_module(f"registry.{name}")
        clash = found.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(module.QUERIES)
    return found
