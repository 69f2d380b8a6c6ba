"""Registered queries: each pairs a Spark plan with a check in plain SQL."""

from importlib import import_module

MODULES = ["evaluate", "discover", "operate", "report", "extract", "watch"]


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"pactum.plans.{name}")
