"""Bindings of the operators to the driver tables."""

from importlib import import_module

MODULES = ["growth", "weekly", "rates", "changes", "grid", "news", "calendars", "scalars",
           "stores", "layouts", "screening", "streams", "releases"]


def load_all() -> None:
    """Register every query."""
    for name in MODULES:
        import_module(f"firstprint.plans.{name}")
