"""Checked queries over the given tables, one module per operator family."""

from importlib import import_module

MODULES = ["projections", "joining", "aggregating", "ordering", "reshaping", "ruling", "publishing", "checking", "places", "composing"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
