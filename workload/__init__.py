"""Queries over the given tables, one per operator, with checking SQL where SQL can say it."""

from importlib import import_module

MODULES = ["storage", "relational", "silver", "cleaning", "activation", "evaluation", "modelling", "streams", "sketching"]


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"workload.{name}")
