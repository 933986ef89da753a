"""Data products, and the registered queries that apply operators to tables."""

from __future__ import annotations

import importlib
import pkgutil


def load_all() -> None:
    """Registers the queries of every module here."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
