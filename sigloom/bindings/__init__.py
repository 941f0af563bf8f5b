"""Queries of the library bound to the test tables."""

import importlib
import pkgutil

from sigloom.bindings.registry import ORACLES, QUERIES

for _m in sorted(m.name for m in pkgutil.iter_modules(__path__)):
    importlib.import_module(f"{__name__}.{_m}")

__all__ = ["ORACLES", "QUERIES"]
