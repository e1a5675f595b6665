"""Functions that run in Python workers."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[2])


def _named(functions: tuple) -> list[tuple]:
    return [("function", x.__module__, x.__name__) if callable(x) else ("value", x, "") for x in functions]


def remote(function: Callable, *args) -> Callable:
    """``function(batches, *args)`` for ``mapInArrow``.

    The function, and those among its arguments, are found by name in the worker, which then needs
    neither the driver's path settings nor pickled copies of the modules.
    """
    root, named = ROOT, _named((function, *args))

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        first, *rest = [getattr(importlib.import_module(x), name) if kind == "function" else x for kind, x, name in named]
        yield from first(batches, *rest)

    return run


def remote_pair(function: Callable, *args) -> Callable:
    """``function(left, right, *args)`` for ``applyInArrow`` on a cogroup, found as by ``remote``."""
    root, named = ROOT, _named((function, *args))

    def run(left, right):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        first, *rest = [getattr(importlib.import_module(x), name) if kind == "function" else x for kind, x, name in named]
        return first(left, right, *rest)

    return run
